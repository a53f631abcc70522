import numpy as np
from llm_helpers import rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logbarge.llm.secret_scan import automaton, find_secrets, redacted
from logbarge.llm.tokens import Vocabulary


def test_stages_in_turn(spark, sf):
    """Each stage's rows follow from those before it; the last one's ids decode to the texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, before = docs.columns, docs
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, sf)
        if k < 4:
            assert after.columns == names
            after = corpus_pipeline.written(after, "test-stage")
            kept.append(rows_of(after, "doc_id", "text"))
            before = after
    good, single, clean, mixed = kept
    assert set(good) <= set(rows_of(docs, "doc_id", "text")) and len(good) < docs.count() and set(single) <= set(good)
    words = automaton()
    assert clean == sorted(((i, redacted(t, find_secrets(t, words))) for i, t in single), key=str)
    assert set(mixed) <= set(clean) and len(mixed) > 0.7 * len(clean)
    pieces = {}
    for r in after.collect():
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    full = Tokenizer.from_file(Vocabulary().json_path)
    wanted = {}
    for doc_id, text in mixed:
        wanted.setdefault(doc_id, [text, 0])[1] += 1
    total = sum(len(i) // 4 for p in pieces.values() for _, i in p)
    assert total == sum(n * (len(full.encode(t, add_special_tokens=False).ids) + 1) for t, n in wanted.values())
    for (doc_id, tokens), parts in pieces.items():
        if wanted[doc_id][1] == 1:
            ids = np.frombuffer(b"".join(i for _, i in sorted(parts)), "<u4")
            assert len(ids) == tokens and full.decode(ids[:-1].tolist(), skip_special_tokens=False) == wanted[doc_id][0]


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 100 and corpus_pipeline.ORACLE_SQL is None
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def odd_documents(spark, sf):
    """Sample rows with nulls, repeated rows, empty and long texts, and columns called like internal ones."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    odd = [(None, "no id", "en", "src0", 5), (900, None, None, None, None), (901, "", "xx", "odd", 0), (902, "word " * 30_000, "en", "src1", 150_000), (902, "word " * 30_000, "en", "src1", 150_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    return docs.withColumns({"a.b": F.lit("dot"), "row_key": F.lit(1), "copy": F.lit("c"), "mix_key": F.lit(2), "uid": F.lit(3), "row": F.lit(4), "copies": F.lit(5), "text_": F.lit(6)})


def test_stages_on_odd_rows(spark, sf):
    docs = odd_documents(spark, sf)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, sf)
        if k < 4:
            assert after.columns == docs.columns
            docs = corpus_pipeline.written(after, "odd-stage")
            assert docs.count() > 0 and docs.where("`a.b` <> 'dot' or copy <> 'c' or uid <> 3").count() == 0
    assert after.count() > 0


def test_stages_on_an_empty_table(spark, sf):
    docs = odd_documents(spark, sf).limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, sf)
        assert after.count() == 0 and (k == 4 or after.columns == docs.columns)
