import random
import zlib

import pytest
from llm_helpers import DOCS, documents
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbarge.llm import toxicity as X

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])
BAD = ["rotter", "blackguard", "swine", "dunce"]


def prose(draw, toxic, words=120):
    syllables = ["ra", "ten", "mo", "lis", "ka", "ver", "dun", "so", "pil", "gat"]
    out = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(words)]
    for _ in range(4 if toxic else 0):
        out[draw.randrange(words)] = "you " + draw.choice(BAD)
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    rows = [(k, prose(draw, k % 5 == 0), "en", "s", k % 5 == 0) for k in range(500)]
    # copies of one clean-looking toxic text: its words must not become entries
    copy = prose(draw, True) + " zebra quokka"
    rows += [(1000 + k, copy + " " * (k % 2), "en", "s", True) for k in range(60)]
    return rows


def held(ident):
    return zlib.crc32(str(ident).encode()) % 3 == 1


def test_scores_of_held_out_rows(spark, corpus):
    odd = [(None, "you swine " * 5, "en", "s"), (2000, None, "en", "s"), (2001, "", "en", "s"), (2002, "ka mo " * 300_000, "en", "s"), (2003, "k" * 200_000, "en", "s"), (2004, "you sw1ne, you d.u.n.c.e " * 3, "xx", None)]
    docs = spark.createDataFrame([(*r[:4], 0) for r in corpus] + [(*r, 0) for r in odd], DOCS)
    labels = [(r[0], 1, int(r[4])) for r in corpus] + [(0, 1, None), (0, 0, 1), (None, 1, 1), (2001, None, None)]
    labels = spark.createDataFrame(labels, LABELS)
    clash = docs.withColumns({c: F.lit("x") for c in ("score", "features", "label", "raw", "uid", "a.b")})
    got = X.score_toxicity(clash, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(corpus) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    by = {r.doc_id: r for r in found}
    wrong = [i for i, *_, toxic in corpus if held(i) and by[i].predicted != int(toxic)]
    assert len(wrong) <= 2
    assert all(by[i].held_out == held(i) for i, *_ in corpus) and by[None].held_out is False and by[None].predicted == 1
    assert by[2000].score == by[2001].score < 0.7 and by[2002].predicted == 0 and by[2003].predicted == 0 and by[2004].predicted == 1
    again = X.score_toxicity(clash, labels, broadcast_bytes=0).collect()
    assert {r.doc_id: r.held_out for r in again} == {r.doc_id: r.held_out for r in found}


def test_held_out_labels_do_not_matter(spark, corpus):
    docs = spark.createDataFrame([(*r[:4], 0) for r in corpus], DOCS)
    labels = [(r[0], 1, int(r[4])) for r in corpus]
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    scores = [
        sorted(tuple(r) for r in X.score_toxicity(docs, spark.createDataFrame(x, LABELS), trees=3).collect()) for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_copies_count_once_in_the_lexicon(spark, corpus):
    docs = spark.createDataFrame([(*r[:4], 0) for r in corpus], DOCS)
    labels = spark.createDataFrame([(r[0], 1, int(r[4])) for r in corpus], LABELS)
    rows = X.training_rows(docs, labels, "doc_id", "text", "toxic", 64 << 20)
    entries = {f for f, _ in X.learn_lexicon(rows, 0.25, 100)}
    assert {"rott*", "swin*", "dunc*", "blac*"} <= entries and not any(f.startswith(("zeb", "quo")) for f in entries)


def test_without_labels_of_both_kinds(spark):
    docs = documents(spark, "a", None)
    none = spark.createDataFrame([], LABELS)
    clean = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], LABELS)
    for labels in (none, clean):
        assert [(r.score, r.predicted) for r in X.score_toxicity(docs, labels).collect()] == [(0.0, 0), (0.0, 0)]
    assert X.score_toxicity(documents(spark), clean).collect() == []


def test_obfuscation_is_undone():
    assert X.unmasked("you 1diot, i.d.i.o.t and 2.0 in 1999") == ("you idiot, idiot and 2.0 in 1999", 5)
    assert X.unmasked("w0rthle$s s c u m") == ("worthless scum", 5)
    assert X.forms_of("Trashy a 12 trash") == {"trashy", "a", "trash", "tras*", "trash*"}


def test_features_in_detail():
    words = X.Lexicon([("scum", 2.0), ("idio*", 3.0)])
    value = dict(zip(X.FEATURES, X.features_of("You SCUM! you idiotic scumbag. 1d1ot", words), strict=True))
    assert value["hit_rate"] == 3 / 6 and value["weighted_hit_rate"] == 8 / 6 and value["near_second_person"] == 1.0
    assert value["obfuscated_hit_rate"] == 1 / 6 and value["shouted_rate"] == 1 / 6 and value["exclamation_rate"] > 0
    assert X.features_of("", words) == X.features_of(None, words)
