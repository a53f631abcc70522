import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logbarge.llm.slack_packing import Packer, closest_multiset, pack_tokens, padding
from logbarge.llm.token_matrix import RoomTree, best_fit_decreasing, documents_of, pack_matrix, write_matrix
from logbarge.llm.tokens import Vocabulary, encoder

ODD = ("plain words, here", None, "", "plain words, here", "<|endoftext|> é 日本 \n\n  x", "long " * 9000, "tail\u00a0\u2028 'll 123")


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=5), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_closest_multiset(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    total, used = closest_multiset(sorted(counts), counts, room)
    assert total == max(sums) == sum(n * k for n, k in used.items())
    assert all(k <= counts[n] for n, k in used.items())


@pytest.mark.parametrize("lengths", [[1500] * 700, [1] * 3000, [2047] * 500, [5], [1025] * 301 + [3] * 10, "mixed"])
def test_packer_is_lossless_and_full(lengths):
    if lengths == "mixed":
        draw = random.Random(4)
        lengths = [min(2047, int(draw.lognormvariate(6, 1)) + 1) for _ in range(4000)]
    packer, windows = Packer(2048), []
    for k, n in enumerate(lengths):
        packer.put(k, 0, n)
        if k % 1000 == 999:
            windows += packer.full_windows()
    windows += packer.last_windows(True)
    sizes = np.array([sum(p[2] for p in w) for w in windows])
    assert sizes.sum() == sum(lengths) and padding(sizes, 2048) == 0 and (sizes <= 2048).all()
    seen = {}
    for doc, start, n in sorted(p for w in windows for p in w):
        assert seen.get(doc, 0) == start
        seen[doc] = start + n
    assert list(seen.values()) == lengths


def ids_of(text):
    full = Tokenizer.from_file(Vocabulary().json_path)
    return full.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.text(max_size=40))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_tokenizer(text):
    assert encoder(Vocabulary())(text).tolist() == ids_of(text)


def test_ids_of_every_code_point():
    fast, full = encoder(Vocabulary()), Tokenizer.from_file(Vocabulary().json_path)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)} .{chr(c)}" for c in points]
    for text, want in zip(texts, full.encode_batch(texts, add_special_tokens=False)):
        assert fast(text).tolist() == [*want.ids, 1], text


def test_pack_tokens(spark):
    docs = documents(spark, *ODD).withColumns({"start": F.lit("x"), "ids": F.lit(1)}).repartition(2)
    rows = pack_tokens(docs, capacity=64, block_tokens=500).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
    for k, text in enumerate(ODD):
        ids = np.frombuffer(b"".join(i for _, i in sorted(by_doc[k])), "<u4").tolist()
        assert ids == ids_of(text)
        assert {r.doc_tokens for r in rows if r.doc_id == k} == {len(ids)}
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    short = pack_tokens(docs, capacity=64, with_ids=False, power_tails=False)
    assert "ids" not in short.columns and short.agg(F.sum("length")).first()[0] == sum(r.length for r in rows)


def test_best_fit_decreasing_equals_a_scan():
    draw = random.Random(9)
    for _ in range(200):
        width = draw.choice([16, 50, 64])
        lengths = [draw.randint(1, width) for _ in range(draw.randint(0, 60))]
        rooms, rows = [], []
        for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [(room, j) for j, room in enumerate(rooms) if room >= lengths[k]]
            j = min(fits)[1] if fits else len(rooms)
            if not fits:
                rooms.append(width)
                rows.append([])
            rooms[j] -= lengths[k]
            rows[j].append(k)
        got = best_fit_decreasing(lengths, width)
        assert sorted(sum(lengths[k] for k in r) for r in got) == sorted(sum(lengths[k] for k in r) for r in rows)
    assert RoomTree(8).best_fit(3) is None


def test_matrix_round_trip(spark, tmp_path):
    docs = documents(spark, *ODD).withColumn("row", F.lit(0)).repartition(2)
    write_matrix(pack_matrix(docs, width=64, block_tokens=700), str(tmp_path / "m"))
    matrix = spark.read.parquet(str(tmp_path / "m"))
    for r in matrix.collect():
        assert len(r.input_ids) == 128 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert list(r.position_resets) == list(r.cu_seqlens[:-1]) and len(r.doc_ids) == len(r.starts) == len(r.piece_keys) == len(r.cu_seqlens) - 1
        assert not any(r.input_ids[2 * r.n_tokens :])
    got = rows_of(documents_of(matrix), "doc_id", "ids")
    assert [(k, np.frombuffer(i, "<u2").tolist()) for k, i in got] == [(k, ids_of(t)) for k, t in enumerate(ODD)]
    with pytest.raises(Exception, match="does not fit"):
        pack_matrix(docs, dtype="<u1").collect()
