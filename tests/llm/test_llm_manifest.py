import hashlib
import zlib

import numpy as np
import pytest
from llm_helpers import DOCS, documents, rows_of
from pyspark.sql import functions as F

from logbarge.llm import merkle as M


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute_force(rows):
    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    fields = lambda r, text: (r[0], r[3], r[2], r[4], text)
    for g in order:
        groups[g] = sorted(((r[0], leaf(fields(r, r[1])), r) for r in groups[g]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [climb([x[1] for x in groups[g]]) for g in order]
    top = climb([t[-1][0] for t in trees])
    out = []
    for g, name in enumerate(order):
        for place, (ident, own, row) in enumerate(groups[name]):
            current = own
            if ident is not None and zlib.crc32(str(ident).encode()) % 5 == 0 and row[1] is not None:
                current = leaf(fields(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])))
            siblings = []
            for levels, at in ((trees[g], place), (top, g)):
                for level in levels[:-1]:
                    begin = at // 16 * 16
                    run = level[begin : begin + 16]
                    siblings += run[: at - begin] + run[at - begin + 1 :]
                    current = digest(*run[: at - begin], current, *run[at - begin + 1 :])
                    at //= 16
            root = top[-1][0]
            out.append((ident, own, trees[g][-1][0], root, digest(*siblings), current, current == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_compression_equals_the_library():
    draw = np.random.default_rng(1)
    children = draw.integers(0, 256, (40, 16, 32)).astype(np.uint8)
    sizes = draw.integers(1, 17, 40)
    kept, digests = M.retained_states(children, sizes)
    for k, n in enumerate(sizes):
        text = "".join(c.tobytes().hex() for c in children[k, :n])
        assert digests[k].tobytes().hex() == digest(text)
        slot = int(draw.integers(0, n))
        other = draw.integers(0, 256, (1, 32)).astype(np.uint8)
        rights = np.zeros((1, 15, 32), np.uint8)
        rights[0, : n - slot - 1] = children[k, slot + 1 : n]
        folded = M.resume(kept[k : k + 1, slot], np.array([slot]), other, rights, np.array([n - slot - 1]))
        want = text[: 64 * slot] + other.tobytes().hex() + text[64 * (slot + 1) :]
        assert folded[0].tobytes().hex() == digest(want)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_equal_to_brute_force(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(M.build, "__defaults__", (broadcast_bytes,))
    rows = [(k, f"Text number {k} Äb", "en", "hot", k) for k in range(300)]
    rows += [(1000 + k, "A" * k, None, f"s{k % 20}", None) for k in range(60)]
    rows += [(None, "No id", "en", "hot", 5), (7, "Text number 7 Äb", "en", "hot", 7), (7, "Other", "en", "hot", 7), (9, None, "de", None, 0)]
    rows += [(11, "", "de", "", 0), (12, "LONG " * 40_000, "de", "é", 1), (13, "Ünïcode Ä ß 漢", "de", "Z", 1), (13, "Ünïcode Ä ß 漢", "de", "Z", 1)]
    table = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({c: F.lit(1) for c in ("leaf", "grp", "id", "g", "a.b")})
    got = M.prove(table)
    assert got.columns == COLUMNS
    assert rows_of(got) == brute_force(rows)


def test_one_source_and_one_row(spark):
    for rows in ([(3, "A", "en", "s", 1)], [(k, "A", "en", "s", 1) for k in range(17)]):
        assert rows_of(M.prove(spark.createDataFrame(rows, DOCS))) == brute_force(rows)
    assert M.prove(documents(spark)).collect() == [] and M.prove(documents(spark)).columns == COLUMNS
