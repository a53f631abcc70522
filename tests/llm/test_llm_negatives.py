import math

import numpy as np
import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbarge.llm import hard_negatives as H

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def clusters(seed, groups, each, alone, dims=16, noise=0.1, lengths=(0.2, 2.0)):
    draw = np.random.default_rng(seed)
    centers = draw.standard_normal((groups, dims))
    near = np.repeat(centers, each, 0) + noise * draw.standard_normal((groups * each, dims))
    points = np.concatenate([near, draw.standard_normal((alone, dims))])
    return points * draw.uniform(*lengths, (len(points), 1))


def brute_force(rows, every=100, scale=256):
    rows = [
        (i, tuple(math.floor(scale * x) for x in v), label) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for a, (anchor, v, label) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scores = [(dot(v, w), i, other == label) for b, (i, w, other) in enumerate(rows) if b != a and len(w) == len(v)]
        for score, i, _ in sorted((s for s in scores if s[2]), key=lambda s: order(s[0], s[1]))[:5]:
            fits = [(s, j) for s, j, same in scores if not same and 30 * score <= 100 * s <= 90 * score]
            for rank, (s, j) in enumerate(sorted(fits, key=lambda x: order(*x))[:10], 1):
                out.append((anchor, i, rank, j, score, s))
    return sorted(out, key=str)


def odd_rows(dims):
    x = [0.25] * dims
    return [
        (9000, None, 1), (9100, x, None), (9200, [float("nan")] + x[1:], 1), (9300, [None] + x[1:], 1), (9400, [float("inf")] + x[1:], 2),
        (9500, [], 1), (9501, [], 2), (9600, [1.0, 2.0], 1), (9601, [2.0, 4.0], 1), (9602, [0.5, 1.0], 2), (None, x, 1), (None, x, 2),
        (100, x, 3), (100, x, 3), (-200, x, 4), (9700, [0.0] * dims, 5),
    ]


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "anchor_rows": 2, "sample_rows": 200}])
def test_equal_to_brute_force(spark, options):
    x = clusters(3, 12, 40, 200)
    draw = np.random.default_rng(4)
    rows = [(k, v.tolist(), int(draw.integers(0, 4))) for k, v in enumerate(x)]
    rows += [(1000 + k, x[200 + k % 3].tolist(), k % 3) for k in range(60)] + odd_rows(16)
    table = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit(7) for c in ("uid", "node", "rank", "v")})
    got = H.hard_negatives(table, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_force(rows)
    assert want and rows_of(got) == want


def test_components_beyond_doubles(spark):
    rows = [(100, [2.0**30, 1.0], 1), (1, [2.0**30, 5.0], 1), (2, [2.0**29, 3.0], 2), (3, [2.0**29, 3.5], 2), (4, [2.0**20, 0.0], 2)]
    want = brute_force(rows, scale=1)
    assert len(want) == 2 and rows_of(H.hard_negatives(spark.createDataFrame(rows, VECTORS), scale=1)) == want


def test_empty_table(spark):
    assert H.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []


def test_levels_cover_and_bounds_hold():
    x = np.floor(64 * clusters(5, 10, 100, 400))
    labels = np.arange(len(x)) % 5
    m2 = float(H.squared(x).max())
    levels = H.cover_levels(x, labels, m2)
    seen = np.concatenate([m for level in levels for m in level.leaf if m is not None])
    assert sorted(seen) == list(range(len(x))) and len(levels) > 2
    queries = x[::50]
    for level in levels:
        low, high = H.bounds(queries, x[level.center], level.radius, m2)
        for k, members in enumerate(level.leaf):
            if members is not None:
                inner = queries @ x[members].T
                assert (inner.min(1) >= low[:, k]).all() and (inner.max(1) <= high[:, k]).all()
                assert labels[members].min() == level.least[k] and labels[members].max() == level.most[k]


def test_search_skips_most_of_clustered_data():
    x = np.floor(256 * clusters(6, 60, 60, 0, noise=0.02, lengths=(0.9, 1.1)))
    labels = np.arange(len(x)) % 10
    low, high = np.full((40, 1), H.LOWEST), np.full((40, 1), H.HIGHEST)
    of = H.Wanted(np.arange(40), x[:40].astype(np.int64), labels[:40], low, high, True)
    found = H.Search(of, x.astype(np.int64), labels, np.arange(len(x)), float(H.squared(x).max()), 5).run()
    assert found.compared < 0.5 * 40 * len(x)
    for a in range(40):
        inner = x @ x[a]
        rows = [j for j in range(len(x)) if j != a and labels[j] == labels[a]]
        want = sorted(rows, key=lambda j: (-inner[j], j))[:5]
        assert [int(r) for s, r in zip(found.best[0], found.best[2]) if s == a] == want


def test_crowds_share_small_nodes():
    row = lambda node, anchors, dims=4: type("R", (), {"dims": dims, "node": node, "anchors": anchors})()
    places = H.crowds([row(0, 3), row(1, 4), row(2, 25), row(3, 0), row(4, 2), row(0, 1, 8)], 10)
    assert places == {(4, 0): (0, 1), (4, 1): (0, 1), (4, 2): (1, 3), (4, 4): (4, 1), (8, 0): (5, 1)}
