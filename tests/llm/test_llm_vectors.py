import numpy as np
import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbarge.llm import binary_codes as B
from logbarge.llm import dual_tree as D
from logbarge.llm.components import connected_components
from logbarge.llm.dual_tree import cover_tree, exact_search, top_k

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def clusters(seed, groups, each, alone, dims=32, noise=0.05):
    draw = np.random.default_rng(seed)
    centers = draw.standard_normal((groups, dims))
    near = np.repeat(centers, each, 0) + noise * draw.standard_normal((groups * each, dims))
    return np.concatenate([near, draw.standard_normal((alone, dims))])


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (7, 9), (5, 5), (None, 1)] + [(k, k + 1) for k in range(20, 60)] + [(100, k) for k in range(101, 160)]
    got = dict(rows_of(connected_components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{k: 20 for k in range(20, 61)}, **{k: 100 for k in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(3)
    units = B.unit_vectors(draw.standard_normal((400, 64)))
    codes = B.Codes(B.encoded(units, 3)[0], 64, 3, 4.0)
    whole = slice(0, 400)
    i, j = (x.ravel() for x in np.indices((400, 400)))
    first, refined = codes.estimate(whole, whole), codes.refined(i, j).reshape(400, 400)
    bounds = codes.error_first + codes.off[:, None] * codes.round_first, codes.error + codes.off[:, None] * codes.round
    for estimate, bound in zip((first, refined), bounds, strict=True):
        off = (estimate - units @ units.T)[~np.eye(400, dtype=bool)]
        assert abs(off.mean()) < 0.002
        assert (np.abs(estimate - units @ units.T) <= bound).mean() > 0.9999
    assert bounds[1].mean() < 0.7 * bounds[0].mean()


@pytest.mark.parametrize("dims", [1, 2, 3, 17, 64, 100])
def test_bit_estimates_equal_plain_products(dims):
    """The bit operations give the product of the rounded vector and the signs, and bounds hold at any length."""
    units = B.unit_vectors(np.random.default_rng(dims).standard_normal((200, dims)))
    raw, signs = B.encoded(units, 2)
    codes = B.Codes(raw, dims, 2, 4.0)
    assert (codes.signs == signs).all()
    plain = codes.rounded[:, 0] @ (2.0 * signs[:, :dims] - 1).T / codes.factors[:, 0]
    estimate = codes.estimate(slice(0, 200), slice(0, 200))
    assert np.allclose(estimate, plain, atol=1e-5)
    whole = slice(0, 200)
    bound = estimate + codes.error_first + codes.off[:, None] * codes.round_first
    far = np.abs(bound - 0.9) > 1e-5
    assert ((codes.inner(whole, whole) >= codes.least_inner(whole, whole, 0.9)) == (bound >= 0.9))[far].all()
    near = units @ units.T >= 0.9
    i, j = codes.candidates(slice(0, 200), slice(0, 200), 0.9)
    found = np.zeros_like(near)
    found[i, j] = True
    assert found[near].mean() > 0.999


@pytest.mark.parametrize("block", [1024, 8])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    x = clusters(1, 6, 15, 120)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(1000 + k, x[k].tolist()) for k in range(5)] + [(1003, (2 * x[3]).tolist())]  # copies and a scaled one
    odd = [(2000, None), (2001, [0.0] * 32), (2002, [float("nan")] + [1.0] * 31), (2003, [None] + [1.0] * 31), (2004, []), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (2007, [1e300] + [0.0] * 31)]
    got = {}
    result = B.near_vectors(table(spark, rows + odd).withColumn("row", F.lit(1)).withColumn("uid", F.lit(1)))
    assert result.columns == ["vec_id", "n_links", "component_id", "kept"]
    for r in result.collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id))
    ids, units = [i for i, _ in rows], B.unit_vectors(np.array([v for _, v in rows]))
    linked = units @ units.T >= 0.9
    for k, i in enumerate(ids):
        assert (int(linked[k].sum()) - 1) in [n for n, _ in got[i]]
    assert got[0][0][1] == 0 and got[1000][0][1] == got[0][0][1] and {c for _, c in got[1003]} == {got[3][0][1]}
    assert [got[k] for k in (2000, 2001, 2002, 2003, 2004)] == [[(0, k)] for k in (2000, 2001, 2002, 2003, 2004)]
    assert got[2005] == [(1, 2005)] and got[2006] == [(1, 2005)]


def test_recall_at_the_threshold(spark):
    """Pairs just above 0.9 are the hardest; the plan asks for 0.999 of them."""
    draw = np.random.default_rng(5)
    a = B.unit_vectors(draw.standard_normal((600, 64)))
    b = draw.standard_normal((600, 64))
    b = B.unit_vectors(b - (b * a).sum(1, keepdims=True) * a)
    pairs = np.concatenate([a, 0.905 * a + np.sqrt(1 - 0.905**2) * b])
    found = B.near_vectors(table(spark, [(k, v.tolist()) for k, v in enumerate(pairs)])).agg(F.sum("n_links")).first()[0]
    true = int((B.unit_vectors(pairs) @ B.unit_vectors(pairs).T >= 0.9).sum()) - 1200
    assert true >= 1200 and 0.99 * true <= found <= true


def test_band_plan_grows_with_the_data():
    plans = [B.band_plan(n, 0.9, 0.97, 256) for n in (10, 10**5, 10**9)]
    assert plans[0][0] < plans[1][0] < plans[2][0]
    for bits, bands in plans:
        assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** bands >= 0.97


def test_cover_tree_covers():
    x = clusters(2, 8, 200, 300, dims=6)
    def walk(node):
        assert np.sqrt(((x[node.members] - node.center) ** 2).sum(1)).max() <= node.radius
        below = np.concatenate([node.loose, *(c.members for c in node.children)])
        assert sorted(below) == sorted(node.members)
        for c in node.children:
            assert c.radius <= node.radius / 2 * (1 + 1e-6)
            walk(c)
    walk(cover_tree(x, np.arange(len(x))))


@pytest.mark.parametrize("k", [1, 5, 700])
def test_search_equals_brute_force(k):
    x = np.floor(256 * clusters(4, 5, 100, 150, dims=8)).astype(int)
    uids = np.arange(len(x))
    rows, scores = exact_search(x[::7], uids[::7], x, uids, k)
    for q, place in enumerate(uids[::7]):
        want = sorted((-int(x[place] @ x[j]), j) for j in uids if j != place)[:k]
        n = len(want)
        assert [int(j) for j in rows[q][:n]] == [j for _, j in want] and scores[q][:n].tolist() == [-s for s, _ in want]
        assert (rows[q][n:] == -1).all()


def test_wide_components_and_blocks(spark):
    big = np.array([[2**40, 1], [2**40, -1], [3, 2**41]])
    rows, scores = exact_search(big, np.arange(3), big, np.arange(3), 2)
    assert rows[0].tolist() == [2, 1] or scores[0][0] == 2**63 - 1
    x = clusters(6, 4, 30, 60, dims=8)
    df = table(spark, [(k * 10, v.tolist()) for k, v in enumerate(x)])
    assert rows_of(top_k(df, query_block=5, data_block=40)) == rows_of(top_k(df))


def test_groups_skip_nodes_of_clustered_data(spark, monkeypatch):
    """Twenty far clusters as blocks of their own: most pairs of nodes are never asked for, and nothing is lost."""
    x = clusters(8, 20, 60, 0, dims=8, noise=0.02)
    df = table(spark, [(k, v.tolist()) for k, v in enumerate(x)])
    asked = []
    plain = D.with_partners
    monkeypatch.setattr(D, "with_partners", lambda *a: asked.append(plain(*a)) or asked[-1])
    got = rows_of(top_k(df, every=10, data_block=60, query_block=30))
    whole = np.floor(256 * x).astype(np.int64)
    want = []
    for q in range(0, len(x), 10):
        inner = whole @ whole[q]
        best = sorted((j for j in range(len(x)) if j != q), key=lambda j: (-inner[j], j))[:5]
        want += [(q, r, j, int(inner[j])) for r, j in enumerate(best, 1)]
    assert got == sorted(want, key=str)
    pairs = sum(len(r.nodes) for a in asked for r in a.collect())
    nodes = len({n for a in asked for r in a.collect() for n in r.nodes})
    assert nodes >= 15 and pairs < 0.5 * asked[0].count() * nodes
