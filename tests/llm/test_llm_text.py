import collections
import math
import random

import numpy as np
import pytest
from llm_helpers import documents, rows_of
from pyspark.sql import functions as F

from logbarge.llm import kneser_ney as K
from logbarge.llm import prob_minhash as P
from logbarge.llm.mixing import mix_sources, poisson_steps, source_rates


def shingles(text):
    w = (text or "").lower().split()
    grams = [tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    return {g: 1 + math.log(n) for g, n in collections.Counter(grams).items()}


def jaccard(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in both) for i in x if i in y)


def text_of(draw, n):
    return " ".join(draw.choice("abcdefghij") * draw.randint(1, 4) for _ in range(n))


def changed(draw, text, p):
    return " ".join("zz" + str(draw.random()) if draw.random() < p else w for w in text.split())


def test_probability_jaccard_and_its_estimate():
    draw, off = random.Random(5), []
    for _ in range(40):
        a = text_of(draw, draw.randint(3, 60))
        b = changed(draw, a, draw.choice([0, 0.02, 0.1]))
        docs, keys, counts = P.weighted_shingles([a, b])
        sides = [(keys[docs == d], P.weights_of(counts[docs == d])) for d in (0, 1)]
        true = jaccard(shingles(a), shingles(b))
        assert P.probability_jaccard(*sides) == pytest.approx(true)
        registers = P.signatures(2, docs, keys, P.weights_of(counts), 3000)
        off.append((registers[0] == registers[1]).mean() - true)
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 0.06


def groups_by_brute_force(texts):
    sets, head = [shingles(t) for t in texts], list(range(len(texts)))

    def find(k):
        while head[k] != k:
            k = head[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                head[b] = a
    return {k: find(k) for k in range(len(texts))}


@pytest.mark.parametrize("block, limit", [(512, 64 << 20), (4, 0)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block, limit):
    """Chains of changes, a crowd of near copies, copies, short and empty texts; also in small blocks and without broadcasts."""
    monkeypatch.setattr(P, "BLOCK", block)
    draw = random.Random(8)
    texts = [None, "", " \n", "one two", "One  TWO", "one two three", "x" * 70_000]
    base = text_of(draw, 120)
    texts += [base, base, base.upper()] + [changed(draw, base, 0.02) for _ in range(30)]
    for _ in range(4):
        link = text_of(draw, 150)
        for _ in range(5):
            texts.append(link)
            link = changed(draw, link, 0.018)
    texts += [text_of(draw, draw.randint(5, 200)) for _ in range(40)]
    docs = documents(spark, *texts).withColumns({"a.b`c": F.lit(1), "band": F.lit(1), "row_key": F.lit("x"), "kept": F.lit(False)})
    got = P.near_duplicates(docs, broadcast_bytes=limit)
    want = groups_by_brute_force(texts)
    assert {r.doc_id: r.group_id for r in got.collect()} == want
    assert rows_of(got.where("kept"), "doc_id") == sorted(((k,) for k in set(want.values())), key=str)
    clean = P.deduplicated(docs, broadcast_bytes=limit)
    assert clean.columns == docs.columns and rows_of(clean, "doc_id") == rows_of(got.where("kept"), "doc_id")


def test_repeated_rows_keep_one(spark):
    docs = documents(spark, (1, "a b c d e f", "en", "s"), (1, "a b c d e f", "en", "s"), (None, "a b c d e f", "en", "s"), (2, None, "en", "s"), (2, None, "en", "s"))
    assert rows_of(P.deduplicated(docs), "doc_id") == [(1,), (2,), (2,)]
    assert sorted(P.near_duplicates(docs).select("kept").toPandas().kept) == [False, False, True, True, True]


def brute_model(texts):
    """Interpolated modified Kneser-Ney of four characters, written out plainly."""
    counts = {4: collections.Counter()}
    for t in texts:
        s = "\x01\x01\x01" + t + "\x02"
        counts[4].update(s[k : k + 4] for k in range(len(s) - 3))
    for n in (3, 2, 1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])

    def off(n, c):
        of = collections.Counter(counts[n].values())
        n1, n2, n3, n4 = (of[k] + 0.5 for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        raw = {1: 1 - 2 * y * n2 / n1, 2: 2 - 3 * y * n3 / n2, 3: 3 - 4 * y * n4 / n3}[min(c, 3)]
        return min(max(raw, 0.1), float(min(c, 3)))

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        n = len(gram)
        same = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        free = sum(off(n, c) for c in same.values()) / total
        c = same.get(gram, 0)
        return (max(c - off(n, c), 0) / total if c else 0) + free * p(gram[1:])

    def score(text):
        s = "\x01\x01\x01" + text + "\x02"
        return -sum(math.log(p(s[k : k + 4])) for k in range(len(s) - 3)) / (len(s) - 3)

    return score


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    words = ["river", "stone", "green", "house", "walks", "slowly", "tree", "under", "light"]
    good = [" ".join(draw.choice(words) for _ in range(draw.randint(5, 30))) + "." for _ in range(60)]
    junk = ["XQ!! " * 20, "#$%^ " * 15]
    rows = [(k, t, "en", "s") for k, t in enumerate(good)] + [(100 + k, t, "en", "s") for k, t in enumerate(junk)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "rien", "fr", "s"), (203, "nada", None, "s"), (0, good[0], "en", "s"), (204, good[1] * 400, "en", "s"), (205, "日本 🏁", "en", "s")]
    docs = documents(spark, *rows).withColumns({"a.b": F.lit(1), "score": F.lit("mine"), "kept": F.lit(False), "limit": F.lit(1)})
    labels = [(k, 1, 0) for k in range(60)] + [(3, 1, 1), (100, 0, 0), (None, 1, 0), (5, None, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_scores_equal_a_plain_model(spark, corpus, limit):
    docs, labels, rows = corpus
    got = K.quality_scores(docs, labels, broadcast_bytes=limit).collect()
    held = {r[0] for r in spark.range(60).select("id", F.pmod(F.xxhash64("id"), F.lit(10)).alias("h")).where("h = 0").collect()}
    training = [r[1] for r in rows if r[0] < 60 and r[0] not in held | {3, 5}]
    score = brute_model(training)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        if r.doc_id in (200, 201, 202, 203):
            assert r.perplexity is None and r.kept
        else:
            assert math.log(r.perplexity) == pytest.approx(score(texts[r.doc_id]), abs=1e-9)
            assert r.kept == (r.perplexity <= r.limit)
    assert {r.doc_id for r in got if not r.kept} >= {100, 101} and all(r.kept for r in got if r.doc_id < 60)
    kept = K.good_documents(docs, labels, broadcast_bytes=limit)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got) and kept.where("score = 'mine'").count() == kept.count()


def test_no_labels_reject_nothing(spark, corpus):
    docs, labels, _ = corpus
    assert K.good_documents(docs, labels.limit(0)).count() == docs.count()


def test_repeated_words_are_rejected(spark):
    """A document of one word again and again, a little above the scores of good ones."""
    draw = random.Random(4)
    words = ["river", "stone", "green", "house", "walks", "slowly", "tree", "under", "light"]
    good = [" ".join(draw.choice(words) for _ in range(draw.randint(20, 200))) + "." for _ in range(200)]
    docs = documents(spark, *good, " ".join(["green"] * 150))
    got = K.quality_scores(docs, spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int"))
    assert rows_of(got.where("not kept"), "doc_id") == [(200,)]


def test_long_texts_are_cut_into_chunks(monkeypatch):
    text = "".join(random.Random(1).choice("abc é日") for _ in range(1000))
    whole = np.concatenate(list(K.grams_of(text)))
    monkeypatch.setattr(K, "CHUNK", 7)
    assert (np.concatenate(list(K.grams_of(text))) == whole).all() and len(whole) == 1001


def test_poisson_steps():
    for rate in (0.0, 0.1, 1.0, 7.3, 400.0):
        steps = poisson_steps(rate)
        assert steps == sorted(steps) and steps[-1] == pytest.approx(1, abs=1e-9)
        assert sum(1 - s for s in steps) == pytest.approx(rate, abs=1e-6)


def test_mix(spark):
    rows = [(k, "t", "en", ["big", "small", None, "other"][0 if k % 3 == 0 else k % 4]) for k in range(8000)]
    docs = documents(spark, *rows).withColumns({"COPY": F.lit("mine"), "mix_key": F.lit(1)})
    weights = {"big": 1.0, "small": 2.0, "absent": 5.0}
    got = mix_sources(docs, weights, other=1.0)
    assert got.columns == [*docs.columns, "copy_1", "mix_key_1"]
    n = {r["g"]: r["n"] for r in got.groupBy(F.when(F.col("source").isin("big", "small"), F.col("source")).alias("g")).agg(F.count("*").alias("n")).collect()}
    for group, share in (("big", 0.25), ("small", 0.5), (None, 0.25)):
        assert abs(n[group] - share * 8000) < 5 * (8000 * share * 4) ** 0.5
    assert {r["source"] for r in mix_sources(docs, {"small": 1.0}).select("source").distinct().collect()} == {"small"}
    assert rows_of(got) == rows_of(mix_sources(docs.repartition(7), weights, other=1.0))
    assert rows_of(got) != rows_of(mix_sources(docs, weights, "mix-2", other=1.0))
    order = [r["doc_id"] for r in mix_sources(docs, weights, partitions=1).collect()]
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.1
    rates = source_rates(docs, weights, "source", total=100)
    assert sum(rates[s] * docs.where(F.col("source") == s).count() for s in ("big", "small")) == pytest.approx(100)
    with pytest.raises(ValueError):
        source_rates(docs.limit(1), weights, "source", total=10**6)


def test_mix_of_rare_sources(spark):
    """A rare weighted source is repeated as often as its weight says; unlisted ones keep their share."""
    rows = [(k, "t", "en", {0: "rare", 1: None, 2: "odd"}.get(k, "big")) for k in range(5000)]
    got = mix_sources(documents(spark, *rows), {"big": 1.0, "rare": 1.0}, other=None)
    n = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(n["rare"] - 2499) < 5 * 2499**0.5 and abs(n["big"] - 2499) < 5 * 2499**0.5
    assert rows_of(got.where("source = 'rare'"), "copy") == sorted(((k,) for k in range(n["rare"])), key=str)
    rates = source_rates(documents(spark, *rows), {"big": 1.0}, "source", other=None)
    assert rates == {"big": 1.0, None: 1.0}
    copies = mix_sources(documents(spark, *rows), {"rare": 1.0, "big": 1.0}, other=1.0).where("source is null or source = 'odd'").count()
    assert abs(copies - 5000 / 3) < 5 * (2 * 5000 / 3) ** 0.5 * 2


def test_many_copies_of_one_document(spark):
    rows = [(0, "rare", "en", "rare"), (1, "big", "en", "big"), (2, "other", "en", None)]
    docs = documents(spark, *rows).withColumns({"copies": F.lit("x"), "first_copy": F.lit("y"), "a.b": F.lit("z")})
    got = mix_sources(docs, {"rare": 1.0, "big": 0.001}, total=300_000, other=0.001)
    counts = {r["doc_id"]: r for r in got.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("d"), F.max("copy").alias("m")).collect()}
    assert abs(counts[0]["n"] - 300_000) < 6_000 and abs(counts[1]["n"] - 300) < 120 and abs(counts[2]["n"] - 300) < 120
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in counts.values())
    assert got.columns == [*docs.columns, "copy", "mix_key"] and got.where("copies <> 'x' or first_copy <> 'y' or `a.b` <> 'z'").count() == 0
