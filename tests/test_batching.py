import random

import numpy as np
import pytest
from helpers import LINE, events, records, three_events, values
from pyspark.sql import functions as F

from logbarge.operators.batching import cut_batches, cut_by_count, summarize_batches
from logbarge.operators.cutting import Limits, Run, batches, compose, furthest, transfer
from logbarge.operators.position import block_width, with_position
from logbarge.operators.projection import project_records
from logbarge.operators.sizing import split_oversize, with_size


def fold(rows, max_items, max_bytes, timeout_ms=None, drain=True):
    """One record after the other: rows of (own bytes, stream, stream bytes, ts)."""
    out, batch, size, streams, number = [], [], 0, set(), 0
    clock = rows[0][3] if rows else 0

    def close(why, at):
        nonlocal batch, size, streams, number, clock
        out.extend((i, number, why) for i in batch)
        batch, size, streams, number, clock = [], 0, set(), number + 1, at

    for i, (own, stream, stream_bytes, ts) in enumerate(rows):
        if timeout_ms is not None and batch and ts - clock > timeout_ms:
            close("DRAIN", ts)
        cost = own + (0 if stream in streams else stream_bytes)
        if batch and size + cost > max_bytes:
            close("MAX_BYTES", ts)
            cost = own + stream_bytes
        batch.append(i)
        size += cost
        streams.add(stream)
        if len(batch) == max_items:
            close("MAX_ITEMS", ts)
    if batch and drain:
        close("DRAIN", clock)
    return out


def random_rows(rng, n, in_order):
    sizes = {s: rng.randint(5, 60) for s in range(rng.randint(1, 12))}
    ts, rows = 0, []
    for _ in range(n):
        ts += rng.choice([0, 1, 5, 40])
        s = rng.choice(list(sizes))
        rows.append((rng.randint(24, 90), s, sizes[s], ts if in_order else ts - rng.randint(0, 60)))
    return rows


def run_of(rows, before=None):
    own, streams, stream_bytes, ts = (np.array(c) for c in zip(*rows))
    return Run(own, streams, stream_bytes, ts, before)


@pytest.mark.parametrize("seed", range(40))
def test_chunks_agree_with_one_pass(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randint(1, 400), seed % 2 == 0)
    limits = Limits(rng.choice([1, 3, 10, 50]), rng.choice([130, 400, 2000, 10**6]), rng.choice([None, 30, 200]))
    want = fold(rows, limits.max_items, limits.max_bytes, limits.timeout_ms)
    size = max(limits.max_items, rng.choice([5, 20, 64]))
    chunks = []
    for at in range(0, len(rows), size):
        run = run_of(rows[at:at + size + limits.max_items], rows[at - 1][3] if at else None)
        chunks.append((run, min(size, len(rows) - at), at))
    got, state, number, tables = [], 0, 0, []
    for c, (run, own, at) in enumerate(chunks):
        start, by_items = divmod(state, limits.clocks)
        clock = run.clock(start, by_items) if limits.timeout_ms is not None and start < own else None
        for begin, end, why in batches(run, start, own, clock, limits):
            got.extend((at + i, number, why or "DRAIN") for i in range(begin, end))
            number += 1
        if c < len(chunks) - 1:
            exits, counts = transfer(run, own, limits)
            tables.append((exits, counts))
            state = int(exits[state])
            exits, counts = compose(tables)
            assert (state, number) == (int(exits[0]), int(counts[0]))
    assert got == want


def spark_rows(spark, rows):
    df = spark.createDataFrame(
        [(i, r[3], f"s{r[1]}", r[0], 0, r[2]) for i, r in enumerate(rows)],
        "seq bigint, ts_ms bigint, stream_key string, msg_sz int, meta_sz int, stream_sz int",
    )
    return df.withColumn("shard", F.lit("x"))


@pytest.mark.parametrize("seed, timeout, drain", [(1, None, True), (2, 60, True), (3, None, False), (4, 300, False)])
def test_cut_batches(spark, seed, timeout, drain):
    rng = random.Random(seed)
    rows = random_rows(rng, 900, seed != 4)
    df = spark_rows(spark, rows)
    cut = cut_batches(df, ["shard"], max_items=12, max_bytes=700, timeout_ms=timeout, drain_on_stop=drain,
                      chunk_rows=40, group_chunks=3, block_rows=64)
    got = sorted(values(cut, "seq", "batch_no", "condition"))
    assert got == fold(rows, 12, 700, timeout, drain)
    one = cut_batches(df, [], max_items=12, max_bytes=700, timeout_ms=timeout, drain_on_stop=drain)
    assert sorted(values(one, "seq", "batch_no", "condition")) == got


def test_several_shards_and_sparse_order(spark):
    rng = random.Random(9)
    rows = random_rows(rng, 300, True)
    df = spark_rows(spark, rows).withColumn("shard", F.concat(F.lit("k"), F.col("seq") % 3)).withColumn(
        "seq", F.col("seq") * 1_000_000_007 - 10**12
    )
    cut = cut_batches(df, ["shard"], max_items=7, max_bytes=500, chunk_rows=16, block_rows=10**10)
    for k in range(3):
        got = [r[1:] for r in sorted(values(cut.filter(f"shard = 'k{k}'"), "seq", "batch_no", "condition"))]
        assert got == [r[1:] for r in fold(rows[k::3], 7, 500)]


def test_positions(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 7).alias("k"))
    got = with_position(df, "seq", ["k"], 64)
    assert got.filter(F.col("pos") != F.expr("seq div 7")).count() == 0
    assert set(values(got.select("k", "shard_rows").distinct(), "k", "shard_rows")) == {
        (k, len(range(k, 1000, 7))) for k in range(7)
    }
    assert sorted(values(with_position(df.withColumn("seq", F.col("seq") - 500), "seq", (), 64), "pos")) == list(range(1000))


def sized(spark, *lines, **limits):
    df = records(spark, *({"labels": {"a": "b"}, "line": line, "ts_ms": i} for i, line in enumerate(lines)))
    return cut_batches(df, **limits)


def test_count_cut(spark):
    df = sized(spark, *["m"] * 20, max_items=10)
    assert sorted(values(df, "batch_no", "condition")) == [(0, "MAX_ITEMS")] * 10 + [(1, "MAX_ITEMS")] * 10
    df = cut_by_count(records(spark, *[{}] * 25), max_items=10)
    got = df.groupBy("batch_no", "condition").count()
    assert sorted(values(got, "batch_no", "condition", "count")) == [(0, "MAX_ITEMS", 10), (1, "MAX_ITEMS", 10), (2, "DRAIN", 5)]
    assert cut_by_count(records(spark, *[{}] * 25), max_items=10, drain_on_stop=False).count() == 20


def test_bytes_cut_and_summary(spark):
    df = sized(spark, "123", "abcdefghkl", "qwertyuiop", max_items=10, max_bytes=100)
    assert sorted(values(df, "seq", "batch_no", "condition")) == [(0, 0, "MAX_BYTES"), (1, 0, "MAX_BYTES"), (2, 1, "DRAIN")]
    got = summarize_batches(df)
    assert sorted(values(got, "batch_no", "items", "streams", "est_bytes")) == [(0, 2, 1, 71), (1, 1, 1, 44)]


def test_sizes_and_oversize(spark):
    df = with_size(records(spark, {"labels": {"a": "b"}, "line": "3456789", "metadata": {"k": "ю"}}))
    assert values(df, "msg_sz", "meta_sz", "stream_sz") == [(31, 3 + 24 + 4, 10)]
    df = records(spark, {"labels": {"a": "b"}, "line": "3456789"})
    for limit, kept in ((41, 1), (40, 0), (10, 0)):
        good, bad = split_oversize(df, limit)
        assert (good.count(), bad.count()) == (kept, 1 - kept)


def test_oversize_in_flow(spark):
    long = {"message": "x" * 720, "ts_ms": 105}
    df = three_events(spark).unionAll(events(spark, {**long, "seq": 10}))
    kept, refused = split_oversize(project_records(df, "level=%level\napp=store", "off", LINE), 500)
    cut = cut_batches(kept, max_items=3, max_bytes=500)
    assert set(values(cut, "condition")) == {"MAX_ITEMS"} and cut.count() == 3 and refused.count() == 1


def test_stop_without_drain(spark):
    rec = project_records(three_events(spark), "level=%level", "off", LINE)
    assert cut_batches(rec, max_items=30, drain_on_stop=False).count() == 0
    assert cut_batches(rec, max_items=30).count() == 3


def test_first_record_is_always_taken(spark):
    df = sized(spark, "x" * 50, "y" * 50, "z", max_items=10, max_bytes=40)
    assert sorted(values(df, "seq", "batch_no", "condition")) == [(0, 0, "MAX_BYTES"), (1, 1, "MAX_BYTES"), (2, 2, "DRAIN")]


def test_empty_input(spark):
    assert sized(spark, "a").filter("seq > 5").count() == 0
    assert cut_batches(records(spark, {}).filter("seq > 5")).count() == 0


def test_unusable_order_is_refused(spark):
    rows = spark_rows(spark, random_rows(random.Random(1), 20, True))
    with pytest.raises(Exception, match="not unique"):
        cut_batches(rows.withColumn("seq", F.col("seq") % 10), ["shard"]).collect()
    with pytest.raises(Exception, match="not unique"):
        cut_by_count(rows.withColumn("seq", F.col("seq") % 10), ["shard"]).collect()
    with pytest.raises(Exception, match="must not be null"):
        cut_batches(rows.withColumn("shard", F.when(F.col("seq") > 3, F.col("shard"))), ["shard"]).collect()
    with pytest.raises(Exception, match="must not be null"):
        cut_by_count(rows.withColumn("seq", F.when(F.col("seq") > 3, F.col("seq")))).collect()


def test_sparse_order_fails_loudly(spark, monkeypatch):
    monkeypatch.setattr("logbarge.operators.position.MANY_BLOCKS", 50)
    df = spark.range(100).select((F.col("id") * 1000).alias("seq"))
    with pytest.raises(Exception, match="block_width"):
        with_position(df, block_rows=1000).collect()
    assert with_position(df, block_rows=block_width(df, "seq", 20)).count() == 100


def test_block_width(spark):
    df = spark.range(1000).select((F.col("id") * 1_000_000).alias("seq"))
    assert 9_900_000 < block_width(df, "seq", 10) <= 10_000_000
    assert block_width(spark.range(1000).withColumnRenamed("id", "seq"), "seq", 10) == 10
    assert block_width(df.filter("seq < 0"), "seq", 10) == 10


def test_all_ends_at_once():
    """The ends found for all starts are those of a plain walk from each start."""
    draw = np.random.default_rng(9)
    for _ in range(300):
        n, kinds = int(draw.integers(1, 400)), int(draw.integers(1, 12))
        limits = Limits(int(draw.integers(1, 60)), int(draw.integers(1, 700)))
        streams = draw.integers(0, kinds, n)
        run = Run(draw.integers(0, 50, n), streams, draw.integers(0, 40, kinds)[streams])
        own = int(draw.integers(0, n + 1))
        ends = furthest(run, own, limits)
        for p in range(own):
            total, seen, q = 0, set(), p
            while q < min(p + limits.max_items, n):
                cost = run.own_bytes[q] + (0 if streams[q] in seen else run.stream_bytes[q])
                if q > p and total + cost > limits.max_bytes:
                    break
                total, q = total + cost, q + 1
                seen.add(streams[q - 1])
            assert ends[p] == q


def test_a_record_without_size_is_an_error(spark):
    df = records(spark, {"line": "a"}, {"line": None}, {"line": "b"})
    with pytest.raises(Exception, match="no size"):
        cut_batches(df, max_bytes=100).collect()
