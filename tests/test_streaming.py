import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from helpers import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbarge.operators.batching import cut_batches
from logbarge.sinks import PushOptions, push_sink
from logbarge.sources import stream_events
from logbarge.streaming import ParallelCut, StageTimes, cut_batches_stream, drain_open, next_batches, stage_times, use_rocksdb

SCHEMA = "seq bigint, shard string, ts_ms bigint, nanos_in_ms int, level string, line string"


def write_parts(spark, path, parts, rows):
    for p in range(parts):
        df = spark.range(p * rows, (p + 1) * rows).select(
            F.col("id").alias("seq"), F.concat(F.lit("s"), F.col("id") % 3).alias("shard"), F.col("id").alias("ts_ms"),
            F.lit(0).alias("nanos_in_ms"), F.concat(F.lit("l"), F.col("id") % 4).alias("level"),
            F.repeat(F.lit("x"), (F.col("id") % 17).cast("int")).alias("line"),
        )
        df.repartition(1, F.rand(1)).write.mode("append").json(path)
        time.sleep(0.05)


def as_records(df):
    return df.select(
        "seq", "shard", "ts_ms", "nanos_in_ms", F.create_map(F.lit("level"), "level").alias("labels"), "line",
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def run(query_df, path, **trigger):
    return (query_df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state")
            .trigger(**trigger).start())


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    use_rocksdb(spark)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("parts"))
    write_parts(spark, path, 4, 100)
    return path


def test_same_batches_as_the_table(spark, parts, tmp_path):
    stream = as_records(stream_events(spark, parts, "json", SCHEMA, max_files=1))
    query = run(cut_batches_stream(stream, ["shard"], max_items=9, max_bytes=350), tmp_path, availableNow=True)
    query.awaitTermination()
    table = cut_batches(as_records(spark.read.schema(SCHEMA).json(parts)), ["shard"], max_items=9, max_bytes=350,
                        drain_on_stop=False)
    got = spark.read.parquet(f"{tmp_path}/out")
    key = ("shard", "seq", "batch_no", "condition", "line")
    assert sorted(values(got, *key)) == sorted(values(table, *key))
    assert {"MAX_ITEMS", "MAX_BYTES"} == set(values(got, "condition"))
    every = cut_batches(as_records(spark.read.schema(SCHEMA).json(parts)), ["shard"], max_items=9, max_bytes=350)
    drained = drain_open(spark, f"{tmp_path}/state", ["shard"])
    assert values(drained.select("condition").distinct(), "condition") == ["DRAIN"]
    assert sorted(values(got.unionByName(drained), *key)) == sorted(values(every, *key))
    assert sorted(values(drained.where("seq = 399"), "labels")) == [{"level": "l3"}]
    times = stage_times(spark, query)
    assert times.select("trigger_no").distinct().count() >= 4
    assert {"addBatch", "triggerExecution"} <= set(values(times, "stage"))


def test_lanes_keep_every_record(spark, parts, tmp_path):
    stream = as_records(stream_events(spark, parts, "json", SCHEMA, max_files=4))
    query = run(cut_batches_stream(stream, ["shard"], max_items=1, lanes=4), tmp_path, availableNow=True)
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(values(got, "seq")) == list(range(400))
    assert got.select("shard", "lane").distinct().count() == 12


def test_idle_drain_and_listener(spark, tmp_path):
    source = str(tmp_path / "in")
    write_parts(spark, source, 1, 30)
    listener = StageTimes(spark, str(tmp_path / "times"))
    spark.streams.addListener(listener)
    stream = as_records(stream_events(spark, source, "json", SCHEMA))
    query = run(cut_batches_stream(stream, ["shard"], max_items=8, timeout_ms=300), tmp_path, processingTime="200 milliseconds")
    try:
        deadline, got = time.time() + 60, []
        while len(got) < 30 and time.time() < deadline:
            time.sleep(0.5)
            try:
                got = values(spark.read.parquet(f"{tmp_path}/out"), "seq", "batch_no", "condition", "shard")
            except Exception:
                got = []
    finally:
        query.stop()
        time.sleep(1)
        spark.streams.removeListener(listener)
    assert sorted(r[0] for r in got) == list(range(30))
    by_shard = {s: sorted((b, c) for _, b, c, k in got if k == s) for s in ("s0", "s1", "s2")}
    assert all(v == [(0, "MAX_ITEMS")] * 8 + [(1, "DRAIN")] * 2 for v in by_shard.values())
    assert spark.read.parquet(str(tmp_path / "times")).filter("stage = 'addBatch'").count() > 0


def test_stream_to_push_sink(spark, parts, tmp_path):
    folder = str(tmp_path / "seen")
    (tmp_path / "seen").mkdir()

    def transport(body, headers):
        with open(f"{folder}/{headers['Idempotency-Key'].replace('/', '-')}", "wb") as f:
            f.write(body)
        return 204, ""

    spark.dataSource.register(push_sink(transport, PushOptions(payload="line", keys=("shard",)), "stream_push"))
    rows = stream_events(spark, parts, "json", SCHEMA, max_files=2).withColumn("batch_no", F.col("seq"))
    query = (rows.writeStream.format("stream_push").option("checkpointLocation", f"{tmp_path}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert len(list((tmp_path / "seen").iterdir())) == 400


KEY = ("shard", "seq", "batch_no", "condition", "line")


def test_null_shards_are_drained(spark, tmp_path):
    df = spark.range(12).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "a").alias("shard"), F.col("id").alias("ts_ms"), F.lit(0).alias("nanos_in_ms"),
        F.lit("l").alias("level"), F.lit("x").alias("line"),
    )
    df.coalesce(1).write.json(f"{tmp_path}/in")
    stream = as_records(stream_events(spark, f"{tmp_path}/in", "json", SCHEMA))
    run(cut_batches_stream(stream, ["shard"], max_items=4), tmp_path, availableNow=True).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").unionByName(drain_open(spark, f"{tmp_path}/state", ["shard"]))
    assert sorted(values(rows, "seq")) == list(range(12))
    assert sorted(values(rows.where("condition = 'DRAIN'"), "seq", "batch_no")) == [(8, 1), (9, 1), (10, 1), (11, 1)]


def test_a_record_without_size_ends_the_query(spark, tmp_path):
    spark.range(3).selectExpr("id seq", "'s' shard", "id ts_ms", "0 nanos_in_ms", "'l' level").write.json(f"{tmp_path}/in")
    stream = as_records(stream_events(spark, f"{tmp_path}/in", "json", SCHEMA))
    query = run(cut_batches_stream(stream, ["shard"], max_items=4), tmp_path, availableNow=True)
    with pytest.raises(Exception, match="no size"):
        query.awaitTermination()


@pytest.mark.parametrize("keys, timeout", [(["shard"], None), ([], 40)])
def test_parallel_cut_equals_the_table(spark, parts, tmp_path, keys, timeout):
    """Four triggers, small chunks; the idle drain by event time needs the clock of the trigger before."""
    cut = ParallelCut(f"{tmp_path}/out", keys, max_items=9, max_bytes=350, timeout_ms=timeout, chunk_rows=16, group_chunks=2, block_rows=32)
    stream = as_records(stream_events(spark, parts, "json", SCHEMA, max_files=1))
    stream = stream.withColumn("ts_ms", F.col("ts_ms") + F.when(F.col("seq") % 37 == 0, 50).otherwise(0))
    cut.start(stream, f"{tmp_path}/state").awaitTermination()
    table = as_records(spark.read.schema(SCHEMA).json(parts))
    table = table.withColumn("ts_ms", F.col("ts_ms") + F.when(F.col("seq") % 37 == 0, 50).otherwise(0))
    options = {"max_items": 9, "max_bytes": 350, "timeout_ms": timeout}
    closed = cut_batches(table, keys, drain_on_stop=False, **options)
    got = cut.rows(spark, "batch")
    assert sorted(values(got, *KEY)) == sorted(values(closed, *KEY))
    assert len(spark.read.parquet(f"{tmp_path}/out/commits").collect()) == 4
    assert sorted(values(got.unionByName(cut.rows(spark, "open"), allowMissingColumns=True), "seq")) == list(range(400))
    cut.drain(spark)
    cut.drain(spark)
    assert sorted(values(cut.rows(spark, "batch"), *KEY)) == sorted(values(cut_batches(table, keys, **options), *KEY))
    assert cut.rows(spark, "open").count() == 0


def holed(spark, begin, end):
    return as_records(spark.range(begin, end).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), F.col("id") % 2)).alias("shard"), F.col("id").alias("ts_ms"),
        F.lit(0).alias("nanos_in_ms"), F.lit("l").alias("level"), F.when(F.col("id") % 7 != 0, F.repeat(F.lit("x"), F.when(F.col("id") % 13 == 0, 500).otherwise(3))).alias("line"),
    )).withColumn("seq", F.when(F.col("seq") != 5, F.col("seq")))


def test_parallel_cut_sets_bad_records_aside_and_goes_on_after_a_drain(spark, tmp_path):
    cut = ParallelCut(str(tmp_path), ["shard"], max_items=10, max_bytes=400)
    step = lambda begin, end, trigger: cut.cut(cut._judged(holed(spark, begin, end)), trigger)
    step(0, 50, 0)
    step(50, 90, 1)
    first = {s: sorted(map(str, cut.rows(spark, s).collect())) for s in ("batch", "open", "refused", "bad")}
    step(50, 90, 1)  # a trigger that is run again
    assert {s: sorted(map(str, cut.rows(spark, s).collect())) for s in first} == first
    cut.drain(spark)
    step(90, 130, 2)
    step(130, 130, 3)  # a trigger without rows
    cut.drain(spark)
    batch, bad, refused = (cut.rows(spark, s) for s in ("batch", "bad", "refused"))
    reasons = {}
    for seq, reason, ts in values(bad, "seq", "reason", "ts_ms"):
        reasons.setdefault(reason, []).append(ts)
    ids = range(130)
    assert reasons["no order"] == [5] and sorted(reasons["no shard"]) == [i for i in ids if i % 11 == 0]
    assert sorted(reasons["no line"]) == [i for i in ids if i % 7 == 0 and i % 11]
    assert sorted(values(refused, "seq")) == [i for i in ids if i % 13 == 0 and i % 7 and i % 11]
    assert len(values(batch, "seq")) + bad.count() + refused.count() == 130
    for shard in ("s0", "s1"):
        mine = sorted(values(batch.where(F.col("shard") == shard), "batch_no", "seq", "condition"))
        numbers = [b for b, _, _ in mine]
        assert sorted(set(numbers)) == list(range(max(numbers) + 1)) and [s for _, s, _ in mine] == sorted(s for _, s, _ in mine)
        drained = sorted({b for b, _, c in mine if c == "DRAIN"})
        assert len(drained) == 2 and drained[-1] == max(numbers)
        assert all(numbers.count(b) == 10 for b in set(numbers) - set(drained))


def test_a_new_stream_goes_on_with_the_numbers(spark, tmp_path):
    """Drained and handed over to a checkpoint of its own; one shard is null, one appears later."""
    for part, begin in (("one", 0), ("two", 50)):
        spark.range(begin, begin + 50).select(
            F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "a").when(F.col("id") > 80, "new").alias("shard"), F.col("id").alias("ts_ms"),
            F.lit(0).alias("nanos_in_ms"), F.lit("l").alias("level"), F.lit("x").alias("line"),
        ).coalesce(1).write.json(f"{tmp_path}/{part}/in")
    rows, continues = [], None
    for part in ("one", "two"):
        stream = as_records(stream_events(spark, f"{tmp_path}/{part}/in", "json", SCHEMA))
        run(cut_batches_stream(stream, ["shard"], max_items=10, continues=continues), f"{tmp_path}/{part}", availableNow=True).awaitTermination()
        closed = spark.read.parquet(f"{tmp_path}/{part}/out")
        rows += values(closed.unionByName(drain_open(spark, f"{tmp_path}/{part}/state", ["shard"])), "shard", "batch_no", "seq")
        continues = next_batches(spark, f"{tmp_path}/{part}/state", ["shard"])
        continues.write.parquet(f"{tmp_path}/{part}/next")
        continues = spark.read.parquet(f"{tmp_path}/{part}/next")
    assert sorted(r[2] for r in rows) == list(range(100))
    numbers = {s: sorted({b for shard, b, _ in rows if shard == s}) for s in ("a", None, "new")}
    assert numbers == {"a": list(range(6)), None: list(range(5)), "new": [0]}
    for shard, found in numbers.items():
        assert all(max(q for s, b, q in rows if s == shard and b == n) < min(q for s, b, q in rows if s == shard and b == n + 1) for n in found[:-1])
    assert sorted(values(continues, "next_batch")) == [1, 5, 6]


def test_packed_rows_take_little_memory_and_come_back():
    """Texts are in Arrow buffers, repeated ones once; nulls and other types stay."""
    from logbarge.streaming.batches import Packed

    schema = T.StructType.fromDDL("seq bigint, shard string, labels string, line string, n int, at timestamp, ok boolean")
    packed, n = Packed(schema, ["shard", "labels"]), 2_000
    before = pa.total_allocated_bytes()
    for part in range(25):
        ids = range(part * n, part * n + n)
        packed.add(pd.DataFrame({
            "seq": ids, "shard": [None if i % 3 == 0 else f"s{i % 2}" for i in ids], "labels": [f"{'x' * 200}{i % 5}" for i in ids],
            "line": [None if i % 7 == 0 else f"line {i}" for i in ids], "n": [None if i % 2 else i for i in ids],
            "at": pd.to_datetime(list(ids), unit="s"), "ok": [i % 2 == 0 for i in ids],
        }))
    packed.closed()
    assert packed.rows == 25 * n and (pa.total_allocated_bytes() - before) / packed.rows < 70
    places = np.array([49_999, 0, 21, 25_000])
    want = [(i, None if i % 3 == 0 else f"s{i % 2}", f"{'x' * 200}{i % 5}", None if i % 7 == 0 else f"line {i}", None if i % 2 else i, pd.Timestamp(i, unit="s"), i % 2 == 0) for i in places.tolist()]
    assert packed.tuples(places) == want
    frame = packed.frame(places)
    assert list(frame.columns) == schema.names and list(frame.itertuples(index=False, name=None)) == want
    codes = packed.codes("shard")
    assert codes[0] == codes[3] and len({codes[0], codes[1], codes[2]}) == 3


def test_a_trigger_larger_than_a_frame(spark, tmp_path):
    """All of a shard's rows in one trigger, out of order and in many files, leave in frames and keep their batches."""
    df = spark.range(25_000).select(
        F.col("id").alias("seq"), F.lit("s").alias("shard"), F.col("id").alias("ts_ms"), F.lit(0).alias("nanos_in_ms"),
        F.concat(F.lit("l"), F.col("id") % 4).alias("level"), F.repeat(F.lit("x"), (F.col("id") % 17).cast("int")).alias("line"),
    )
    df.repartition(4, F.rand(1)).write.json(f"{tmp_path}/in")
    stream = as_records(stream_events(spark, f"{tmp_path}/in", "json", SCHEMA, max_files=10))
    run(cut_batches_stream(stream, ["shard"], max_items=90, max_bytes=3500), tmp_path, availableNow=True).awaitTermination()
    table = cut_batches(as_records(df), ["shard"], max_items=90, max_bytes=3500, drain_on_stop=False)
    assert sorted(values(spark.read.parquet(f"{tmp_path}/out"), *KEY)) == sorted(values(table, *KEY))


def test_rows_of_few_files_are_shaped_on_all_cores(spark, tmp_path):
    """One file is one task until its rows are spread; the same rows come out."""
    spark.range(2_000).selectExpr("id seq", "'s' shard", "id ts_ms", "0 nanos_in_ms", "'l' level", "'x' line").coalesce(1).write.json(f"{tmp_path}/in")
    found = {}
    for name, by in (("whole", None), ("spread", "seq")):
        stream = as_records(stream_events(spark, f"{tmp_path}/in", "json", SCHEMA, spread_by=by)).withColumn("task", F.spark_partition_id())
        run(stream.drop("labels", "metadata"), f"{tmp_path}/{name}", availableNow=True).awaitTermination()
        out = spark.read.parquet(f"{tmp_path}/{name}/out")
        found[name] = (sorted(values(out, "seq")), out.select("task").distinct().count())
    assert found["whole"] == (list(range(2_000)), 1)
    assert found["spread"] == (list(range(2_000)), spark.sparkContext.defaultParallelism)


def test_arrivals_of_the_catalog_are_spread(spark, sf, tmp_path):
    from logbarge.plans.catalog import _arrivals

    stream = next(iter(_arrivals(spark, sf, str(tmp_path))))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [event_id" in plan and f", {spark.sparkContext.defaultParallelism}" in plan
