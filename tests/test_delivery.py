import os
import time
import uuid

import pytest
from helpers import records, values
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logbarge.operators.batching import cut_by_count
from logbarge.operators.delivery import classify_attempts, dead_letters, delivery_outcomes, retry_delay, retry_schedule
from logbarge.operators.encoding import encode_json, encode_proto
from logbarge.operators.metrics import (
    THIN_STEPS,
    attempt_errors,
    delivery_metrics,
    distributions,
    dropped_counts,
    error_counts,
    merge_distributions,
    observe_payloads,
    quantiles,
    rank_error,
    thin_by_count,
    unsent,
)
from logbarge.sinks import (
    Ledger,
    PushOptions,
    file_transport,
    push_attempts,
    push_attempts_stream,
    push_sink,
    read_labelled,
    write_label_index,
    write_payloads,
    write_push,
)
from logbarge.streaming import use_rocksdb

NO_WAIT = PushOptions(min_ms=0, max_ms=0, jitter_ms=0)


def test_backoff(spark):
    df = spark.range(1, 6).select(F.col("id").cast("int").alias("r"))
    assert values(df.select(retry_delay("r", 1, 8).alias("d")), "d") == [1, 2, 4, 8, 8]
    assert values(df.select(retry_delay("r", 2, 2).alias("d")), "d") == [2] * 5
    assert values(spark.sql("select 500 r").select(retry_delay("r").alias("d")), "d") == [60000]
    rows = retry_schedule(spark.range(2).withColumnRenamed("id", "batch_no"), 1, 8, 3)
    assert sorted(values(rows, "batch_no", "retry", "delay_ms")) == [(b, r, d) for b in (0, 1) for r, d in ((1, 1), (2, 2), (3, 4))]
    jitter = retry_schedule(spark.range(500), 100, 100, 1, max_jitter_ms=50, seed=1).agg(F.min("delay_ms"), F.max("delay_ms")).first()
    assert 100 <= jitter[0] < jitter[1] < 150
    assert retry_schedule(spark.range(3), n=0).count() == 0


def attempts(spark, *codes):
    rows = [(0, i, c if isinstance(c, int) else None, c if isinstance(c, str) else None) for i, c in enumerate(codes)]
    return spark.createDataFrame(rows, "batch_no bigint, attempt int, status int, exception string")


C, T = "ConnectException", "HttpConnectTimeoutException"


@pytest.mark.parametrize(
    "codes, options, want",
    [
        ((C, C, C), {}, ("dropped", 2, "exception:ConnectException")),
        ((C, 204, 204), {}, ("delivered", 1, None)),
        ((T, T, T), {}, ("dropped", 2, f"exception:{T}")),
        ((429, 429, 429), {}, ("dropped", 2, "status:429")),
        ((429, 204), {"drop_rate_limited": True}, ("dropped", 0, "status:429")),
        ((500, 204), {}, ("dropped", 0, "status:500")),
        ((503, 200), {}, ("delivered", 1, None)),
        (("SSLException", 200), {}, ("dropped", 0, "exception:SSLException")),
        # a connect failure stays in force: the plain 500 after it is tried again
        ((C, 500, 204), {}, ("delivered", 2, None)),
        ((C, 500, 204), {"sticky": False}, ("dropped", 1, "status:500")),
        ((503, "SSLException", 204), {}, ("delivered", 2, None)),
        ((503, 503, 503, 204), {"max_retries": 3}, ("delivered", 3, None)),
        ((503, 204), {"max_retries": 0}, ("dropped", 0, "status:503")),
    ],
)
def test_outcomes(spark, codes, options, want):
    got = delivery_outcomes(classify_attempts(attempts(spark, *codes), **options))
    assert values(got, "state", "retries", "reason") == [want]


def test_dead_letters_and_metrics(spark):
    payloads = spark.createDataFrame(
        [("a", 0, 10, 100), ("a", 1, 20, 300), ("b", 0, 5, 50)], "shard string, batch_no bigint, items bigint, size_bytes int"
    )
    outcomes = spark.createDataFrame([("a", 0, "delivered"), ("a", 1, "dropped")], "shard string, batch_no bigint, state string")
    got = dead_letters(payloads, outcomes, ["shard"])
    assert sorted(values(got, "shard", "batch_no")) == [("a", 1), ("b", 0)]
    row = delivery_metrics(payloads, outcomes, ["shard"], ["shard"]).filter("shard = 'a'").first()
    assert (row.encoded_batches, row.encoded_events_total, row.encoded_bytes_total, row.encoded_bytes_max) == (2, 30, 400, 300)
    assert (row.sent_batches, row.sent_bytes_total, row.sent_bytes_count) == (1, 100, 1)
    assert sorted(values(unsent(payloads, outcomes, ["shard"]), "shard", "unsent_events")) == [("b", 5)]
    seen = Observation("payloads")
    observe_payloads(payloads, seen).count()
    assert seen.get["encoded_events_total"] == 35 and seen.get["encoded_batches"] == 3
    assert values(dropped_counts(payloads, ["shard"]).orderBy("shard"), "dropped_events") == [2, 1]


def test_error_counts(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "reason string")
    assert sorted(values(error_counts(df, "append"), "stage", "reason", "errors")) == [("append", "x", 2), ("append", "y", 1)]
    judged = classify_attempts(attempts(spark, 503, 429, 503))
    got = attempt_errors(judged, delivery_outcomes(judged), 2)
    assert sorted(values(got, "stage", "reason", "errors")) == [
        ("retry", "status:429", 1), ("retry", "status:503", 1), ("send", "status:503", 1)
    ]


def test_thin_report(spark):
    def kept(n):
        return n == 1 or any(n <= last and n % step == 0 for last, step in THIN_STEPS)

    df = spark.range(25_000).select(F.col("id").alias("seq"), F.lit("k").alias("k"))
    got = sorted(values(thin_by_count(df, ["k"], block_rows=1000), "count"))
    assert got == [n for n in range(1, 25_001) if kept(n)]
    assert got[:8] == [1, 20, 40, 60, 80, 100, 200, 300]


def payloads(spark, n=6):
    return spark.range(n).select(
        F.col("id").alias("batch_no"), F.lit("s").alias("shard"), F.concat(F.lit("body"), "id").alias("payload_json"),
        F.when(F.col("id") == 0, "t1").alias("tenant"),
    )


def recording(path):
    """A transport that writes down what it gets and fails by batch number."""

    def send(body, headers):
        batch, attempt = int(headers["Idempotency-Key"].split("/")[-1]), int(headers["Retry-Attempt"])
        with open(f"{path}/{batch}-{attempt}", "w") as f:
            f.write(repr((body, sorted(headers.items()))))
        if batch == 1:
            raise ConnectionRefusedError("no")
        if batch == 2:
            raise ValueError("bad")
        if batch == 3:
            return (503, "later") if attempt == 0 else (204, "")
        return (500, "broken") if batch == 4 else (204, "")

    return send


WANT = [(0, 0, 204, None), (1, 0, None, "ConnectionRefusedError"), (1, 1, None, "ConnectionRefusedError"),
        (1, 2, None, "ConnectionRefusedError"), (2, 0, None, "ValueError"), (3, 0, 503, None), (3, 1, 204, None),
        (4, 0, 500, None), (5, 0, 204, None)]


def test_push_attempts(spark, tmp_path):
    options = PushOptions(keys=("shard",), run_id="r1", username="u", password="p", tenant="t0", min_ms=0, max_ms=0, jitter_ms=0)
    out = str(tmp_path / "attempts")
    seen = tmp_path / "seen"
    seen.mkdir()
    write_push(payloads(spark), recording(str(seen)), options, out)
    got = spark.read.parquet(out)
    assert sorted(values(got, "batch_no", "attempt", "status", "exception"), key=str) == sorted(WANT, key=str)
    judged = delivery_outcomes(classify_attempts(got, ["shard"]), ["shard"])
    assert sorted(values(judged.filter("state = 'delivered'"), "batch_no")) == [0, 3, 5]
    body, headers = eval((seen / "0-0").read_text())
    assert body == b"body0" and dict(headers) == {
        "Content-Type": "application/json", "Idempotency-Key": "r1/s/0", "X-Scope-OrgID": "t1",
        "Authorization": "Basic dTpw", "Retry-Attempt": "0",
    }
    assert dict(eval((seen / "5-0").read_text())[1])["X-Scope-OrgID"] == "t0"


def test_every_run_has_its_own_keys():
    row = {"payload_json": "x", "batch_no": 0}
    assert PushOptions().headers(row)["Idempotency-Key"] != PushOptions().headers(row)["Idempotency-Key"]


def test_retry_errors_do_not_depend_on_numbering(spark):
    for first in (0, 1, 7):
        rows = [(5, first + k, 503, None) for k in range(3)]
        judged = classify_attempts(spark.createDataFrame(rows, "batch_no bigint, attempt int, status int, exception string"))
        got = attempt_errors(judged, delivery_outcomes(judged), 2)
        assert sorted(values(got, "stage", "reason", "errors")) == [("retry", "status:503", 2), ("send", "status:503", 1)]


def test_push_sink(spark, tmp_path):
    write_push(payloads(spark), recording(str(tmp_path)), NO_WAIT)
    assert len(list(tmp_path.iterdir())) == len(WANT)
    strict = push_sink(recording(str(tmp_path)), NO_WAIT, "strict_push", fail=True)
    spark.dataSource.register(strict)
    payloads(spark).filter("batch_no = 0").write.format("strict_push").mode("append").save()
    with pytest.raises(Exception, match="not delivered"):
        payloads(spark).filter("batch_no = 4").write.format("strict_push").mode("append").save()


@pytest.mark.parametrize("error, tries", [(TimeoutError, 3), (ConnectionResetError, 1)])
def test_retry_on(spark, error, tries):
    def fails(body, headers):
        raise error("x")

    assert push_attempts(payloads(spark, 1), fails, NO_WAIT).count() == tries


def test_binary_content_type():
    options = PushOptions(payload="payload_bin")
    assert options.headers({"payload_bin": b"x", "batch_no": 1})["Content-Type"] == "application/x-protobuf"
    assert [PushOptions(jitter_ms=0).delay_ms(n) for n in (1, 2, 3, 8, 100)] == [500, 1000, 2000, 60000, 60000]


def test_payload_files(spark, tmp_path):
    df = payloads(spark).withColumn("tenant", F.coalesce("tenant", F.lit("none")))
    write_payloads(df, str(tmp_path / "p"), ["tenant"])
    assert (tmp_path / "p" / "tenant=none").is_dir()
    assert spark.read.parquet(str(tmp_path / "p")).count() == 6


def counting(path, dies_at=None):
    """A transport that appends each delivery to a file; it takes its process down once, before batch ``dies_at``."""

    def send(body, headers):
        batch = headers["Idempotency-Key"].split("/")[-1]
        if batch == dies_at:
            try:
                os.close(os.open(f"{path}/died", os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                pass
            else:
                os._exit(1)
        with open(f"{path}/{batch}-{uuid.uuid4().hex}", "wb") as f:
            f.write(body)
        return 204, ""

    return send


@pytest.mark.parametrize("kind", ["sink", "attempts"])
def test_a_killed_task_sends_nothing_twice(spark, tmp_path, kind):
    seen, ledger = tmp_path / "seen", Ledger(f"file://{tmp_path}/ledger", parts=4)
    seen.mkdir()
    options = PushOptions(run_id="r", keys=("shard",))
    path = str(tmp_path / "attempts") if kind == "attempts" else None
    df = payloads(spark, 20).coalesce(1)
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone
        write_push(df, counting(str(seen), "13"), options, path, ledger)
    assert (seen / "died").exists() and len(list(seen.iterdir())) == 14
    write_push(df, counting(str(seen), "13"), options, path, ledger)
    names = sorted(int(f.name.split("-")[0]) for f in seen.iterdir() if f.name != "died")
    assert names == list(range(20))
    if kind == "attempts":
        assert sorted(values(spark.read.parquet(path), "batch_no")) == list(range(13, 20))
    else:
        done = [w for w in ledger.writes() if w["state"] == "committed"]
        assert [(w["batches"], w["attempts"], w["skipped"], w["run_id"]) for w in done] == [(7, 7, 13, "r")]
    # another run is another delivery
    write_push(df, counting(str(seen)), PushOptions(run_id="r2", keys=("shard",)), path, ledger)
    assert len(list(seen.iterdir())) == 41


def test_ledger_groups(tmp_path):
    ledger = Ledger(f"file://{tmp_path}", parts=2, group=3)
    keys = [f"r/{k}" for k in range(10)]
    for key in keys:
        ledger.add(key)
    ledger.flush()
    other = Ledger(f"file://{tmp_path}", parts=2)
    assert all(k in other for k in keys) and "r/10" not in other and ledger.writes() == []


def test_file_transport(spark, tmp_path):
    write_push(payloads(spark), file_transport(f"file://{tmp_path}/out"), PushOptions(run_id="a", keys=("shard",)))
    assert sorted((f.name, f.read_bytes()) for f in (tmp_path / "out" / "a" / "s").iterdir()) == [(f"{k}.body", f"body{k}".encode()) for k in range(6)]


def test_retries_wait_in_state(spark, tmp_path):
    """Batch 1 is refused three times, batch 3 once; all others are there long before."""
    use_rocksdb(spark)
    seen = tmp_path / "seen"
    seen.mkdir()
    payloads(spark, 8).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("batch_no bigint, shard string, payload_json string, tenant string").parquet(f"{tmp_path}/in")
    options = PushOptions(keys=("shard",), run_id="r", min_ms=2000, max_ms=60_000, jitter_ms=0)
    query = (
        push_attempts_stream(stream, recording(str(seen)), options).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="200 milliseconds").start()
    )
    want = [*WANT, (6, 0, 204, None), (7, 0, 204, None)]
    try:
        deadline, got = time.time() + 90, []
        while len(got) < len(want) and time.time() < deadline:
            time.sleep(1)
            try:
                got = values(spark.read.parquet(f"{tmp_path}/out"), "batch_no", "attempt", "status", "exception")
            except Exception:
                got = []
    finally:
        query.stop()
    assert sorted(got, key=str) == sorted(want, key=str)
    rows = values(spark.read.parquet(f"{tmp_path}/out"), "batch_no", "attempt", "delay_ms")
    retries = {(b, a): d for b, a, d in rows if a}
    one = spark.createDataFrame([(1,)], "batch_no bigint")
    assert [retries[1, r.retry] for r in retry_schedule(one, 2000, 60_000, 2).orderBy("retry").collect()] == [retries[1, 1], retries[1, 2]]
    at = {name: os.path.getmtime(seen / name) for name in os.listdir(seen)}
    # the first attempts of all others do not wait for the retries
    assert max(at[f"{k}-0"] for k in range(8)) < at["1-1"] and at["1-2"] - at["1-1"] >= 4


def test_merged_sketches_keep_their_error_bound(spark):
    n = 60_000
    df = spark.range(n).select((F.col("id") * 1000).alias("ts_ms"), (F.col("id") % 2).alias("k"), (F.col("id") * 7919 % n).alias("v"), F.when(F.col("id") % 10 == 0, 5).alias("w"))
    sketches = distributions(df, {"v": "v", "a.w": F.col("w")}, ["k"], 1_000_000, k=256)
    assert sketches.columns == ["k", "window_ms", "metric", "sketch"] and sketches.select("window_ms").distinct().count() == 60
    rows = values(quantiles(merge_distributions(sketches, k=256), (0.01, 0.5, 0.9, 1.0)), "metric", "n", "quantile", "value")
    for metric, seen, q, value in rows:
        if metric == "v":
            assert seen == n and abs((value + 1) / n - q) <= rank_error(256) + 1 / n
        else:
            assert (seen, value) == (n // 10, 5)
    assert len(rows) == 8
    assert distributions(df.limit(0), {"v": "v"}).count() == 0


@pytest.mark.parametrize("col", ["payload_json", "payload_bin"])
def test_label_index_opens_only_files_with_the_labels(spark, tmp_path, col):
    path, index = str(tmp_path / "payloads"), str(tmp_path / "index")
    encode = encode_json if col == "payload_json" else encode_proto

    def write(*labels):
        for k, some in enumerate(labels):
            rows = [{"seq": i, "labels": lab, "line": f"{k}-{i}"} for i, lab in enumerate(some)]
            encode(cut_by_count(records(spark, *rows))).select(col).coalesce(1).write.mode("append").parquet(path)

    files = lambda **wanted: read_labelled(spark, path, index, wanted).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    write([{"a": "1"}, {"a": "2", "b": "x"}], [{"a": "2"}], [{}], [{"a": "3"}, {"b": "x"}])
    assert files(a="2") == 4
    write_label_index(spark, path, index, col)
    assert (files(a="2"), files(a="2", b="x"), files(b="x"), files(a="4"), files(b=""), files()) == (2, 1, 2, 0, 4, 4)
    write([{"a": "4"}])
    assert files(a="4") == 1 and files(a="2") == 3  # a file that is not indexed yet is read
    write_label_index(spark, path, index, col)
    assert files(a="4") == 1 and files(a="2") == 2
    plan = read_labelled(spark, path, index, {"a": "4"})
    assert len(plan.inputFiles()) == 5 and plan.count() == 1
