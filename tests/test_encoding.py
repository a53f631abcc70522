import json

import pyarrow as pa
import pytest
from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
from helpers import LINE, events, records, three_events, values
from pyspark.sql import functions as F

from logbarge.functions import selector, varint
from logbarge.functions.blocks import PART_BYTES, PART_ROWS, parts
from logbarge.operators.batching import cut_by_count
from logbarge.operators.encoding import (
    compress_snappy,
    decompress_snappy,
    encode_json,
    encode_proto,
    encode_text,
    split_encode_errors,
)
from logbarge.operators.projection import project_records, static_labels
from logbarge.operators.readback import bucket_digests, drop_labels, reconcile, reconcile_by_digest, select_stream
from logbarge.sources import read_payloads, read_proto_payloads


D, I = {"kind": "audit", "app": "store"}, {"kind": "sale", "app": "store"}
FOUR = (
    {"ts_ms": 86_400_000, "nanos_in_ms": 250, "labels": D, "line": "audit began"},
    {"ts_ms": 7_250, "nanos_in_ms": 999_999, "labels": I, "line": "sold b-17"},
    {"ts_ms": 9_001, "nanos_in_ms": 0, "labels": I, "line": "sold c-4"},
    {"ts_ms": 8_000, "nanos_in_ms": 31, "labels": I, "line": "returned b-17"},
)


def push_request():
    d = descriptor_pb2
    f = d.FileDescriptorProto(name="push.proto", package="t", syntax="proto3")
    for name, fields in {
        "Time": [("seconds", 3, 0, ""), ("nanos", 5, 0, "")],
        "Pair": [("name", 9, 0, ""), ("value", 9, 0, "")],
        "Entry": [("time", 11, 0, ".t.Time"), ("line", 9, 0, ""), ("meta", 11, 1, ".t.Pair")],
        "Stream": [("labels", 9, 0, ""), ("entries", 11, 1, ".t.Entry")],
        "Push": [("streams", 11, 1, ".t.Stream")],
    }.items():
        m = f.message_type.add(name=name)
        for i, (field, kind, repeated, of) in enumerate(fields, 1):
            m.field.add(name=field, number=i, type=kind, label=3 if repeated else 1, type_name=of or None)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(f)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("t.Push"))


def test_json_payload(spark):
    row = encode_json(cut_by_count(records(spark, *FOUR))).collect()[0]
    want = {"streams": [
        {"stream": D, "values": [["86400000000250", "audit began"]]},
        {"stream": I, "values": [["7250999999", "sold b-17"], ["9001000000", "sold c-4"], ["8000000031", "returned b-17"]]},
    ]}
    assert json.loads(row.payload_json) == want
    assert row.payload_json == json.dumps(want, separators=(",", ":"))
    assert (row.items, row.streams, row.condition, row.size_bytes) == (4, 2, "DRAIN", len(row.payload_json))


def test_json_metadata(spark):
    meta = {"order": "77", "till": "north-2"}
    row = encode_json(cut_by_count(records(spark, {"labels": I, "line": "x", "metadata": meta}))).collect()[0]
    assert row.payload_json == (
        '{"streams":[{"stream":{"kind":"sale","app":"store"},"values":[["0000000","x",'
        '{"order":"77","till":"north-2"}]]}]}'
    )


MOVES = [("sale", 40), ("sale", 12), ("audit", 33), ("return", 12), ("sale", 51), ("audit", 20), ("lost", 60)]


def moves(spark):
    df = events(spark, *({"ts_ms": t, "level": kind, "message": f"{kind} at {t}"} for kind, t in MOVES))
    return project_records(df, "k=%level", "off", "%msg")


def streams_of(payload):
    return {json.dumps(s["stream"]): [int(v[0]) // 10**6 for v in s["values"]] for s in json.loads(payload)["streams"]}


def test_order_in_streams(spark):
    """Streams are grouped, entries stay in arrival order whatever their time."""
    row = encode_json(cut_by_count(moves(spark), max_items=7)).collect()[0]
    assert streams_of(row.payload_json) == {
        '{"k": "sale"}': [40, 12, 51], '{"k": "audit"}': [33, 20], '{"k": "return"}': [12], '{"k": "lost"}': [60]
    }
    row = encode_json(cut_by_count(static_labels(moves(spark)), max_items=7), static=True).collect()[0]
    assert streams_of(row.payload_json) == {'{"k": "sale"}': [t for _, t in MOVES]}
    assert (row.streams, row.items) == (1, 7)


def test_text_payload(spark):
    rec = project_records(three_events(spark), "level=%level\napp=store", "off", LINE)
    text = encode_text(cut_by_count(rec, max_items=3)).collect()[0].payload_text
    assert text == (
        "{level=INFO, app=store} %%% {} %%% ts=5000 INFO/worker-1 shop.cart.Basket: basket opened; \n"
        "{level=INFO, app=store} %%% {} %%% ts=5300 INFO/worker-1 shop.cart.Basket: basket paid; \n"
        "{level=WARN, app=store} %%% {} %%% ts=5020 WARN/worker-9 shop.cart.Basket: stock is low; \n"
    )


def test_varints(spark):
    numbers = [0, 1, 127, 128, 300, 16383, 16384, 70000, 2**21, 2**28 - 1, 2**28, 2**34, 2**35 - 1, 2**55, 2**56, 2**62, 2**63 - 1, -1, -1500, -(2**63)]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    for n, b in values(df.select("n", F.expr(varint("n", 10)).alias("b")), "n", "b"):
        out, n = bytearray(), n % 2**64
        while True:
            out.append(n & 127 | (128 if n > 127 else 0))
            n >>= 7
            if not n:
                break
        assert bytes(b) == bytes(out)


def test_proto_payload(spark):
    meta = {"cluster": "кластер", "empty": "", "long": "x" * 300}
    rows = (*FOUR, {"ts_ms": 1704067207179, "nanos_in_ms": 575000, "labels": {"q": 'say "hi" \\'}, "line": "ю" * 20000, "metadata": meta},
            {"ts_ms": 0, "labels": {"q": "z"}, "line": ""})
    cut = cut_by_count(records(spark, *rows))
    payload = bytes(encode_proto(cut).collect()[0].payload_bin)
    Push = push_request()
    got = Push.FromString(payload)
    assert [s.labels for s in got.streams] == [
        '{kind="audit",app="store"}', '{kind="sale",app="store"}', '{q="say \\"hi\\" \\"}', '{q="z"}'
    ]
    assert [(e.time.seconds, e.time.nanos, e.line) for s in got.streams[:2] for e in s.entries] == [
        (86400, 250, "audit began"), (7, 250_999_999, "sold b-17"), (9, 1_000_000, "sold c-4"), (8, 31, "returned b-17")
    ]
    e = got.streams[2].entries[0]
    assert (e.time.seconds, e.time.nanos, e.line) == (1704067207, 179575000, "ю" * 20000)
    assert {p.name: p.value for p in e.meta} == meta
    assert got.SerializeToString() == payload
    packed = compress_snappy(encode_proto(cut))
    row = packed.collect()[0]
    assert row.size_bytes == len(row.payload_bin) < len(payload)
    assert pa.decompress(bytes(row.payload_bin), len(payload), codec="snappy", asbytes=True) == payload
    assert bytes(decompress_snappy(packed).collect()[0].payload_bin) == payload


def test_times_of_any_age(spark):
    """Times before 1970 and far too late ones: every entry is written and the message decodes."""
    times = [-1500, -1, 0, 1_700_000_000_000_000, -(2**53)]
    row = encode_proto(cut_by_count(records(spark, *({"ts_ms": t, "labels": I, "line": str(t)} for t in times)))).collect()[0]
    got = [(e.time.seconds * 1000 + e.time.nanos // 10**6, e.line) for s in push_request().FromString(bytes(row.payload_bin)).streams for e in s.entries]
    assert got == [(t, str(t)) for t in times] and row["items"] == len(times) and row.encode_error is None


@pytest.mark.parametrize("encode, payload", [(encode_json, "payload_json"), (encode_proto, "payload_bin"), (encode_text, "payload_text")])
def test_a_bad_value_fails_its_batch_only(spark, encode, payload):
    rows = ({"labels": I, "line": "a"}, {"labels": I, "line": None}, {"labels": D, "line": "b"}, {"labels": I, "line": "c"}, {"ts_ms": None, "line": "d"})
    good, bad = split_encode_errors(encode(cut_by_count(records(spark, *rows), max_items=2)), payload)
    assert values(good, "batch_no", "items") == [(1, 2)]
    assert sorted(values(bad, "batch_no", "reason")) == [(0, "no line"), (2, "no time")]


def test_selector(spark):
    df = spark.sql("""select map('a', 'x"y', 'b', 'p\\\\q\n') as m""")
    assert values(df.select(selector("m").alias("s")), "s") == ['{a="x\\"y",b="p\\q\n"}']


def test_roundtrip(spark):
    rows = (*FOUR, {"ts_ms": 7, "labels": {"q": "1"}, "line": 'a "quoted" \\ line\n\t🏁', "metadata": {"k": "v\n"}})
    cut = cut_by_count(records(spark, *rows), max_items=2)
    back = read_payloads(encode_json(cut).select("batch_no", "payload_json"))
    key = ["ts_ms", "nanos_in_ms", "line"]
    assert sorted(values(back, *key)) == sorted(values(cut, *key))
    assert values(back.filter("ts_ms = 7"), "metadata", "labels") == [({"k": "v\n"}, {"q": "1"})]
    assert set(values(reconcile(cut, back), "missing", "extra")) == {(0, 0)}
    lost = reconcile(cut, back.filter("ts_ms <> 9001").unionAll(back.filter("ts_ms = 7")))
    assert sorted(values(lost, "sent", "stored", "missing", "extra")) == [(1, 1, 0, 0), (1, 2, 0, 1), (3, 2, 1, 0)]


def test_broken_payload_fails(spark):
    df = spark.createDataFrame([('{"streams":[{"stream":{}',)], "payload_json string")
    with pytest.raises(Exception):
        read_payloads(df).collect()


def test_encode_errors(spark):
    df = spark.createDataFrame([(0, "{}"), (1, None), (2, "x")], "batch_no bigint, payload_json string")
    good, bad = split_encode_errors(df, check=F.try_parse_json("payload_json").isNotNull())
    assert values(good, "batch_no") == [0]
    assert sorted(values(bad, "batch_no", "reason")) == [(1, "no payload"), (2, "invalid payload")]


def test_select_and_drop(spark):
    df = records(spark, *({"ts_ms": 10 - i, "labels": {"test": "a" if i % 2 else "b", "x": str(i)}, "line": str(i)} for i in range(10)))
    got = select_stream(df, {"test": "a"}, end_ns=9_000_000, limit=3)
    assert values(got, "line") == ["9", "7", "5"]
    assert values(select_stream(df, {"test": "a"}, limit=2, direction="backward"), "line") == ["1", "3"]
    assert values(select_stream(df, {"none": ""}, limit=1), "line") == ["9"]
    assert values(select_stream(df, {"none": "q"}), "line") == []
    assert drop_labels(df, ["x"]).select(F.to_json("labels").alias("l")).distinct().count() == 2


ODD = (
    {"ts_ms": 0, "nanos_in_ms": 0, "labels": {}, "line": "", "metadata": {"": "", "k": ""}},
    {"ts_ms": -1, "nanos_in_ms": 999_999, "labels": {"q": 'a"b', "c": 'x",y="z'}, "line": "\u6f22\n" * 3000, "metadata": {"t": "\u00e9"}},
    {"ts_ms": -86_400_001, "nanos_in_ms": 7, "labels": {"e": "", "b": "back\\"}, "line": "l", "metadata": {}},
    {"ts_ms": 1 << 52, "nanos_in_ms": 1, "labels": {"s": "{a,b}=c"}, "line": "x" * 100_000, "metadata": {"a": "1", "b": "2"}},
)


def test_proto_payloads_read_back(spark):
    rows = [*FOUR, *ODD, *({"ts_ms": k, "labels": {"n": str(k % 7)}, "line": f"l{k}", "metadata": {"k": str(k)} if k % 3 else {}} for k in range(400))]
    df = records(spark, *rows)
    cut = cut_by_count(df, max_items=50)
    payloads = encode_proto(cut)
    back = read_proto_payloads(payloads.select("batch_no", "payload_bin", F.lit("kept").alias("other")))
    assert back.columns == ["batch_no", "other", "labels", "entry_no", "ts_ms", "nanos_in_ms", "line", "metadata"]
    gaps = reconcile(df, back)
    assert values(gaps.where("missing + extra > 0 or sent <> stored"), "stream_key") == [] and gaps.agg(F.sum("sent")).first()[0] == len(rows)
    as_json = read_payloads(encode_json(cut).select("batch_no", "payload_json"))
    key = ("batch_no", "entry_no", "ts_ms", "nanos_in_ms", "line", "labels", "metadata")
    assert sorted(map(str, values(back, *key))) == sorted(map(str, values(as_json, *key)))
    one = spark.createDataFrame([(1, None), (2, b"")], "batch_no int, payload_bin binary")
    assert read_proto_payloads(one).collect() == []


def test_proto_of_another_writer(spark):
    """Fields in any order, unknown fields, repeated ones (the last counts) and messages without a time."""
    message = push_request()()
    stream = message.streams.add(labels='{a="b"}')
    stream.entries.add(line="one").time.seconds = 5
    stream.entries.add(line="two").meta.add(name="n", value="v")
    first = message.streams[0].entries[0].SerializeToString()
    body = lambda n, b: bytes([n << 3 | 2, len(b)]) + b
    unknown = bytes([9 << 3 | 0, 0x96, 0x01, 10 << 3 | 5, 1, 2, 3, 4, 11 << 3 | 1, *range(8)])
    other = body(1, body(2, unknown + first + body(2, b"three")) + unknown + body(1, b'{c="d"}'))
    df = spark.createDataFrame([(message.SerializeToString(),), (other + unknown,)], "payload_bin binary")
    got = sorted(values(read_proto_payloads(df), "line", "ts_ms", "entry_no", F.to_json("labels"), F.to_json("metadata")))
    assert got == [("one", 5000, 0, '{"a":"b"}', "{}"), ("three", 5000, 0, '{"c":"d"}', "{}"), ("two", 0, 1, '{"a":"b"}', '{"n":"v"}')]
    for broken in (b"\xff", b"\x0a\x05a", b"\x0b", b"\x80" * 12):
        with pytest.raises(Exception, match="Malformed"):
            read_proto_payloads(spark.createDataFrame([(broken,)], "payload_bin binary")).collect()


def test_reconcile_by_digest_equals_reconcile(spark, tmp_path):
    sent = [{"ts_ms": k - 50, "nanos_in_ms": k % 3, "labels": {"s": str(k % 4)}, "line": f"l{k // 2}", "metadata": {"k": str(k % 5)}} for k in range(300)]
    sent += [dict(sent[7]), dict(sent[7])]
    # two of one record become two of another: counts alone would not tell
    stored = [r for r in sent if r["ts_ms"] not in (-20, -16)] + [dict(sent[200]), dict(sent[200]), {"ts_ms": 9_000, "labels": {"new": "x"}, "line": "z"}]
    a, b = records(spark, *sent), records(spark, *stored)
    key = ("stream_key", "sent", "stored", "missing", "extra")
    want = sorted(values(reconcile(a, b), *key))
    assert sum(r[3] for r in want) == 2 and sum(r[4] for r in want) == 3
    for bucket in (1, 10, 10_000):
        assert sorted(values(reconcile_by_digest(a, b, bucket), *key)) == want
    same = reconcile_by_digest(a, a.repartition(3), 10)
    assert sorted(values(same, *key)) == sorted(values(reconcile(a, a), *key))
    assert reconcile_by_digest(a.limit(0), b.limit(0)).count() == 0
    assert sorted(values(reconcile_by_digest(a, b.limit(0), 10), *key)) == sorted(values(reconcile(a, b.limit(0)), *key))
    # the span of the differing buckets reaches the scan
    for name, df in (("a", a), ("b", b.where("ts_ms < 9000"))):
        df.write.parquet(f"{tmp_path}/{name}")
        bucket_digests(spark.read.parquet(f"{tmp_path}/{name}"), 10).write.parquet(f"{tmp_path}/{name}-digests")
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("a", "b", "a-digests", "b-digests")}
    plan = reconcile_by_digest(read["a"], read["b"], 10, read["a-digests"], read["b-digests"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts_ms,-20)" in plan and "LessThan(ts_ms,160)" in plan


def test_parts_of_a_batch_are_bounded():
    """By plain bytes, also where the blocks are compressed; a larger value is alone, and every row is in one part."""
    values = [b"a" * 1000] * 600 + [None, b""] + [b"b" * (PART_BYTES // 2)] * 5 + [b"c" * (2 * PART_BYTES), b"d"]
    for packed in (False, True):
        stored = [v if v is None or not packed else pa.compress(v, codec="snappy", asbytes=True) for v in values]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(values))), pa.array(stored, pa.binary())], ["n", "v"]).slice(1)
        found = [part.column(0).to_pylist() for part in parts(batch, 1, packed)]
        assert [n for part in found for n in part] == list(range(1, len(values)))
        assert all(len(part) <= PART_ROWS and (len(part) == 1 or sum(len(values[n] or b"") for n in part) <= PART_BYTES) for part in found)
        assert [607] in found and len(found) == 7
    assert list(parts(batch.slice(0, 0), 1, True)) == []


def test_compressed_messages_are_read_by_one_worker(spark):
    """Without a second one that decompresses; batches on the way to it are small."""
    rows = [{"ts_ms": k, "labels": {"n": str(k % 7)}, "line": f"l{k}" * 300, "metadata": {"k": str(k)}} for k in range(900)]
    cut = cut_by_count(records(spark, *rows), max_items=2)
    packed = compress_snappy(encode_proto(cut)).select("batch_no", "payload_bin").unionAll(spark.createDataFrame([(-1, None), (-2, b"")], "batch_no bigint, payload_bin binary"))
    back = read_proto_payloads(packed, snappy=True)
    assert back.select("entry_no").count() == 900
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert plan(back) == plan(packed) + 1
    key = ("batch_no", "entry_no", "ts_ms", "line", "labels", "metadata")
    want = read_proto_payloads(decompress_snappy(packed.where("length(payload_bin) > 0")))
    assert sorted(map(str, values(back, *key))) == sorted(map(str, values(want, *key)))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
