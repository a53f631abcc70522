"""One query per operator over the sample tables; every column is a number, a boolean or text."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    abbreviate,
    array_field,
    extract_kv,
    field,
    is_blank,
    json_object,
    json_quote,
    json_value,
    kvp_fields,
    raw_field,
    selector,
    stream_key,
    utf8_len,
    value_text,
)
from ..operators.batching import cut_batches, cut_by_count, summarize_batches
from ..operators.delivery import classify_attempts, dead_letters, delivery_outcomes, retry_schedule
from ..operators.encoding import (
    compress_snappy,
    decompress_snappy,
    encode_json,
    encode_proto,
    encode_text,
    split_encode_errors,
)
from ..operators.grouping import group_streams, order_by_stream_time
from ..operators.layouts import JsonLayout, MapSpec, format_json, format_text
from ..operators.metrics import (
    attempt_errors,
    delivery_metrics,
    distributions,
    dropped_counts,
    error_counts,
    merge_distributions,
    quantiles,
    rank_error,
    thin_by_count,
    unsent,
)
from ..operators.projection import by_tenant, project_records, split_bad, split_errors, static_labels
from ..operators.readback import bucket_digests, drop_labels, reconcile, reconcile_by_digest, select_stream
from ..operators.sizing import split_oversize, with_size
from ..settings import configure, shared_folder
from ..sinks import Ledger, PushOptions, file_transport, read_labelled, write_label_index, write_payloads, write_push
from ..sources import EventMapping, read_events, read_payloads, read_proto_payloads, stream_events
from ..sources.events import wire_time
from ..streaming import ParallelCut, cut_batches_stream, drain_open, use_rocksdb
from . import tables as X
from .ship import ShipOptions, shape, ship
from .ship import batch as batch_records

Query = Callable[[SparkSession, str], DataFrame]

# Limits of the batch queries on the sample events.
COUNT = 250
ITEMS, BYTES = 35, 1460
IDLE_MS = 1_800_000
OVERSIZE = 8192
HOLED_BYTES = 120
MOVED_BACK, MOVED_ON = 60 * 31_556_952_000, 3000 * 31_556_952_000
# Rows numbered by one task; small because the sample tables are.
BLOCK = 4096

_MAP_COLUMNS = ("labels", "metadata")


def _text_maps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in _MAP_COLUMNS if c in df.columns})


# --- records -------------------------------------------------------------------------------------


def shape_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = X.shop_records(spark, sf_dir)
    return _text_maps(rec).select(F.col("seq").alias("event_id"), wire_time().alias("ts_ns"), "labels", "line", "metadata")


def event_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written in four file formats and read back through one mapping."""
    source = X.table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_type"
    )
    mapping = EventMapping("event_id", F.timestamp_micros("us"), {"level": "event_type"})
    parts = []
    for fmt in ("parquet", "orc", "json", "csv"):
        path = _fresh(spark, f"events-{fmt}")
        source.write.format(fmt).save(path)
        events = read_events(spark, path, fmt, mapping, source.schema)
        parts.append(events.groupBy(F.lit(fmt).alias("format"), "level").agg(
            F.count("*").alias("events"), F.sum("ts_ms").alias("ts_ms"), F.sum("nanos_in_ms").alias("nanos")
        ))
    return reduce(DataFrame.unionAll, parts)


def default_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = X.shop_events(spark, sf_dir, mdc=F.create_map(F.lit("user"), F.col("user_id").cast("string")))
    rec = project_records(ev, "app=shop\nhost=h1\nagent=a")
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "line", "metadata")


def _mdc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    mdc = F.create_map(
        F.lit("kind"), "event_type",
        F.lit("user"), F.col("user_id").cast("string"),
        F.lit("vip"), F.when(F.col("user_id") % 3 == 0, "yes"),
    )
    return X.shop_events(spark, sf_dir, mdc=mdc)


def bulk_kvp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _mdc_events(spark, sf_dir).withColumn("kvp", X.typed_pairs())
    rec = project_records(ev, "*=%%mdc\nlevel=%level", "t=%thread\nkvp_*=%%kvp")
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "metadata")


def bulk_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = project_records(
        _mdc_events(spark, sf_dir), "m_* = %%mdc{user, kind}\nc=%level", "t=%thread\n* != %%MDC { kind }\nt=again\n*=%%kvp{nothing}"
    )
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "metadata")


def marker_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    def marker(kind: str, key: str, value) -> object:
        return F.struct(F.lit(kind).alias("kind"), F.create_map(F.lit(key), value).alias("kv"))

    amount = X.cents("value").cast("string")
    markers = (
        F.when(F.col("event_type") == "error", F.array(marker("label", "severity", F.lit("high")), marker("label", "late", F.lit("no"))))
        .when(F.col("event_type") == "purchase", F.array(marker("metadata", "amount", amount), marker("label", "level", F.lit("PAID"))))
    )
    rec = project_records(
        X.shop_events(spark, sf_dir, markers=markers), "level=%level", "thread=%thread", read_markers=True
    )
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "metadata")


def static_labels_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = static_labels(X.shop_records(spark, sf_dir), keys=["shard"])
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "line")


def static_labels_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = static_labels(X.shop_records(spark, sf_dir))
    return _text_maps(rec).select(F.col("seq").alias("event_id"), "labels", "line")


def logger_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = X.shop_events(spark, sf_dir)
    return ev.select(
        F.col("seq").alias("event_id"),
        *(abbreviate("logger", n).alias(f"to_{n}") for n in (0, 8, 14, 17, 20)),
        abbreviate("logger").alias("whole"),
    )


def _url_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.table(spark, sf_dir, "pages")
    query = F.split(F.substring_index("url", "#", 1), r"\?")
    kv = extract_kv(F.coalesce(F.get(query, F.lit(1)), F.lit("")), "&", "=")
    return pages.select("page_id", kv.alias("_kv")).select(
        "page_id", "_kv.pairs", F.col("_kv.error").alias("parse_error")
    )


def url_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_errors(_url_pairs(spark, sf_dir))
    return good.select("page_id", F.posexplode("pairs").alias("position", "_p")).select(
        "page_id", "position", "_p.key", "_p.value"
    )


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_errors(_url_pairs(spark, sf_dir))
    return error_counts(bad, "append", "parse_error")


def attribute_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value text with a regular-expression separator: host and parameters of the URLs."""
    pages = X.table(spark, sf_dir, "pages")
    text = F.regexp_replace("url", "^https?://", "site=")
    kv = extract_kv(text, "regex:/[^?#]*[?#]?|[&#]", "=")
    return pages.select("page_id", kv.alias("_kv")).select(
        "page_id", F.size(F.coalesce("_kv.pairs", F.array().cast("array<struct<key:string,value:string>>"))).alias("pairs"),
        F.col("_kv.error").alias("error"),
    )


def blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.count_if(is_blank("line")).alias("blank")
    )


# --- layouts -------------------------------------------------------------------------------------


def _traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = F.concat(
        F.lit("Failure: "), "event_type", F.lit("\n\tat a.B.c(B:1)\n\tat d.E.f(E:"),
        F.col("user_id").cast("string"), F.lit(")\n\tat g.H.i(H:3)\n"),
    )
    return _mdc_events(spark, sf_dir).withColumn("stack_trace", F.when(F.col("event_type") == "error", trace))


def text_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traced(spark, sf_dir).select(
        F.col("seq").alias("event_id"),
        format_text("%level/%thread %logger{20}: %msg; %ex{1}").alias("short_trace"),
        format_text("%-9level[%10thread] %logger{0} - %msg%n").alias("padded"),
        format_text("%msg %ex").alias("whole_trace"),
    )


def json_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _traced(spark, sf_dir).select(F.col("seq").alias("event_id"), format_json().alias("doc"))


def json_layout_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = JsonLayout(
        logger_length=0,
        mdc=MapSpec("", no_prefix=True, exclude=("kind",)),
        kvp=MapSpec(
            "pair_",
            serializer=lambda name, value: F.concat(
                json_quote(F.concat(F.lit("both_"), name)), F.lit(":{"), json_quote(name), F.lit(":"),
                json_value(value), F.lit("}"),
            ),
        ),
        custom=(
            field("words_in_all", F.size(F.split("message", " ")), "number"),
            raw_field("raw", F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit("}"))),
            raw_field("refused", F.lit("{oops"), checked=True),
            array_field("words", F.split("message", " ")),
            array_field("objects", F.split("message", " "), lambda w: json_object(F.concat(F.lit('"w":'), json_quote(w)))),
        ),
    ).without("timestamp", "thread")
    return _mdc_events(spark, sf_dir).select(F.col("seq").alias("event_id"), format_json(layout).alias("doc"))


def json_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = X.shop_events(spark, sf_dir).withColumn("kvp", X.typed_pairs())
    return ev.select(
        F.col("seq").alias("event_id"),
        json_object(kvp_fields("kvp")).alias("doc"),
        json_object(kvp_fields("kvp", no_prefix=True, include=("user", "name", "list"), exclude=("name",))).alias("some"),
        format_json(JsonLayout().only()).alias("nothing"),
    )


def json_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists six levels deep with an object and a number wider than 64 bits, as JSON and as plain text."""
    rows = X.table(spark, sf_dir, "events", "event_id").select("event_id", X.deep_list().alias("text"))
    value = rows.withColumn("value", F.parse_json("text"))
    return value.select("event_id", json_value("value").alias("typed"), value_text(F.col("value")).alias("plain"))


def quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    turns = X.table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    pages = X.table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    quoted = json_quote("text")
    return docs.unionAll(turns).unionAll(pages).select(
        "source", "id", F.md5(quoted.cast("binary")).alias("quoted_md5"), utf8_len(quoted).cast("bigint").alias("quoted_bytes")
    )


# --- sizes ---------------------------------------------------------------------------------------


def record_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_size(X.document_records(spark, sf_dir)).select(
        F.col("seq").alias("doc_id"), *(F.col(c).cast("bigint").alias(c) for c in ("msg_sz", "meta_sz", "stream_sz"))
    )


def oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, refused = split_oversize(X.document_records(spark, sf_dir), OVERSIZE)
    return kept.select(F.col("seq").alias("doc_id"), F.lit("kept").alias("state")).unionAll(
        refused.select(F.col("seq").alias("doc_id"), F.lit("refused").alias("state"))
    )


def dropped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refused = split_oversize(X.document_records(spark, sf_dir), OVERSIZE)
    return dropped_counts(refused.withColumn("lang", F.col("labels")["lang"]), ["lang"])


# --- batches -------------------------------------------------------------------------------------


def _counted(spark: SparkSession, sf_dir: str, keys=()) -> DataFrame:
    kept, _ = split_oversize(X.shop_records(spark, sf_dir))
    return cut_by_count(kept, keys, max_items=COUNT, block_rows=BLOCK)


def batches_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = _counted(spark, sf_dir, ["shard"]).withColumn("stream_key", stream_key("labels"))
    return summarize_batches(cut, ["shard"])


def _batch_table(cut: DataFrame, keys: list[str]) -> DataFrame:
    return summarize_batches(cut, keys, "seq")


def batches_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_batches(X.shop_records(spark, sf_dir), ["shard"], max_items=ITEMS, max_bytes=BYTES, block_rows=BLOCK)
    return _batch_table(cut, ["shard"])


def batches_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_batches(
        X.shop_records(spark, sf_dir), ["shard"], max_items=ITEMS, max_bytes=BYTES, timeout_ms=IDLE_MS, block_rows=BLOCK
    )
    return _batch_table(cut, ["shard"])


def batches_no_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_batches(
        X.shop_records(spark, sf_dir), ["shard"], max_items=ITEMS, max_bytes=BYTES, drain_on_stop=False, block_rows=BLOCK
    )
    return _batch_table(cut, ["shard"])


def batches_one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one hot shard, cut by many tasks."""
    cut = cut_batches(
        X.shop_records(spark, sf_dir), [], max_items=ITEMS, max_bytes=BYTES, timeout_ms=IDLE_MS,
        chunk_rows=512, group_chunks=4, block_rows=BLOCK,
    )
    return _batch_table(cut, [])


def batches_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_batches(X.turn_records(spark, sf_dir), [], max_items=20, max_bytes=OVERSIZE, chunk_rows=64, block_rows=BLOCK)
    return _batch_table(cut, [])


def tenant_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_by_count(by_tenant(X.order_records(spark, sf_dir), "none"), ["tenant"], max_items=100, block_rows=BLOCK)
    ids = F.expr("listagg(cast(seq as string), ',') within group (order by seq)").alias("order_ids")
    return group_streams(cut, [ids], ["tenant"]).select("tenant", "batch_no", "condition", "stream_key", "items", "order_ids")


def stream_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.expr("listagg(cast(seq as string), ',') within group (order by seq)").alias("event_ids")
    return group_streams(_counted(spark, sf_dir), [ids]).select("batch_no", "stream_key", "items", "est_bytes", "event_ids")


# --- payloads ------------------------------------------------------------------------------------


def _digest(payloads: DataFrame, col: str) -> DataFrame:
    return payloads.withColumn(col, F.md5(F.col(col).cast("binary"))).drop("encode_error")


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(encode_json(_counted(spark, sf_dir)), "payload_json")


def payload_json_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_by_count(static_labels(X.shop_records(spark, sf_dir)), max_items=COUNT, block_rows=BLOCK)
    return _digest(encode_json(cut, static=True), "payload_json")


def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(encode_text(_counted(spark, sf_dir)), "payload_text")


def payload_proto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(encode_proto(_counted(spark, sf_dir)), "payload_bin")


def payload_snappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = compress_snappy(encode_proto(_counted(spark, sf_dir)))
    plain = decompress_snappy(packed.withColumn("packed", F.col("payload_bin")))
    return plain.select(
        "batch_no", "items", F.octet_length("payload_bin").alias("plain_bytes"), F.md5("payload_bin").alias("plain_md5"),
        (F.octet_length("packed") < F.octet_length("payload_bin")).alias("smaller"),
    )


def payload_proto_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times before 1970 and far beyond it: every third event moved back 60 years, every third 3,000 on."""
    moved = F.expr(f"ts_ms + (case pmod(seq, 3) when 0 then -{MOVED_BACK} when 1 then {MOVED_ON} else 0 end)")
    rec = X.shop_records(spark, sf_dir).withColumn("ts_ms", moved)
    return _digest(encode_proto(cut_by_count(split_oversize(rec)[0], max_items=COUNT, block_rows=BLOCK)), "payload_bin")


def _holed(events: DataFrame) -> DataFrame:
    """Events with holes by rules on their columns: no thread, no message, no time."""
    hole = lambda c, rule: F.when(~F.expr(rule), F.col(c))
    return events.withColumns({
        "shard": hole("thread", "user_id % 13 = 0"), "thread": hole("thread", "user_id % 7 = 0"),
        "message": hole("message", "user_id % 5 = 0"), "ts_ms": hole("ts_ms", "seq % 401 = 0"),
    })


def _ends(kept: DataFrame, refused: DataFrame, bad: DataFrame) -> DataFrame:
    tell = lambda df, state, reason: df.groupBy(F.lit(state).alias("state"), reason.alias("reason")).agg(
        F.count("*").alias("events"), F.sum("seq").alias("ids")
    )
    none = F.lit(None).cast("string")
    return tell(kept, "kept", none).unionAll(tell(refused, "refused", none)).unionAll(tell(bad, "bad", F.col("reason")))


def shape_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event with holes ends up: kept, refused for its size, or bad for a reason."""
    options = ShipOptions(X.SHOP_LABELS, X.SHOP_METADATA, X.SHOP_LINE, shard=["shard"], max_bytes=HOLED_BYTES, max_items=COUNT, count_only=True, block_rows=BLOCK)
    return _ends(*batch_records(shape(_holed(X.shop_events(spark, sf_dir)), options), options))


def encode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with a record that has no time or no line fail with its reason, the others are encoded."""
    cut = _counted(spark, sf_dir).withColumns({
        "ts_ms": F.when(F.col("seq") % 997 != 0, F.col("ts_ms")),
        "line": F.when(F.col("seq") % 1499 != 0, F.col("line")),
    })
    good, bad = split_encode_errors(encode_json(cut))
    return error_counts(bad, "encode").unionAll(
        good.agg(F.lit("encode").alias("stage"), F.lit("none").alias("reason"), F.count("*").alias("errors"))
    )


def label_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.table(spark, sf_dir, "documents").select(
        "doc_id", selector(F.create_map(F.lit("lang"), "lang", F.lit("quote"), F.concat(F.lit('"'), "text", F.lit('"\\')))).alias("selector")
    )


def _shipped(spark: SparkSession, sf_dir: str, protocol: str) -> DataFrame:
    """The whole flow: shape, refuse, cut by items, bytes and idle time, group, encode."""
    options = ShipOptions(
        X.SHOP_LABELS, X.SHOP_METADATA, X.SHOP_LINE, shard=["thread"], max_items=ITEMS, max_bytes=BYTES,
        timeout_ms=IDLE_MS, protocol=protocol, block_rows=BLOCK,
    )
    return ship(X.shop_events(spark, sf_dir), options, stage=f"flow-{protocol}").payloads


def ship_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(_shipped(spark, sf_dir, "json"), "payload_json")


def ship_proto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with compressed Protobuf; the digest is that of the message before compression."""
    plain = decompress_snappy(_shipped(spark, sf_dir, "proto"))
    return _digest(plain.withColumn("size_bytes", F.octet_length("payload_bin")), "payload_bin")


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = read_payloads(encode_json(_counted(spark, sf_dir)).select("batch_no", "payload_json"))
    return _text_maps(back).select("batch_no", "labels", "entry_no", "ts_ms", "nanos_in_ms", "line", "metadata")


def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = _counted(spark, sf_dir)
    return reconcile(cut, read_payloads(encode_json(cut).select("payload_json")))


def proto_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with compressed Protobuf, from a written table of payloads."""
    cut = _counted(spark, sf_dir)
    path = _fresh(spark, "proto")
    write_payloads(compress_snappy(encode_proto(cut)).select("batch_no", "payload_bin"), path)
    return reconcile(cut, read_proto_payloads(spark.read.parquet(path), snappy=True))


def payload_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation when the batches of one condition were never stored."""
    cut = cut_batches(X.turn_records(spark, sf_dir), [], max_items=20, max_bytes=OVERSIZE, block_rows=BLOCK)
    stored = encode_json(cut).filter(F.col("condition") != "MAX_BYTES")
    return reconcile(cut, read_payloads(stored.select("payload_json")))


def payload_lost_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by digests per stream and four turns, with those of the sent records written when they are cut."""
    path = _fresh(spark, "lost")
    cut_batches(X.turn_records(spark, sf_dir), [], max_items=20, max_bytes=OVERSIZE, block_rows=BLOCK).write.parquet(f"{path}/sent")
    sent = spark.read.parquet(f"{path}/sent")
    write_payloads(encode_json(sent).filter(F.col("condition") != "MAX_BYTES").select("payload_json"), f"{path}/stored")
    stored = read_payloads(spark.read.parquet(f"{path}/stored"))
    for name, side in (("sent", sent), ("stored", stored)):
        bucket_digests(side, 4).write.parquet(f"{path}/{name}-digests")
    return reconcile_by_digest(sent, stored, 4, *(spark.read.parquet(f"{path}/{name}-digests") for name in ("sent", "stored")))


def payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_by_count(by_tenant(X.order_records(spark, sf_dir), "none"), ["tenant"], max_items=100, block_rows=BLOCK)
    path = _fresh(spark, "payloads")
    write_payloads(encode_json(cut, ["tenant"]), path, ["tenant"])
    return spark.read.parquet(path).groupBy("tenant").agg(
        F.count("*").alias("batches"), F.sum("items").alias("items"), F.sum("size_bytes").alias("bytes")
    )


def _fresh(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_folder(configure(spark))}/{name}-{uuid.uuid4().hex}"


# --- read-back -----------------------------------------------------------------------------------


def select_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = X.shop_records(spark, sf_dir)
    top = select_stream(rec, {"app": "shop", "level": "error"}, end_ns=1_705_000_000_000_000_000, limit=100)
    return top.select(F.col("seq").alias("event_id"), wire_time().alias("ts_ns"), "line")


def select_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records per line, from written payloads of which only the files with the label are opened."""
    path = _fresh(spark, "labelled")
    rec = X.shop_records(spark, sf_dir).withColumn("level", F.element_at("labels", F.lit("level")))
    cut = cut_by_count(rec, ["level"], max_items=COUNT, block_rows=BLOCK)
    write_payloads(encode_json(cut, ["level"]).select("level", "payload_json"), f"{path}/payloads", ["level"])
    write_label_index(spark, f"{path}/payloads", f"{path}/index")
    wanted = {"app": "shop", "level": "error"}
    found = read_labelled(spark, f"{path}/payloads", f"{path}/index", wanted).select("payload_json")
    hits = select_stream(read_payloads(found), wanted, end_ns=1_705_000_000_000_000_000, order="entry_no")
    return hits.groupBy("line").agg(F.count("*").alias("records"))


def select_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = X.shop_records(spark, sf_dir)
    top = select_stream(rec, {"level": "view", "missing": ""}, limit=50, direction="backward")
    return top.select(F.col("seq").alias("event_id"), wire_time().alias("ts_ns"), "line")


def drop_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = drop_labels(X.document_records(spark, sf_dir), ["source"])
    return rec.groupBy(stream_key("labels").alias("stream_key")).agg(F.count("*").alias("records"))


def stream_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = X.turn_records(spark, sf_dir)
    return order_by_stream_time(rec).select("seq", "ts_ms", stream_key("labels").alias("stream_key"))


# --- delivery ------------------------------------------------------------------------------------


def retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batch_no"))
    return retry_schedule(orders, 500, 3000, (F.col("batch_no") % 7).cast("int"))


def attempts_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_attempts(X.shop_attempts(spark, sf_dir)).select("batch_no", "attempt", "success", "retryable", "reason", "made")


def attempts_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify_attempts(X.shop_attempts(spark, sf_dir), max_retries=1, drop_rate_limited=True, sticky=False)
    return judged.select("batch_no", "attempt", "success", "retryable", "reason", "made")


def delivery_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_outcomes(classify_attempts(X.shop_attempts(spark, sf_dir)))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_states(spark, sf_dir)


def _payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of ten orders, as many as there are attempts to judge or fewer."""
    orders = X.table(spark, sf_dir, "orders")
    return orders.groupBy(F.expr("o_orderkey div 10").alias("batch_no")).agg(
        F.count("*").alias("items"), F.sum(X.cents("o_totalprice")).alias("size_bytes")
    )


def dead_letter_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(_payload_sizes(spark, sf_dir), _outcomes(spark, sf_dir))


def delivery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_metrics(_payload_sizes(spark, sf_dir), _outcomes(spark, sf_dir))


def delivery_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of order lines and prices per tenant, merged from monthly sketches, held against all values."""
    rec = by_tenant(X.order_records(spark, sf_dir), "none").withColumns({"bytes": utf8_len("line"), "cents": F.col("seq") * 7919 % 100_003})
    monthly = distributions(rec, {"bytes": "bytes", "cents": "cents"}, ["tenant"], 30 * 86_400_000)
    found = quantiles(merge_distributions(monthly, ["tenant"]))
    names = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("own")) for c in ("bytes", "cents")])
    ranked = rec.select("tenant", F.inline(names)).join(found, ["tenant", "metric"]).groupBy("tenant", "metric", "quantile", "n").agg(
        F.count("*").alias("all"), F.count_if(F.col("own") < F.col("value")).alias("below"), F.count_if(F.col("own") <= F.col("value")).alias("up_to")
    )
    off = F.lit(rank_error())
    fits = (F.col("below") / F.col("all") - off <= F.col("quantile")) & (F.col("quantile") <= F.col("up_to") / F.col("all") + off)
    return ranked.select("tenant", "metric", "quantile", "n", ((F.col("n") == F.col("all")) & fits).alias("within"))


def send_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify_attempts(X.shop_attempts(spark, sf_dir))
    return attempt_errors(judged, delivery_outcomes(judged), 2)


def send_errors_from_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same attempts, numbered from 1."""
    judged = classify_attempts(X.shop_attempts(spark, sf_dir).withColumn("attempt", F.col("attempt") + 1))
    return attempt_errors(judged, delivery_outcomes(judged), 2)


def unsent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = X.table(spark, sf_dir, "lineitem").groupBy(F.expr("l_orderkey div 4").alias("batch_no")).agg(F.count("*").alias("items"))
    return unsent(orders, _outcomes(spark, sf_dir))


def thin_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = X.table(spark, sf_dir, "events").select("event_id", "event_type")
    return thin_by_count(ev, ["event_type"], "event_id", BLOCK)


def push_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the orders sent as files; what arrived is read back and set beside the attempts."""
    folder = _fresh(spark, "pushed")
    payloads = encode_json(cut_by_count(X.order_records(spark, sf_dir), max_items=COUNT, block_rows=BLOCK))
    uri = folder if "://" in folder else f"file://{folder}"
    write_push(payloads, file_transport(f"{uri}/bodies"), PushOptions(run_id="run"), f"{folder}/attempts", Ledger(f"{uri}/ledger"))
    attempts = spark.read.parquet(f"{folder}/attempts")
    bodies = spark.read.format("binaryFile").load(f"{folder}/bodies/run/*.body").select(
        F.regexp_extract("path", r"(\d+)\.body$", 1).cast("bigint").alias("batch_no"),
        F.md5("content").alias("body_md5"), F.col("length").cast("bigint").alias("body_bytes"),
    )
    return attempts.join(bodies, "batch_no", "left").select("batch_no", "attempt", "status", "body_md5", "body_bytes")


# --- streams -------------------------------------------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """The events' table arriving by quarters of the id range (null ids with the first): each time, the stream of all so far.

    The rows of a quarter come in as many files as Spark deals out and are one trigger, whose rows are shaped on all cores.
    """
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    low, high = source.agg(F.min("event_id"), F.max("event_id")).first()
    step = 1 if low is None else (high - low) // 4 + 1
    quarter = F.coalesce(F.expr(f"(event_id - {low or 0}) div {step}"), F.lit(0))
    for k in range(4):
        source.where(quarter == k).write.mode("append").parquet(f"{folder}/in")
        yield stream_events(spark, f"{folder}/in", "parquet", source.schema, X.shop_mapping(), 1_000_000, spread_by="event_id")


def _shop_lines(events: DataFrame) -> DataFrame:
    return project_records(events.withColumn("shard", F.col("thread")), X.SHOP_LABELS, X.SHOP_METADATA, X.SHOP_LINE, keep=["shard"])


def _run_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(closed batches, the query's checkpoint) of a stream that is stopped and goes on three times."""
    folder = _fresh(spark, "stream")
    for events in _arrivals(spark, sf_dir, folder):
        kept, _ = split_bad(_shop_lines(events), ["shard"])
        cut = cut_batches_stream(kept, ["shard"], max_items=ITEMS, max_bytes=BYTES)
        query = (
            cut.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state")
            .option("path", f"{folder}/out").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.schema(cut.schema).parquet(f"{folder}/out"), f"{folder}/state"


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a stream over several triggers, with those still open when it stops."""
    closed, checkpoint = _run_stream(use_rocksdb(configure(spark)), sf_dir)
    return _batch_table(closed.unionByName(drain_open(spark, checkpoint, ["shard"])), ["shard"])


def stream_batches_no_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed, _ = _run_stream(use_rocksdb(configure(spark)), sf_dir)
    return _batch_table(closed, ["shard"])


def stream_one_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a stream as one hot shard, each trigger cut by many tasks, stopped and started in between."""
    folder = _fresh(spark, "one-shard")
    cut = ParallelCut(
        f"{folder}/out", max_items=ITEMS, max_bytes=BYTES, timeout_ms=IDLE_MS, chunk_rows=512, group_chunks=4, block_rows=BLOCK
    )
    for events in _arrivals(spark, sf_dir, folder):
        cut.start(_shop_lines(events), f"{folder}/state").awaitTermination()
    cut.drain(spark)
    return _batch_table(cut.rows(spark, "batch"), [])


def stream_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event with holes ends up in a running stream, as in the table."""
    folder = _fresh(spark, "holed")
    cut = ParallelCut(f"{folder}/out", ["shard"], max_items=COUNT, max_bytes=HOLED_BYTES, block_rows=BLOCK)
    for events in _arrivals(spark, sf_dir, folder):
        records = project_records(
            _holed(events.withColumn("shard", F.col("thread"))), X.SHOP_LABELS, X.SHOP_METADATA, X.SHOP_LINE, keep=["shard"]
        )
        cut.start(records, f"{folder}/state").awaitTermination()
    cut.drain(spark)
    return _ends(*(cut.rows(spark, state) for state in ("batch", "refused", "bad")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        event_formats, shape_records, default_rules, bulk_kvp, bulk_include_exclude, marker_labels, static_labels_shard,
        static_labels_all, logger_short, url_params, bad_records, attribute_pairs, blank_lines,
        text_layouts, json_layout, json_layout_custom, json_typed, json_deep, quoted_text,
        record_sizes, oversize, dropped_events, shape_bad_records,
        batches_by_count, batches_bounded, batches_idle, batches_no_drain, batches_one_shard,
        batches_of_text, tenant_batches, stream_groups,
        payload_json, payload_json_static, payload_text, payload_proto, payload_proto_times, payload_snappy, encode_errors, ship_json, ship_proto,
        label_selector, payload_records, payload_roundtrip, proto_roundtrip, payload_lost, payload_lost_digests, payload_files,
        select_errors, select_indexed, select_backward, drop_label, stream_time_order,
        retry_delays, attempts_classified, attempts_separate, delivery_states, dead_letter_batches,
        delivery_totals, delivery_quantiles, send_errors, send_errors_from_one, unsent_events, thin_drops, push_delivery,
        stream_batches, stream_batches_no_drain, stream_one_shard, stream_bad_records,
    )
}
