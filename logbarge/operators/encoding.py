"""Batches to payloads: JSON, Protobuf, Snappy, and the debugging text format."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import parts, plain
from ..functions.json import json_quote
from ..functions.text import map_text, selector
from ..functions.wire import bytes_field, int_field, pair_fields, text_field
from ..sources.events import wire_time
from .grouping import group_streams
from .projection import record_error

# Fixed value: the separator of the debugging format.
TEXT_SEPARATOR = " %%% "


def json_entry() -> Column:
    """``["time","line"]``, or with the metadata object as a third element."""
    pair = F.concat(F.lit('["'), wire_time(), F.lit('",'), json_quote("line"))
    return F.concat(
        pair,
        F.when(F.size("metadata") > 0, F.concat(F.lit(","), F.to_json("metadata"))).otherwise(""),
        F.lit("]"),
    )


def encode_json(
    df: DataFrame, keys: Sequence[str] = (), order: str = "seq", static: bool = False
) -> DataFrame:
    """One JSON push document per batch; streams in key order, entries in arrival order."""
    streams = group_streams(
        _sound(df.withColumn("_entry", json_entry()), order),
        [F.expr(f"listagg(_entry, ',') within group (order by {order})").alias("_entries"), *_entry_check()],
        keys, order, static,
    ).withColumn(
        "_stream",
        F.concat(
            F.lit('{"stream":'), F.to_json("labels"), F.lit(',"values":['), F.col("_entries"), F.lit("]}")
        ),
    )
    payload = F.expr("listagg(_stream, ',') within group (order by stream_key)")
    out = _per_batch(streams, keys, F.concat(F.lit('{"streams":['), payload, F.lit("]}")), "payload_json")
    return out.withColumn("size_bytes", F.octet_length("payload_json"))


def encode_proto(
    df: DataFrame, keys: Sequence[str] = (), order: str = "seq", static: bool = False
) -> DataFrame:
    """One Protobuf push message per batch, not compressed, in ``payload_bin``."""
    entries = (
        df.withColumns(
            {
                "_seconds": F.expr("ts_ms div 1000"),
                "_nanos": F.expr("ts_ms % 1000 * 1000000 + nanos_in_ms"),
                "_line": F.encode("line", "UTF-8"),
                "_pairs": F.expr(pair_fields(3, "metadata")),
            }
        )
        .withColumn("_time", F.expr(f"concat({int_field(1, '_seconds')}, {int_field(2, '_nanos')})"))
        .withColumn("_body", F.expr(f"concat({bytes_field(1, '_time', 1)}, {text_field(2, '_line')}, _pairs)"))
        .withColumn("_entry", F.expr(bytes_field(2, "_body")))
        .drop("_seconds", "_nanos", "_line", "_pairs", "_time", "_body")
    )
    streams = (
        group_streams(
            _sound(entries, order),
            [F.expr(f"listagg(_entry, X'') within group (order by {order})").alias("_entries"), *_entry_check()],
            keys, order, static,
        )
        .withColumn("_labels", F.encode(selector("labels"), "UTF-8"))
        .withColumn("_body", F.expr(f"concat({text_field(1, '_labels')}, _entries)"))
        .withColumn("_stream", F.expr(bytes_field(1, "_body", 5)))
    )
    payload = F.expr("listagg(_stream, X'') within group (order by stream_key)")
    out = _per_batch(streams, keys, payload, "payload_bin")
    return out.withColumn("size_bytes", F.octet_length("payload_bin"))


def encode_text(
    df: DataFrame, keys: Sequence[str] = (), order: str = "seq", static: bool = False
) -> DataFrame:
    """One text per batch with a line per record: labels, metadata, ``ts=<ms> <line>``."""
    line = F.concat(
        map_text("labels"), F.lit(TEXT_SEPARATOR), map_text("metadata"), F.lit(TEXT_SEPARATOR),
        F.lit("ts="), F.col("ts_ms").cast("string"), F.lit(" "), F.col("line"), F.lit("\n"),
    )
    streams = group_streams(
        _sound(df.withColumn("_entry", line), order),
        [F.expr(f"listagg(_entry, '') within group (order by {order})").alias("_entries"), *_entry_check()],
        keys, order, static,
    )
    payload = F.expr("listagg(_entries, '') within group (order by stream_key)")
    out = _per_batch(streams, keys, payload, "payload_text")
    return out.withColumn("size_bytes", F.octet_length("payload_text"))


def _sound(df: DataFrame, order: str) -> DataFrame:
    """Add ``_error``, why the record has no entry; a record with an error must not have one."""
    lost = F.when(F.col("_entry").isNull(), F.lit("entry not encoded"))
    checked = df.withColumn("_error", F.coalesce(record_error(order=order), lost))
    return checked.withColumn("_entry", F.when(F.col("_error").isNull(), F.col("_entry")))


def _entry_check() -> list[Column]:
    """Per stream: the entries written and, if any is missing, why."""
    return [F.count("_entry").alias("_written"), F.min("_error").alias("_error")]


def _per_batch(streams: DataFrame, keys: Sequence[str], payload: Column, name: str) -> DataFrame:
    """One row per batch. A batch with fewer entries than items has no payload but an ``encode_error``."""
    whole = F.sum("_written") == F.sum("items")
    return streams.groupBy(*keys, "batch_no").agg(
        F.first("condition").alias("condition"),
        F.sum("items").alias("items"),
        F.count("*").alias("streams"),
        F.sum("est_bytes").alias("est_bytes"),
        F.when(whole, payload).alias(name),
        F.when(~whole, F.coalesce(F.min("_error"), F.lit("entry not encoded"))).alias("encode_error"),
    )


def _mapped(df: DataFrame, col: str, fn, packed: bool = False) -> DataFrame:
    """Apply ``fn(bytes) -> bytes`` to one binary column, part by part; ``packed`` values are Snappy blocks."""
    at = df.columns.index(col)

    def run(batches):
        for batch in batches:
            for part in parts(batch, at, packed):
                values = pa.array([None if v is None else fn(v) for v in part.column(at).to_pylist()], pa.binary())
                yield part.set_column(at, part.schema.field(at).name, values)

    return df.mapInArrow(run, df.schema)


def compress_snappy(df: DataFrame, col: str = "payload_bin") -> DataFrame:
    """Compress a binary column to raw Snappy blocks; ``size_bytes`` becomes the compressed size."""
    out = _mapped(df, col, lambda v: pa.compress(v, codec="snappy", asbytes=True))
    return out.withColumn("size_bytes", F.octet_length(col)) if "size_bytes" in df.columns else out


def decompress_snappy(df: DataFrame, col: str = "payload_bin") -> DataFrame:
    """Undo ``compress_snappy``; a raw block starts with its plain length as a varint."""
    return _mapped(df, col, plain, packed=True)


def split_encode_errors(
    payloads: DataFrame, col: str = "payload_json", check: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(encoded batches, failed batches with a ``reason``): a bad value fails its batch, not the job.

    A batch fails with the reason of the encoder, or without a payload, or when it does not pass
    ``check`` (a boolean Column). An error raised by an expression itself still ends the job.
    """
    told = F.col("encode_error") if "encode_error" in payloads.columns else F.lit(None)
    reason = F.when(F.col(col).isNull(), F.coalesce(told, F.lit("no payload")))
    if check is not None:
        reason = reason.when(~F.coalesce(check, F.lit(False)), F.lit("invalid payload"))
    tagged = payloads.withColumn("reason", reason)
    good = tagged.filter(F.col("reason").isNull()).drop("reason")
    return good, tagged.filter(F.col("reason").isNotNull())


__all__ = [
    "compress_snappy", "decompress_snappy", "encode_json", "encode_proto", "encode_text",
    "json_entry", "split_encode_errors",
]
