"""The whole flow from events to payloads in one call."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from ..operators.batching import cut_batches, cut_by_count
from ..operators.encoding import compress_snappy, encode_json, encode_proto, encode_text
from ..operators.grouping import prepared
from ..operators.projection import check_static, project_records, split_bad, static_labels
from ..operators.sizing import split_oversize
from ..settings import BLOCK_ROWS, DEFAULT_MESSAGE, DEFAULT_METADATA, MAX_BYTES, MAX_ITEMS, shared_folder


@dataclass
class ShipOptions:
    """What the flow does; the defaults are the usual ones of such shippers."""

    labels: str
    metadata: str | None = DEFAULT_METADATA
    message: str | Column = DEFAULT_MESSAGE
    read_markers: bool = False
    static_labels: bool = False
    shard: Sequence[str] = ()
    max_items: int = MAX_ITEMS
    max_bytes: int = MAX_BYTES
    timeout_ms: int | None = None
    drain_on_stop: bool = True
    count_only: bool = False
    protocol: str = "json"
    block_rows: int = BLOCK_ROWS
    chunk_rows: int = BLOCK_ROWS


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder, under a name of this call's own, and read them back.

    Worth it for wide or costly projections: batching reads its input more than once, and a written
    table also survives lost executors.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shape(events: DataFrame, options: ShipOptions) -> DataFrame:
    """Events to records with their sizes and stream keys.

    A table of these lets the batching passes read a few narrow columns instead of rendering records.
    """
    if options.static_labels:
        check_static(options.labels, options.read_markers)
    records = project_records(
        events, options.labels, options.metadata, options.message, options.read_markers, options.shard
    )
    if options.static_labels:
        records = static_labels(records, keys=options.shard)
    return prepared(records)


def batch(records: DataFrame, options: ShipOptions) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records with their batch, refused records, bad records with a reason)."""
    keys = list(options.shard)
    good, bad = split_bad(records, keys)
    kept, refused = split_oversize(good, options.max_bytes)
    if options.count_only:
        cut = cut_by_count(
            kept, keys, max_items=options.max_items, drain_on_stop=options.drain_on_stop,
            block_rows=options.block_rows,
        )
    else:
        cut = cut_batches(
            kept, keys, max_items=options.max_items, max_bytes=options.max_bytes,
            timeout_ms=options.timeout_ms, drain_on_stop=options.drain_on_stop,
            block_rows=options.block_rows, chunk_rows=options.chunk_rows,
        )
    return cut, refused, bad


def encode(batched: DataFrame, options: ShipOptions) -> DataFrame:
    """Batches to payloads in the chosen protocol: json, proto (compressed) or text."""
    keys = list(options.shard)
    if options.protocol == "json":
        return encode_json(batched, keys, static=options.static_labels)
    if options.protocol == "proto":
        return compress_snappy(encode_proto(batched, keys, static=options.static_labels))
    if options.protocol == "text":
        return encode_text(batched, keys, static=options.static_labels)
    raise ValueError(f"unknown protocol: {options.protocol}")


class Shipped(NamedTuple):
    """Every event is in one of the three: in a payload, too large, or bad (with a reason)."""

    payloads: DataFrame
    refused: DataFrame
    bad: DataFrame


def ship(events: DataFrame, options: ShipOptions, stage: str | None = None) -> Shipped:
    """Events to payloads. ``stage`` names a table in the shared folder for the shaped records."""
    records = shape(events, options)
    if stage:
        records = staged(records, stage)
    cut, refused, bad = batch(records, options)
    return Shipped(encode(cut, options), refused, bad)


__all__ = ["ShipOptions", "Shipped", "batch", "encode", "shape", "ship", "staged"]
