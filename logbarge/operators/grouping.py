"""Records of one label set brought together inside their batch, and stored-order sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stream_key
from .sizing import with_size


def prepared(df: DataFrame) -> DataFrame:
    """Make sure the size columns and the stream key are there."""
    df = df if "msg_sz" in df.columns else with_size(df)
    return df if "stream_key" in df.columns else df.withColumn("stream_key", stream_key("labels"))


def group_streams(
    df: DataFrame,
    aggs: Sequence[Column],
    keys: Sequence[str] = (),
    order: str = "seq",
    static: bool = False,
) -> DataFrame:
    """One row per (batch, stream): condition, first labels, items, bytes, and the given aggregates.

    The one shuffle is on (keys, batch_no); a batch is bounded, so no group can grow with the data.
    ``static`` is the path for static labels: a batch is one stream and its records are not grouped.
    """
    batch = [*keys, "batch_no"]
    df = prepared(df).repartition(*batch)
    group = batch if static else [*batch, "stream_key"]
    common = [
        F.first("condition").alias("condition"),
        F.min_by("labels", order).alias("labels"),
        F.count("*").alias("items"),
        (F.sum(F.col("msg_sz") + F.col("meta_sz")) + F.max("stream_sz")).alias("est_bytes"),
    ]
    if static:
        common.append(F.min_by("stream_key", order).alias("stream_key"))
    return df.groupBy(*group).agg(*common, *aggs)


def order_by_stream_time(df: DataFrame, order: str = "seq") -> DataFrame:
    """Sort by label text regardless of case, then by time; arrival order breaks ties."""
    key = F.col("stream_key") if "stream_key" in df.columns else stream_key("labels")
    return df.orderBy(F.lower(key), "ts_ms", order)
