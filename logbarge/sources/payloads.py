"""Read pushed JSON documents back into records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUSH = "struct<streams:array<struct<stream:map<string,string>,values:array<array<string>>>>>"


def read_payloads(df: DataFrame, col: str = "payload_json") -> DataFrame:
    """One row per pushed entry: the other columns plus labels, ts_ms, nanos_in_ms, line, metadata.

    ``entry_no`` is the position of the entry inside its stream. An entry is a list of two or three
    elements; the third is a JSON object, which the list type keeps as text for a second parse.
    A document that is not JSON fails the query, so that its entries are not lost unseen.
    """
    others = [F.col(c) for c in df.columns if c != col]
    streams = df.select(*others, F.explode(F.from_json(col, PUSH, {"mode": "FAILFAST"})["streams"]).alias("_s"))
    names = [c for c in df.columns if c != col]
    entries = streams.select(
        *names,
        F.col("_s.stream").alias("labels"),
        F.posexplode("_s.values").alias("entry_no", "_e"),
    )
    ts = F.get("_e", F.lit(0))
    meta = F.get("_e", F.lit(2))
    return entries.select(
        *names,
        "labels",
        "entry_no",
        F.substring(ts, F.lit(1), F.length(ts) - 6).cast("bigint").alias("ts_ms"),
        F.substring(ts, F.length(ts) - 5, F.lit(6)).cast("int").alias("nanos_in_ms"),
        F.get("_e", F.lit(1)).alias("line"),
        F.coalesce(
            F.from_json(meta, "map<string,string>"), F.create_map().cast("map<string,string>")
        ).alias("metadata"),
    )
