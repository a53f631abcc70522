"""Event tables and event streams, mapped to the EVENT layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT
from ..settings import configure


def record_time(ts: Column | str) -> tuple[Column, Column]:
    """(epoch milliseconds, nanoseconds within the millisecond) of a timestamp column."""
    ts = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")
    return F.unix_millis(ts), (F.pmod(F.unix_micros(ts), F.lit(1000)) * 1000).cast("int")


def wire_time(ts_ms: Column | str = "ts_ms", nanos: Column | str = "nanos_in_ms") -> Column:
    """The time text of a push entry: milliseconds followed by six digits of nanoseconds."""
    ts_ms = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    nanos = F.col(nanos) if isinstance(nanos, str) else nanos
    return F.concat(ts_ms.cast("string"), F.lpad(nanos.cast("string"), 6, "0"))


def with_record_time(df: DataFrame, ts_col: str) -> DataFrame:
    ts_ms, nanos = record_time(ts_col)
    return df.withColumns({"ts_ms": ts_ms, "nanos_in_ms": nanos})


@dataclass
class EventMapping:
    """Where each EVENT column comes from: a column name, a Column, or nothing (null).

    ``seq`` is the arrival order. It has to be an integer that is unique within a shard; a table
    has no arrival order of its own, so there is no default.
    """

    seq: str | Column
    ts: str | Column | None = None
    columns: dict[str, str | Column] = field(default_factory=dict)
    keep: tuple[str, ...] = ()

    def select(self, df: DataFrame) -> DataFrame:
        given: dict[str, str | Column] = {"seq": self.seq, **self.columns}
        if self.ts is not None:
            given["ts_ms"], given["nanos_in_ms"] = record_time(self.ts)
        unknown = set(given) - set(EVENT.names)
        if unknown:
            raise ValueError(f"not an event column: {sorted(unknown)}")
        out = []
        for f in EVENT.fields:
            c = given.get(f.name)
            c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
            out.append(c.cast(f.dataType).alias(f.name))
        return df.select(*out, *self.keep)


def spread(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Spread an input over ``parts`` partitions by hash of ``key``.

    Shaping is the costly part and runs in the scan stage, so a table in one small file would keep a
    single core busy. Inputs of many splits need no such shuffle.
    """
    return df.repartition(parts, key)


def read_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    mapping: EventMapping | None = None,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Scan an event table (parquet, orc, json, csv, ...) into the EVENT layout.

    The mapping is a projection, so column pruning and filters still reach the scan.
    """
    configure(spark)
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return mapping.select(df) if mapping else df


def stream_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    mapping: EventMapping | None = None,
    max_files: int = 1,
    spread_by: str | None = None,
    **options: str,
) -> DataFrame:
    """The same, unbounded. ``max_files`` per trigger limits the rate, so that no event is refused.

    ``spread_by`` deals the rows of a trigger out to all cores by hash of a column, where its files are fewer than those.
    """
    configure(spark)
    reader = spark.readStream.format(fmt).options(**options).option("maxFilesPerTrigger", max_files)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    if spread_by is not None:
        df = spread(df, spread_by, spark.sparkContext.defaultParallelism)
    return mapping.select(df) if mapping else df
