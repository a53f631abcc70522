"""Exact batches of a stream without one task per shard, and without losing a record.

``cut_batches_stream`` keeps a shard's open batch with one task. Here every trigger is cut like a
table, by chunks whose transfer tables compose, so a hot shard is as many tasks as it has chunks.
Between triggers only this is kept per shard: the records of its open batch (under ``max_items``
of them), the number of the next batch, and for the idle drain how and when the last cut was made.

Each trigger sorts its records into four states: batch (closed), open, refused (too large) and bad
(with a reason), written as one table in one job. A trigger counts once its commit row is there; a
trigger that is run again overwrites what it wrote and starts from the same state, so no record is
in two batches and none is lost.

    cut = ParallelCut(folder, keys=["host"], max_items=1000)
    query = cut.start(records, checkpoint)          # a stream of records, as made by project_records
    cut.rows(spark, "batch")                        # what is committed, also while the query runs
    cut.drain(spark)                                # after a stop: open batches become DRAIN batches
    query = cut.start(records, checkpoint)          # goes on; batch numbers have no gap

The order column must be unique among the records that one shard gets in one trigger. The folder
must be reachable by all executors. Tables of the last trigger are read at the next; older
states are not needed any more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.batching import DRAIN, GROUP_CHUNKS, ITEMS, OPEN, assign_batches
from ..operators.cutting import Limits
from ..operators.grouping import prepared
from ..operators.projection import record_error
from ..settings import BLOCK_ROWS, MAX_BYTES, MAX_ITEMS

BATCH, STILL_OPEN, REFUSED, BAD = "batch", "open", "refused", "bad"


@dataclass(frozen=True)
class ParallelCut:
    """A cutter with its folder; the same arguments must be given when it goes on."""

    folder: str
    keys: Sequence[str] = ()
    order: str = "seq"
    max_items: int = MAX_ITEMS
    max_bytes: int = MAX_BYTES
    timeout_ms: int | None = None
    chunk_rows: int = BLOCK_ROWS
    group_chunks: int = GROUP_CHUNKS
    block_rows: int = BLOCK_ROWS

    # --- the stream ---

    def start(self, records: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run the cutter on a stream of records; ``trigger`` as for ``DataStreamWriter.trigger``."""
        shaped = self._judged(records)
        writer = shaped.writeStream.foreachBatch(self.cut).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def _judged(self, records: DataFrame) -> DataFrame:
        """Records with sizes, stream key and ``reason``; REFUSED stands for one that is too large."""
        records = prepared(records.withColumn("reason", record_error(self.keys, self.order)))
        fits = F.col("msg_sz") + F.col("meta_sz") + F.col("stream_sz") <= self.max_bytes
        too_large = F.col("reason").isNull() & ~F.coalesce(fits, F.lit(False))
        return records.withColumn("state", F.when(F.col("reason").isNotNull(), BAD).when(too_large, REFUSED))

    def cut(self, judged: DataFrame, trigger: int) -> None:
        """One trigger; may run again for the same trigger."""
        spark = judged.sparkSession
        # the one pass over the source; all that follows reads columns of this table
        fresh = self._written(judged, "fresh", trigger)
        before, begins = self._state(spark, fresh, trigger)
        good = fresh.where("state is null")
        first = good.agg(F.min(self.order)).first()[0]
        if first is None:
            pending = before.withColumns({"batch_no": F.lit(None).cast("bigint"), "condition": F.lit(OPEN)})
        else:
            pending = self._assigned(good, before, begins, first)
        state = F.when(F.col("condition") == OPEN, STILL_OPEN).otherwise(BATCH)
        aside = fresh.where("state is not null").withColumns({"batch_no": F.lit(None).cast("bigint"), "condition": F.lit(None).cast("string")})
        out = pending.withColumn("state", state).unionByName(aside, allowMissingColumns=True)
        rows = self._written(out, "rows", trigger)
        self._written(self._next(rows, begins), "cursor", trigger)
        self._commit(spark, "commits", trigger)

    def _assigned(self, good: DataFrame, before: DataFrame, begins: DataFrame, first: int) -> DataFrame:
        """Open records and fresh ones, in this order, with their batch."""
        shard = Window.partitionBy(*(self.keys or [F.lit(0)])).orderBy("arrived", self.order)  # under max_items rows
        place = F.lit(first).cast("bigint") - self.max_items + F.row_number().over(shard) - 1
        records = good.drop("state").withColumn("place", F.col(self.order).cast("bigint"))
        records = before.withColumn("place", place).unionByName(records)
        assigned = assign_batches(
            records, self.keys, "place", Limits(self.max_items, self.max_bytes, self.timeout_ms), chunk_rows=self.chunk_rows,
            group_chunks=self.group_chunks, block_rows=self.block_rows, begins=begins, keep_open=True,
        )
        return records.join(assigned, [*self.keys, "place"]).drop("place")

    # --- state between triggers ---

    def _state(self, spark: SparkSession, fresh: DataFrame, trigger: int) -> tuple[DataFrame, DataFrame]:
        """(open records, begins) as the last committed trigger before this one left them."""
        schema = T.StructType([f for f in fresh.schema.fields if f.name != "state"])
        last = self._last(spark, "commits", trigger)
        if last is None:
            keys = [fresh.schema[k] for k in self.keys]
            cursor = T.StructType(keys).add("next_batch", T.LongType()).add("by_items", T.BooleanType()).add("last_ts", T.LongType())
            return spark.createDataFrame([], schema), spark.createDataFrame([], cursor)
        if self._last(spark, "drains", last + 1) == last:
            return spark.createDataFrame([], schema), spark.read.parquet(self._path("drained_cursor", last))
        rows = spark.read.parquet(self._path("rows", last)).where(F.col("state") == STILL_OPEN)
        return rows.select(*schema.names), spark.read.parquet(self._path("cursor", last))

    def _next(self, rows: DataFrame, begins: DataFrame) -> DataFrame:
        """The cursor after a trigger: that of its last closed batch per shard, or the one before."""
        closed = rows.where(F.col("state") == BATCH)
        at_end = F.struct("batch_no", "arrived", self.order)
        ends = closed.groupBy(*self.keys).agg(
            (F.max("batch_no") + 1).alias("next_batch"), (F.max_by("condition", at_end) == ITEMS).alias("by_items"), F.max_by("ts_ms", at_end).alias("last_ts")
        )
        ends = ends.where("next_batch is not null").withColumn("newer", F.lit(1))
        both = ends.unionByName(begins.withColumn("newer", F.lit(0)))
        latest = both.groupBy(*self.keys).agg(F.max_by(F.struct("next_batch", "by_items", "last_ts"), "newer").alias("c"))
        return latest.where("c is not null").select(*self.keys, "c.*")

    def drain(self, spark: SparkSession) -> None:
        """Close the open batches of a stopped stream. It can be started again; running this twice changes nothing."""
        last = self._last(spark, "commits")
        if last is None or self._last(spark, "drains") == last:
            return
        rows = spark.read.parquet(self._path("rows", last))
        cursor = spark.read.parquet(self._path("cursor", last))
        still = rows.where(F.col("state") == STILL_OPEN).drop("batch_no")
        numbers = cursor.select(*self.keys, F.col("next_batch").alias("batch_no"))  # no key is null
        if self.keys:
            drained = still.join(numbers, list(self.keys), "left")
        else:
            drained = still.withColumn("batch_no", numbers.agg(F.max("batch_no")).scalar())
        drained = drained.withColumns(
            {"state": F.lit(BATCH), "condition": F.lit(DRAIN), "batch_no": F.coalesce("batch_no", F.lit(0).cast("bigint"))}
        ).select(*rows.columns)
        drained = self._written(drained, "drained", last)
        self._written(self._next(drained, cursor), "drained_cursor", last)
        self._commit(spark, "drains", last)

    # --- results ---

    def rows(self, spark: SparkSession, state: str) -> DataFrame:
        """Committed records in a state: batch, refused or bad, and open ones of the last trigger."""
        last = self._last(spark, "commits")
        if last is None:
            raise ValueError(f"no trigger is committed in {self.folder}")
        found = self._committed(spark, "rows", "commits", last).where(F.col("state") == state)
        if state == STILL_OPEN:
            drained = self._last(spark, "drains") == last
            found = found.where((F.col("trigger") == last) & F.lit(not drained))
        drains = self._last(spark, "drains")
        if state == BATCH and drains is not None:
            found = found.unionByName(self._committed(spark, "drained", "drains", drains))
        unknown = {BATCH: ["reason"], STILL_OPEN: ["reason", "batch_no", "condition"]}.get(state, ["batch_no", "condition"])
        return found.drop("state", "arrived", "trigger", *unknown)

    def _committed(self, spark: SparkSession, table: str, marks: str, last: int) -> DataFrame:
        schema = spark.read.parquet(self._path(table, last)).schema.add("trigger", T.LongType())
        commits = spark.read.schema("trigger bigint").parquet(f"{self.folder}/{marks}").select("trigger")
        return spark.read.schema(schema).parquet(f"{self.folder}/{table}").join(commits, "trigger", "left_semi")

    # --- files ---

    def _path(self, table: str, trigger: int) -> str:
        return f"{self.folder}/{table}/trigger={trigger}"

    def _written(self, df: DataFrame, table: str, trigger: int) -> DataFrame:
        path = self._path(table, trigger)
        if table == "fresh":
            df = df.withColumn("arrived", F.lit(trigger).cast("bigint"))
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _commit(self, spark: SparkSession, marks: str, trigger: int) -> None:
        spark.range(1).select(F.lit("done").alias("mark")).write.mode("overwrite").parquet(self._path(marks, trigger))

    def _last(self, spark: SparkSession, marks: str, before: int | None = None) -> int | None:
        """The last committed trigger (under ``before``), from the folder's own listing."""
        try:
            found = spark.read.schema("mark string, trigger bigint").parquet(f"{self.folder}/{marks}")
        except Exception as missing:  # nothing is committed yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None
        if before is not None:
            found = found.where(F.col("trigger") < before)
        return found.where("mark is not null").agg(F.max("trigger")).first()[0]


__all__ = ["BAD", "BATCH", "REFUSED", "STILL_OPEN", "ParallelCut"]
