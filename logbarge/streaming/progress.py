"""Durations of the stages of a streaming query as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("trigger_no", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("input_rows", T.LongType()),
    ]
)


def _rows(progress: dict) -> list[tuple]:
    return [
        (progress.get("name"), str(progress["runId"]), int(progress["batchId"]), stage, int(ms),
         int(progress["numInputRows"]))
        for stage, ms in sorted(progress["durationMs"].items())
    ]


def stage_times(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Stage durations of the triggers Spark still remembers (a fixed number of them)."""
    rows = [r for p in query.recentProgress for r in _rows(json.loads(p.json))]
    return spark.createDataFrame(rows, SCHEMA)


class StageTimes(StreamingQueryListener):
    """Appends the durations of every trigger to a table; one small file per trigger."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        rows = _rows(json.loads(event.progress.json))
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
