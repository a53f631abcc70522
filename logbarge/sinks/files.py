"""Payload tables for replay and audit, and payloads as files of their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.payloads import PUSH
from ..sources.protobuf import read_proto_payloads


def write_payloads(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "append"
) -> None:
    """Write payloads as files, partitioned by tenant or other low-cardinality columns.

    Rows are rebalanced by the partition columns first: small tenants do not end up in one file per
    task, and a tenant with much of the data is split over several tasks. The text format takes a single column, so it fits ``encode_text(..).select("payload_text")``.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_label_index(spark: SparkSession, path: str, index: str, col: str = "payload_json") -> None:
    """Note which labels occur in which payload file: a table (file, name, value) in ``index``.

    Covers the files that are there; run it again after more are written, and only those are read. An
    exact inverted index, one row per label of a file, whose size follows from files and labels, not
    from records.
    """
    payloads = spark.read.parquet(path).select(F.col(col), F.col("_metadata.file_path").alias("file"))
    known = _index(spark, index)
    if known is not None:
        payloads = payloads.join(known.select("file").distinct(), "file", "left_anti")
    if "json" in col:
        streams = payloads.select("file", F.explode(F.from_json(col, PUSH, {"mode": "FAILFAST"})["streams"]["stream"]).alias("labels"))
    else:
        streams = read_proto_payloads(payloads.select("file", col), col).select("file", "labels")
    labels = streams.select("file", F.explode("labels").alias("name", "value")).distinct()
    # a file without labels is known all the same
    files = payloads.select("file").distinct().select("file", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))
    labels.unionByName(files).write.mode("append").parquet(index)


def _index(spark: SparkSession, index: str) -> DataFrame | None:
    try:
        return spark.read.schema("file string, name string, value string").parquet(index)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def read_labelled(spark: SparkSession, path: str, index: str, matchers: Mapping[str, str]) -> DataFrame:
    """The payloads of the files that have all these labels; others are not opened.

    A matcher with an empty value, which a missing label fits as well, excludes no file. Files that the
    index does not know are read. What is in the files is still to be filtered by record.
    """
    payloads = spark.read.parquet(path)
    known, wanted = _index(spark, index), {n: v for n, v in matchers.items() if v != ""}
    if known is None or not wanted:
        return payloads
    fits = [F.coalesce(F.max((F.col("name") == n) & (F.col("value") == v)), F.lit(False)) for n, v in wanted.items()]
    out = known.groupBy("file").agg(reduce(and_, fits).alias("fits")).where("not fits").select("file")
    # names of files, as the listing of the table holds them; a filter on them prunes it
    without = [r.file for r in out.collect()]
    return payloads.where(~F.col("_metadata.file_path").isin(without)) if without else payloads


def file_transport(folder: str):
    """A transport that puts each body into ``folder`` (a URI that Arrow can open), under its idempotency key."""

    def put(body: bytes, headers: dict) -> tuple[int, str]:
        files, path = fs.FileSystem.from_uri(folder)
        name = f"{path.rstrip('/')}/{headers['Idempotency-Key']}"
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(f"{name}.tmp") as out:
            out.write(body)
        files.move(f"{name}.tmp", f"{name}.body")
        return 204, ""

    return put
