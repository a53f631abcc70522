"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import shared_folder


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names; whatever else the table holds cannot clash."""
    return df.select(*[df[quoted(source)].alias(name) for name, source in columns.items()])


def quoted(name: str) -> str:
    """The name as a column reference; names may hold dots."""
    return "`" + name.replace("`", "``") + "`"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under a fresh name in the shared folder and read it again.

    Cuts the lineage: lost executors cost no recomputation, and readers get single columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit the limit; else Spark shuffles it.

    ``row_bytes`` is what a row takes in a broadcast hash table: 48 for one number as key, else 160.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that texts become Python strings a few at a time.

    What a batch took goes back to the system before the next one, since workers live long.
    """
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
        del batch
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_components(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null for vectors that take no part."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)))


def unit_draw(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the key's MD5; the same on every engine."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def per_group(rows: DataFrame, keys: list[str], of: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``of`` applied to every group of rows with equal keys; groups without a result give None.

    Like ``applyInPandas``, but many small groups share a batch. A task holds a batch and one group.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in chain(frames, [None]):
            if frame is None:
                ready, rest = rest, None
            else:
                frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
                if frame.empty:
                    continue
                other = (frame[keys] != frame[keys].iloc[-1]).any(axis=1).to_numpy()
                done = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
                ready, rest = frame.iloc[:done], frame.iloc[done:]
            if ready is None or ready.empty:
                continue
            begins = np.flatnonzero((ready[keys] != ready[keys].shift()).any(axis=1).to_numpy())
            for begin, end in zip(begins, [*begins[1:], len(ready)], strict=True):
                found = of(ready.iloc[begin:end])
                if found is not None:
                    yield found

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
