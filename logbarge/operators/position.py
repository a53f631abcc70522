"""Exact positions of rows within a shard, without one task per shard.

``row_number() over (partition by shard order by seq)`` sends a whole shard to one task. Here the
order column, an integer that is unique within its shard, is first cut into blocks of ``block_rows``
consecutive values, so a block never holds more than ``block_rows`` rows however hot its shard is.
Rows are numbered inside their block and shifted by the row count of the earlier blocks.

Shuffles: one of the rows, on (shard, block); the block counts are combined on the map side and are
``block_rows`` times fewer than the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import BLOCK_ROWS


# With more blocks than this in a shard, a block must hold this many rows on average.
MANY_BLOCKS, SPARSE = 100_000, 16


def required(name: str) -> Column:
    """The column, failing on null: a null key or order would silently lose its rows in a join."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} must not be null"))).alias(name)


def _once(order: str, inside) -> Column:
    """The row number, failing where the row before has the same order value."""
    repeated = F.lag(order).over(inside) == F.col(order)
    return F.when(repeated, F.raise_error(F.lit(f"{order} is not unique"))).otherwise(F.row_number().over(inside))


def block_width(df: DataFrame, order: str = "seq", rows: int = BLOCK_ROWS) -> int:
    """A block width for a sparse order column, such as a time in nanoseconds.

    Runs one small aggregate. The width spans ``rows`` rows at the average density, so the number of
    blocks stays ``rows`` times below the number of rows.
    """
    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    return rows if not n else max(rows, (high - low + 1) * rows // n)


def with_position(
    df: DataFrame,
    order: str = "seq",
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    counted: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``pos`` (0-based position in the shard) and ``shard_rows`` (rows of the shard).

    Keys and order must not be null. ``block_rows`` is the width of a block in units of the order
    column; a sparse one wants more (see ``block_width``), and fails if it would give as many blocks
    as rows. ``counted`` may give the same rows by a
    cheaper plan, of which only keys and order are read for the block counts. ``unique`` fails on
    an order value that a shard has twice, which would leave the positions to chance.
    """
    keys = list(keys)

    def in_blocks(rows: DataFrame) -> DataFrame:
        checked = rows.withColumns({c: required(c) for c in (*keys, order)})
        return checked.withColumn("_block", F.expr(f"`{order}` div {int(block_rows)}"))

    rows = in_blocks(df)
    counts = (rows if counted is None else in_blocks(counted.select(*keys, order))).groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    shard = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = shard.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_block",
        F.when(
            (F.count("*").over(shard) > MANY_BLOCKS) & (F.sum("_n").over(shard) < SPARSE * F.count("*").over(shard)),
            F.raise_error(F.lit(f"{order} is sparse: take block_rows from block_width()")),
        ).otherwise(F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_before"),
        F.sum("_n").over(shard).alias("shard_rows"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    return (
        rows.join(offsets, [*keys, "_block"])
        .withColumn("pos", (_once(order, inside) if unique else F.row_number().over(inside)) - 1 + F.col("_before"))
        .select(*df.columns, "pos", "shard_rows")
    )
