"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the least node around each node: larger neighbours, or smaller ones and itself.

    The least neighbour comes from a partially combined aggregate and is joined back, so a node with
    very many links costs one row per task in the aggregate and a join side that can be split.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.where("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node that has a link to another.

    ``links`` has two columns of one ordered type; loops and repeats do not matter, nulls are left
    out. Each round is written to the shared folder; rounds grow with the logarithm of the longest
    path, and end when a round changes nothing.
    """
    a, b = links.columns
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    edges = written(edges.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    before = None
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "stars")
        # a sum of hashes tells whether the set of links is still the same
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
