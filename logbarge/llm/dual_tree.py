"""Exact top-k inner products by a dual-tree search over cover trees.

Both sides are indexed in trees whose nodes cover their points within a radius. For a query node with
centre p and radius r and a data node with centre c and radius s,

    q.x <= p.c + r |c| + |p| s + r s

for all pairs below, so the pair of nodes is skipped if that is under the worst k-th score of the
query node's group.

The tops of both trees are one net of farthest points of a bounded sample, to which all rows are dealt;
radii are aggregated from all rows. Each group of queries first searches the data node of the
greatest bound. The k-th scores it gets there decide which other pairs of nodes remain, before any
vector moves: a block of data is copied only to the crowds of queries that want it. A node of many
rows is cut into blocks by a hash, so a hot node is many tasks.

Below, a task grows a cover tree over its queries and one over its block: the children of a node are
centres at most its radius away, more than half of it apart, each covering what lies within half of
it. What is not skipped ends in a matrix product. In many dimensions a level may hardly separate
its points; then the rest stays loose in the node instead of becoming one node per point. Each
task gives k rows per query, and the best k of all tasks are the answer.

Scores are exact: components are whole numbers, products are summed in doubles while every partial
sum is below 2^53, else in unbounded integers and cut to 64 bits.

Defined results: vectors that are null or hold a null or non-finite component take no part, and
vectors of different lengths are not compared. Rows with equal ids are rows of their own: only the
query's own row is left out. A null id is never a query and comes last among ties. Fewer than k
candidates give fewer rows; an empty table gives none. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import pick, small, whole_components, written
from .hard_negatives import KEYS, crowds, dealt_to_nodes, matrix, net_of

#: Points that a node may hold without children; centres tried in a row without covering more.
LEAF, TRIES = 64, 32


@dataclass
class Node:
    center: np.ndarray
    radius: float
    members: np.ndarray
    loose: np.ndarray
    children: list[Node] = field(default_factory=list)
    norm: float = 0.0


def cover_tree(points: np.ndarray, members: np.ndarray) -> Node:
    """The tree over ``points[members]``; ``loose`` are a node's points that no child covers."""
    center = points[members[0]]
    radius = float(np.sqrt(((points[members] - center) ** 2).sum(1).max()))
    node = Node(center, radius * (1 + 1e-9), members, members, [], float(np.linalg.norm(center)))
    if len(members) <= LEAF or radius == 0:
        return node
    rest, loose, idle = members, [], 0
    while len(rest) and idle < TRIES:
        near = ((points[rest] - points[rest[0]]) ** 2).sum(1) <= (radius / 2) ** 2
        group, rest = rest[near], rest[~near]
        if len(group) > LEAF:
            node.children.append(cover_tree(points, group))
            idle = 0
        else:
            loose.append(group)
            idle += 1
    node.loose = np.concatenate([*loose, rest]) if loose or len(rest) else rest
    return node


class Search:
    """Best k data rows per query of one block pair; data rows must come in the order that breaks ties."""

    def __init__(
        self, queries: np.ndarray, query_uids: np.ndarray, data: np.ndarray, data_uids: np.ndarray, k: int, floor: np.ndarray | None = None
    ):
        self.queries, self.data, self.k = queries, data, k
        self.scores = np.full((len(queries), k), -np.inf)
        # scores that k rows elsewhere reach; pairs compared
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor.astype(float)
        self.compared = 0
        self.rows = np.full((len(queries), k), -1)
        place = {int(u): i for i, u in enumerate(data_uids)}
        self.own = np.array([place.get(int(u), -1) for u in query_uids])

    def run(self) -> None:
        if len(self.queries) and len(self.data):
            everyone = np.arange(len(self.queries)), np.arange(len(self.data))
            self.visit(cover_tree(self.queries, everyone[0]), cover_tree(self.data, everyone[1]))

    @staticmethod
    def bound(q: Node, d: Node) -> float:
        most = q.center @ d.center + q.radius * d.norm + q.norm * d.radius + q.radius * d.radius
        return most + 1e-9 * (1 + abs(most))

    def least(self, of: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[of, -1], self.floor[of])

    def visit(self, q: Node, d: Node) -> None:
        if self.bound(q, d) < self.least(q.members).min():
            return
        if q.children and q.radius >= d.radius:
            parts = [*q.children, Node(q.center, q.radius, q.loose, q.loose, [], q.norm)] if len(q.loose) else q.children
            for part in parts:
                self.visit(part, d)
            return
        for child in sorted(d.children, key=lambda c: -self.bound(q, c)):
            self.visit(q, child)
        for k in range(0, len(d.loose), 1024):
            self.compare(q.members, d.loose[k : k + 1024])

    def compare(self, of: np.ndarray, with_: np.ndarray) -> None:
        product = self.queries[of] @ self.data[with_].T
        self.compared += product.size
        r, c = np.nonzero((product >= self.least(of)[:, None]) & (with_[None, :] != self.own[of][:, None]))
        if not len(r):
            return
        hit = np.unique(r)
        at = of[hit]
        old_r = np.repeat(hit, self.k)
        rows = np.concatenate([r, old_r])
        score = np.concatenate([product[r, c], self.scores[at].ravel()])
        place = np.concatenate([with_[c], self.rows[at].ravel()])
        order = np.lexsort((place, -score, rows))
        rows, score, place = rows[order], score[order], place[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < self.k
        spot = of[rows[keep]], rank[keep]
        self.scores[spot], self.rows[spot] = score[keep], place[keep]


def exact_search(
    queries: np.ndarray, query_uids: np.ndarray, data: np.ndarray, data_uids: np.ndarray, k: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Rows (-1: none) and integer scores of the best k; components may be of any size."""
    most = max((abs(int(x)) for a in (queries, data) if a.size for x in (a.min(), a.max())), default=0)
    if most * most * max(1, data.shape[1]) < 1 << 53:
        search = Search(queries.astype(float), query_uids, data.astype(float), data_uids, k, floor)
        search.run()
        return search.rows, np.where(np.isfinite(search.scores), search.scores, 0).astype(np.int64)
    rows, scores = np.full((len(queries), k), -1), np.zeros((len(queries), k), np.int64)
    whole = data.astype(object)
    for i, q in enumerate(queries.astype(object)):
        inner = whole @ q
        found = sorted((-int(x), j) for j, x in enumerate(inner) if data_uids[j] != query_uids[i])[:k]
        rows[i, : len(found)] = [j for _, j in found]
        scores[i, : len(found)] = [min(max(-x, -(1 << 63)), (1 << 63) - 1) for x, _ in found]
    return rows, scores


def with_partners(groups: DataFrame, centers: dict[int, np.ndarray], radii: dict[int, np.ndarray], first: bool) -> DataFrame:
    """Groups of queries (dims, qnode, crowd, reach, worst) with the data nodes to search.

    First the node of the greatest bound, as ``home``; then all others whose bound reaches the worst k-th
    score of the group.
    """
    names = [c for c in groups.columns if c not in ("home", "nodes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, nodes = [], []
            for row in batch.to_pylist():
                net = centers.get(row["dims"])
                if net is None:  # a length that the sample did not have: one node
                    home.append(-1)
                    nodes.append([-1] if first else [])
                    continue
                p, r, s = net[row["qnode"]], row["reach"], radii[row["dims"]]
                most = net @ p + r * np.sqrt((net * net).sum(1)) + np.sqrt(p @ p) * s + r * s
                most = np.where(s >= 0, most + 1e-6 * (1 + np.abs(most)), -np.inf)
                best = int(most.argmax())
                home.append(best if first else row["home"])
                nodes.append([best] if first else [int(k) for k in np.flatnonzero(most >= row["worst"]) if k != row["home"]])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(home, pa.int32()), pa.array(nodes, pa.list_(pa.int32()))], [*names, "home", "nodes"]
            )

    schema = groups.select(*names).schema.add("home", T.IntegerType()).add("nodes", T.ArrayType(T.IntegerType()))
    return groups.mapInArrow(run, schema)


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_column: str = "vec_id",
    vector_column: str = "embedding", query_block: int = 2048, data_block: int = 8192, sample_rows: int = 4096, most_nodes: int = 1024,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """query_id, rank, vec_id, score for each row whose id is divisible by ``every``."""
    rows = pick(vectors, vec_id=id_column, vector=vector_column)
    rows = rows.select("vec_id", whole_components(F.col("vector"), scale).alias("v")).where("v is not null")
    rows = written(rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("v").alias("dims"), "v"), "whole-vectors")
    total = rows.count()
    centers = net_of(rows, total, data_block, sample_rows, most_nodes)
    dealt = written(dealt_to_nodes(rows, centers, 0.0), "vectors-by-node")
    asked = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    nodes = written(dealt.groupBy("dims", "node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(asked.cast("long")).alias("anchors"), F.max("distance").alias("radius"),
    ), "vector-nodes")
    parts = small(nodes.select("dims", "node", F.ceil(F.col("n") / data_block).cast("int").alias("parts")), 48, broadcast_bytes)
    blocks = dealt.join(parts, ["dims", "node"]).withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int")).drop("parts")
    known = nodes.where("node >= 0").collect()  # as many rows as net points
    radii = {d: np.full(len(net), -1.0) for d, net in centers.items()}  # a net point without rows has none
    for r in known:
        radii[r.dims][r.node] = r.radius
    places = [(d, n, c, m) for (d, n), (c, m) in crowds(known, query_block).items()]
    table = dealt.sparkSession.createDataFrame(places, "dims int, node int, begin int, crowds int")
    loose = F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(max(1, -(-total // (every * query_block))))).cast("int")
    crowd = F.when(F.col("begin").isNull(), loose).otherwise(F.col("begin") + F.pmod(F.xxhash64("uid", F.lit(2)), "crowds").cast("int"))
    queries = dealt.where(asked).join(F.broadcast(table), ["dims", "node"], "left")
    queries = written(queries.select("uid", "vec_id", "dims", "v", "distance", F.col("node").alias("qnode"), crowd.alias("crowd")), "queries")
    of_group = ["dims", "qnode", "crowd"]
    groups = queries.groupBy(*of_group).agg(F.max("distance").alias("reach")).withColumn("worst", F.lit(-math.inf))
    groups = written(with_partners(groups, centers, radii, True), "query-groups")
    vec_id = rows.schema["vec_id"].dataType
    result = T.StructType([
        T.StructField("query_uid", T.LongType()), T.StructField("query_id", vec_id), T.StructField("vec_id", vec_id), T.StructField("score", T.LongType()),
    ])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), left.schema.field("vec_id").type, left.schema.field("vec_id").type, pa.int64())], names=result.names)
        right = right.sort_by([("vec_id", "ascending"), ("uid", "ascending")])  # nulls last
        uids, dims = left["uid"].to_numpy(), len(left["v"][0])
        floor = left["floor"].to_numpy()
        found, scores = exact_search(
            matrix(left["v"], len(uids)).reshape(len(uids), dims), uids, matrix(right["v"], right.num_rows).reshape(right.num_rows, dims), right["uid"].to_numpy(), k, floor,
        )
        i, j = np.nonzero(found >= 0)
        take = lambda t, at: t["vec_id"].combine_chunks().take(pa.array(at))
        return pa.table([pa.array(uids[i]), take(left, i), take(right, found[i, j]), pa.array(scores[i, j])], names=result.names)

    def best(groups: DataFrame, queries: DataFrame) -> DataFrame:
        """Scores of the queries with the nodes that their groups ask for; a block goes to the crowds that want it."""
        pairs = groups.select(*of_group, F.explode("nodes").alias("node")).join(parts, ["dims", "node"])
        pairs = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        left = queries.join(pairs, of_group).select(*KEYS, "uid", "vec_id", "v", "floor")
        wanted = pairs.select(*(F.col(c).alias(c) for c in KEYS)).distinct()
        right = blocks.select("dims", "node", "part", "uid", "vec_id", "v").join(wanted, ["dims", "node", "part"])
        return left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(search, result)

    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    seeds = written(ranked(best(groups, queries.withColumn("floor", F.lit(-math.inf)))), "query-seeds")
    last = seeds.where(F.col("rank") == k).select(F.col("query_uid").alias("uid"), F.col("score").cast("double").alias("floor"))
    # long to double may round up; one unit in 2^53 less is no more than the score
    last = last.withColumn("floor", F.col("floor") - F.abs("floor") * 2.0**-52)
    queries = written(queries.join(last, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(-math.inf))), "queries-with-floors")
    worst = queries.groupBy(*of_group).agg(F.min("floor").alias("worst"))
    rest = best(with_partners(groups.drop("worst").join(worst, of_group), centers, radii, False), queries)
    return ranked(seeds.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
