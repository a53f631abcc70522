"""Hard negatives by inner product, exact, over cover trees of norm-augmented candidates.

With one more coordinate, sqrt(M^2 - |x|^2), all candidates x lie on a sphere of radius M, and with
0 there a query q has |q - x|^2 = |q|^2 + M^2 - 2 q.x: inner products are distances. A node of
centre c and covering radius r, at distance d from q, therefore holds only candidates with

    (|q|^2 + M^2 - (d + r)^2) / 2  <=  q.x  <=  (|q|^2 + M^2 - max(0, d - r)^2) / 2

and within r |q| of q.c. Two searches use this. An anchor's positives are the best candidates of its
label. Each positive opens a window of scores, a share of its own, in which the best candidates of
other labels are the negatives. A node is skipped for an anchor if it lies outside all its windows,
if its best can't beat what a window has already, or if its labels don't fit. What remains is taken
best bound first, and its members are scored exactly.

On the cluster: a net of farthest points of a bounded sample is the top of the tree. Rows go to their
nearest net point; a node of many rows is cut into blocks by a hash, so a hot node is many tasks.
Counts, covering radii and label ranges of the nodes are aggregated from all rows; anchors are held
against them before any vector moves, and only the pairs of an anchor and a node that remain are
shuffled. First every anchor searches the node of its best bound, which gives it scores to beat;
then the others that still matter. A task holds one block, grows the lower levels of the tree over
it, level by level with covering radii measured, and at most ``anchor_rows`` anchors, those of one
neighbourhood together; a block is copied only to the groups of anchors that want it.

Components are whole numbers floor(scale * x), products are summed in doubles while every partial sum
is below 2^53, else in unbounded integers and cut to 64 bits (then nothing is skipped).

Defined results: rows with a null label or vector, or a null or non-finite component take no part;
vectors of different lengths are not compared. Rows with equal ids are rows of their own: only the
anchor's own row is left out. Ties go to the smaller id. A null id is never an anchor and comes last
among ties. Fewer candidates give fewer rows, an empty table gives none. Other columns of
the table are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, small, whole_components, written

#: Members of a node that is not split, and children of one that is.
LEAF, FAN = 64, 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


# --- bounds and trees -----------------------------------------------------------------------------


def squared(points: np.ndarray) -> np.ndarray:
    return (points * points).sum(1)


def augmented(points: np.ndarray, m2: float) -> np.ndarray:
    """The points on the sphere of squared radius ``m2``."""
    return np.column_stack([points, np.sqrt(np.maximum(m2 - squared(points), 0.0))])


def bounds(queries: np.ndarray, centers: np.ndarray, radii: np.ndarray, m2: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with the members of each node."""
    inner, q2 = queries @ centers.T, squared(queries)[:, None]
    distance = np.sqrt(np.maximum(q2 + m2 - 2 * inner, 0.0))
    reach = np.sqrt(q2) * radii
    slack = 1e-9 * (q2 + m2)
    low = np.maximum((q2 + m2 - (distance + radii) ** 2) / 2, inner - reach) - slack
    high = np.minimum((q2 + m2 - np.maximum(distance - radii, 0.0) ** 2) / 2, inner + reach) + slack
    return low, high


def farthest_net(points: np.ndarray, first: int, count: int, radius: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Net points chosen farthest first, until ``count`` or until they cover within ``radius``; owner and distance of all."""
    net = [first]
    distance = np.sqrt(squared(points - points[first]))
    owner = np.zeros(len(points), int)
    while len(net) < count and distance.max() > radius:
        net.append(int(distance.argmax()))
        other = np.sqrt(squared(points - points[net[-1]]))
        owner[other < distance] = len(net) - 1
        distance = np.minimum(distance, other)
    return net, owner, distance


@dataclass
class Level:
    """Nodes at one height: places of the centres, covering radii, label ranges, parents in the level above."""

    center: np.ndarray
    radius: np.ndarray
    least: np.ndarray
    most: np.ndarray
    parent: np.ndarray
    leaf: list[np.ndarray | None]


def cover_levels(points: np.ndarray, labels: np.ndarray, m2: float) -> list[Level]:
    """The cover tree of the points, as levels from the root down."""
    whole = augmented(points, m2)
    rim = 1e-7 * math.sqrt(m2)
    start = np.sqrt(squared(whole - whole[0]))
    todo = [(0, np.arange(len(points)), start, 0)]
    levels = []
    while todo:
        level = Level(
            np.array([c for c, *_ in todo]), np.array([d.max() + rim for _, _, d, _ in todo]),
            np.array([labels[m].min() for _, m, *_ in todo]), np.array([labels[m].max() for _, m, *_ in todo]),
            np.array([p for *_, p in todo]), [],
        )
        below = []
        for place, (center, members, distance, _) in enumerate(todo):
            if len(members) <= LEAF or not distance.max() > 0:
                level.leaf.append(members)
                continue
            level.leaf.append(None)
            net, owner, distance = farthest_net(whole[members], int(np.flatnonzero(members == center)[0]), FAN, distance.max() / 2)
            for k, at in enumerate(net):
                mine = owner == k
                below.append((int(members[at]), members[mine], distance[mine], place))
        levels.append(level)
        todo = below
    return levels


@dataclass
class Wanted:
    """Anchors with the windows of scores they look for: [low, high] per window, low > high for none."""

    uids: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same_label: bool

    def useful(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which nodes may hold something for which anchor, by bounds (anchors x nodes) and label ranges."""
        label = self.labels[:, None]
        fits = (least <= label) & (label <= most) if self.same_label else ~((least == label) & (most == label))
        inside = np.zeros_like(fits)
        for w in range(self.low.shape[1]):
            begin, end = self.low[:, w, None], self.high[:, w, None]
            inside |= (begin <= end) & (high >= begin) & (low <= end)
        return fits & inside


def exact_scores(queries: np.ndarray, points: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return (queries.astype(float) @ points.astype(float).T).astype(np.int64)
    found = queries.astype(object) @ points.astype(object).T
    return np.array([[min(max(int(x), LOWEST), HIGHEST) for x in row] for row in found], np.int64).reshape(len(queries), len(points))


class Search:
    """The best ``k`` members of one block per anchor and window; rows come in the order that breaks ties."""

    def __init__(self, wanted: Wanted, points: np.ndarray, labels: np.ndarray, uids: np.ndarray, m2: float, k: int):
        self.of, self.points, self.labels, self.uids, self.m2, self.k = wanted, points, labels, uids, m2, k
        self.low = wanted.low.copy()
        self.best = [np.empty(0, np.int64) for _ in range(3)]  # anchor * windows + window, score, row
        self.compared = 0
        most = max((abs(int(x)) for a in (points, wanted.vectors) if a.size for x in (a.min(), a.max())), default=0)
        self.safe = most * most * max(points.shape[1], 1) < 1 << 53

    def run(self) -> Search:
        if not self.safe:
            for begin in range(0, len(self.points), 1024):
                self.score(np.arange(len(self.of.uids)), np.arange(begin, min(begin + 1024, len(self.points))))
            self.merge()
            return self
        leaves, high, low = self.descend()
        order = np.argsort(-high, axis=1, kind="stable")
        done, step = 0, 1
        while done < len(leaves):
            turn = order[:, done : done + step]
            rows = np.arange(len(turn))[:, None]
            left = high[rows, turn] > -np.inf
            open_ = self.still(low[rows, turn], high[rows, turn]) & left
            if not left.any():
                break
            anchor, place = np.nonzero(open_)
            leaf = turn[anchor, place]
            by = np.argsort(leaf, kind="stable")
            ends = np.flatnonzero(np.diff(leaf[by])) + 1
            for group in np.split(by, ends):
                if len(group):
                    self.score(anchor[group], leaves[leaf[group[0]]])
            self.merge()
            done, step = done + step, step * 2
        return self

    def still(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        inside = np.zeros(low.shape, bool)
        for w in range(self.low.shape[1]):
            begin, end = self.low[:, w, None], self.of.high[:, w, None]
            inside |= (begin <= end) & (high >= begin) & (low <= end)
        return inside

    def descend(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Leaves with their bounds per anchor (anchors x leaves); -inf where an ancestor is skipped."""
        queries = self.of.vectors.astype(float)
        leaves, lows, highs, above = [], [], [], np.ones((len(queries), 1), bool)
        points = self.points.astype(float)
        for level in cover_levels(points, self.labels, self.m2):
            low, high = bounds(queries, points[level.center], level.radius, self.m2)
            above = above[:, level.parent] & self.of.useful(low, high, level.least, level.most)
            at = [k for k, members in enumerate(level.leaf) if members is not None]
            leaves += [level.leaf[k] for k in at]
            lows.append(low[:, at])
            highs.append(np.where(above[:, at], high[:, at], -np.inf))
        return leaves, np.hstack(highs), np.hstack(lows)

    def score(self, anchors: np.ndarray, members: np.ndarray) -> None:
        of = self.of
        found = exact_scores(of.vectors[anchors], self.points[members], self.safe)
        self.compared += found.size
        allowed = (self.labels[members][None, :] == of.labels[anchors][:, None]) == of.same_label
        allowed &= self.uids[members][None, :] != of.uids[anchors][:, None]
        for w in range(self.low.shape[1]):
            r, c = np.nonzero(allowed & (found >= self.low[anchors, w, None]) & (found <= of.high[anchors, w, None]))
            if len(r):
                new = anchors[r] * self.low.shape[1] + w, found[r, c], members[c]
                self.best = [np.concatenate([old, x]) for old, x in zip(self.best, new, strict=True)]

    def merge(self) -> None:
        """Keep the best k per anchor and window; a full window asks for no less than its last score."""
        slot, score, row = self.best
        order = np.lexsort((row, -score, slot))
        slot, score, row = slot[order], score[order], row[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = rank == self.k - 1
        flat = self.low.reshape(-1)
        flat[slot[last]] = np.maximum(flat[slot[last]], score[last])
        keep = rank < self.k
        self.best = [slot[keep], score[keep], row[keep]]


# --- the tables -----------------------------------------------------------------------------------


@dataclass
class Top:
    """The top of the tree: per vector length the net points; M squared; what is known of each node."""

    centers: dict[int, np.ndarray]
    m2: float
    radius: dict[int, np.ndarray]
    least: dict[int, np.ndarray]
    most: dict[int, np.ndarray]


KEYS = ["dims", "node", "part", "crowd"]


def matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    """A list column of equally long lists."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1)


def net_of(rows: DataFrame, total: int, block_rows: int, sample_rows: int, most_nodes: int) -> dict[int, np.ndarray]:
    """Net points per vector length, from at most ``sample_rows`` rows drawn by a hash; about one per ``block_rows`` rows."""
    drawn = rows.select("dims", "v", F.xxhash64("uid").alias("draw")).orderBy("draw").limit(sample_rows).select("dims", "v").collect()
    found: dict[int, list] = {}
    for r in drawn:
        found.setdefault(r.dims, []).append(r.v)
    out = {}
    for dims, vectors in found.items():
        points = np.array(vectors, float).reshape(len(vectors), dims)
        share = total * len(vectors) / len(drawn) / block_rows
        m2 = float(squared(points).max())
        out[dims] = points[farthest_net(augmented(points, m2), 0, max(1, min(math.ceil(share), most_nodes)))[0]]
    return out


def dealt_to_nodes(rows: DataFrame, centers: dict[int, np.ndarray], m2: float) -> DataFrame:
    """``rows`` with node (the nearest net point; -1 for lengths without any) and distance."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dims"].to_numpy()
            node, distance = np.full(len(dims), -1), np.full(len(dims), 0.0)
            for d in np.unique(dims):
                if int(d) not in centers:
                    continue
                at = np.flatnonzero(dims == d)
                points = augmented(matrix(batch["v"].take(pa.array(at)), len(at)).astype(float).reshape(len(at), d), m2)
                net = augmented(centers[int(d)], m2)
                for begin in range(0, len(at), 1024):
                    some = points[begin : begin + 1024]
                    near = (some @ net.T - squared(net) / 2).argmax(1)
                    node[at[begin : begin + 1024]] = near
                    distance[at[begin : begin + 1024]] = np.sqrt(squared(some - net[near]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, pa.int32()), pa.array(distance)], [*names, "node", "distance"])

    schema = T.StructType([*rows.schema.fields, T.StructField("node", T.IntegerType()), T.StructField("distance", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def top_of(known: list, centers: dict[int, np.ndarray], m2: float) -> Top:
    rim = 1e-7 * math.sqrt(m2)
    top = Top(centers, m2, {}, {}, {})
    for d, net in centers.items():
        # a net point without rows has no fitting label
        top.radius[d], top.least[d], top.most[d] = np.zeros(len(net)), np.full(len(net), HIGHEST), np.full(len(net), LOWEST)
    for r in known:
        if r.node >= 0:
            top.radius[r.dims][r.node], top.least[r.dims][r.node], top.most[r.dims][r.node] = r.radius + rim, r.least, r.most
    return top


def with_nodes(asked: DataFrame, top: Top, same_label: bool, first: bool) -> DataFrame:
    """``asked`` with the nodes to search: that of the best bound as ``home``, or all others that still matter.

    A window's low end has risen to the score to beat by then.
    """
    names = asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, windows = batch["dims"].to_numpy(), len(batch["low"][0]) if batch.num_rows else 0
            nodes: list[list[int]] = [[-1] if first else [] for _ in range(len(dims))]
            home = np.full(len(dims), -1) if first else batch["home"].to_numpy()
            for d in map(int, np.unique(dims)):
                if d not in top.centers:
                    continue
                at = np.flatnonzero(dims == d)
                some = batch.take(pa.array(at))
                low, high = (matrix(some[c], len(at)) for c in ("low", "high"))
                of = Wanted(some["a_uid"].to_numpy(), matrix(some["v"], len(at)).reshape(len(at), d), some["label"].to_numpy(), low.reshape(-1, windows), high.reshape(-1, windows), same_label)
                most = max((abs(int(x)) for a in (of.vectors, top.centers[d]) if a.size for x in (a.min(), a.max())), default=0)
                if most * most * max(d, 1) < 1 << 53:
                    least, greatest = bounds(of.vectors.astype(float), top.centers[d], top.radius[d], top.m2)
                else:
                    least, greatest = (np.full((len(at), len(top.centers[d])), x) for x in (-np.inf, np.inf))
                useful = of.useful(least, greatest, top.least[d], top.most[d])
                if first:
                    best = np.where(useful, greatest, -np.inf).argmax(1)
                    home[at] = np.where(useful.any(1), best, -1)
                    for k, place in enumerate(at):
                        nodes[place] = [int(best[k])] if useful[k].any() else []
                else:
                    useful[np.arange(len(at)), home[at]] &= home[at] < 0
                    for k, place in enumerate(at):
                        nodes[place] = np.flatnonzero(useful[k]).tolist()
            columns = [c for c, n in zip(batch.columns, names, strict=True) if n != "home"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(home, pa.int32()), pa.array(nodes, pa.list_(pa.int32()))], [*(n for n in names if n != "home"), "home", "nodes"]
            )

    fields = [f for f in asked.schema.fields if f.name != "home"]
    return asked.mapInArrow(run, T.StructType([*fields, T.StructField("home", T.IntegerType()), T.StructField("nodes", T.ArrayType(T.IntegerType()))]))


def searched(asked: DataFrame, blocks: DataFrame, parts: DataFrame, m2: float, same_label: bool, k: int) -> DataFrame:
    """(a_uid, w, uid, vec_id, score): the best k per anchor, window and block among the nodes asked for."""
    wide = asked.select("a_uid", "dims", "crowd", "label", "v", "low", "high", F.explode("nodes").alias("node")).join(parts, ["dims", "node"])
    wide = wide.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    pairs = wide.select(*(F.col(c).alias(c) for c in KEYS)).distinct()  # new names: one side of a join with itself
    data = blocks.select("dims", "node", "part", "uid", "vec_id", "label", "v").join(pairs, ["dims", "node", "part"])
    out = T.StructType([
        T.StructField("a_uid", T.LongType()), T.StructField("w", T.IntegerType()), T.StructField("uid", T.LongType()),
        blocks.schema["vec_id"], T.StructField("score", T.LongType()),
    ])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), right.schema.field("vec_id").type, pa.int64())], names=out.names)
        if not left.num_rows or not right.num_rows:
            return empty
        right = right.sort_by([("vec_id", "ascending"), ("uid", "ascending")])  # nulls last
        n, d = left.num_rows, len(left["v"][0])
        low, high = (matrix(left[c], n) for c in ("low", "high"))
        of = Wanted(left["a_uid"].to_numpy(), matrix(left["v"], n).reshape(n, d), left["label"].to_numpy(), low, high, same_label)
        uids = right["uid"].to_numpy()
        found = Search(of, matrix(right["v"], len(uids)).reshape(len(uids), d), right["label"].to_numpy(), uids, m2, k).run()
        slot, score, row = found.best
        anchor, w = np.divmod(slot, low.shape[1])
        return pa.table([
            pa.array(of.uids[anchor]), pa.array(w, pa.int32()), pa.array(uids[row]),
            right["vec_id"].combine_chunks().take(pa.array(row)), pa.array(score, pa.int64()),
        ], names=out.names)

    return wide.groupBy(*KEYS).cogroup(data.groupBy(*KEYS)).applyInArrow(search, out)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a_uid", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def two_rounds(asked: DataFrame, blocks: DataFrame, parts: DataFrame, top: Top, same_label: bool, k: int, name: str) -> DataFrame:
    """Best k per anchor and window: first from the node of the best bound, then from all that can beat these."""
    asked = written(with_nodes(asked, top, same_label, True), f"{name}-asked")
    seeds = written(best_of(searched(asked, blocks, parts, top.m2, same_label, k), k), f"{name}-seeds")
    last = seeds.where(F.col("rank") == k).groupBy("a_uid").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("last"))
    raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("last", w), x)))
    again = asked.drop("nodes").join(last, "a_uid", "left").withColumn("low", raised).drop("last")
    rest = searched(with_nodes(again, top, same_label, False), blocks, parts, top.m2, same_label, k)
    return best_of(seeds.drop("rank").unionByName(rest), k)


def crowds(counts: list, anchor_rows: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(dims, node) -> first crowd and number of crowds of its anchors; small neighbours share one."""
    out, crowd, room = {}, -1, {}
    for r in sorted(counts, key=lambda r: (r.dims, r.node)):
        if r.anchors > room.get(r.dims, 0):
            crowd += 1
            n = -(-r.anchors // anchor_rows)
            out[r.dims, r.node] = (crowd, n)
            room[r.dims] = anchor_rows - r.anchors if n == 1 else 0
            crowd += n - 1
        elif r.anchors:
            out[r.dims, r.node] = (crowd, 1)
            room[r.dims] -= r.anchors
    return out


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
    scale: int = 256, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
    block_rows: int = 8192, anchor_rows: int = 4096, sample_rows: int = 4096, most_nodes: int = 1024, broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; a negative's score lies between
    ``least_percent`` and ``most_percent`` of the positive's.
    """
    rows = pick(vectors, vec_id=id_column, label=label_column, vector=vector_column)
    rows = rows.select("vec_id", F.col("label").cast("long").alias("label"), whole_components(F.col("vector"), scale).alias("v"))
    rows = rows.where("v is not null and label is not null").select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.size("v").alias("dims"), "v")
    rows = written(rows, "labelled-vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, m2 = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(length), F.lit(0.0))).first()
    centers = net_of(rows, total, block_rows, sample_rows, most_nodes)
    dealt = written(dealt_to_nodes(rows, centers, m2), "vectors-in-nodes")
    is_anchor = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    nodes = written(dealt.groupBy("dims", "node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_anchor.cast("long")).alias("anchors"), F.max("distance").alias("radius"),
        F.min("label").alias("least"), F.max("label").alias("most"),
    ), "vector-nodes")
    parts = small(nodes.select("dims", "node", F.ceil(F.col("n") / block_rows).cast("int").alias("parts")), 48, broadcast_bytes)
    blocks = dealt.join(parts, ["dims", "node"]).withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int")).drop("parts")
    # as many rows as net points; nodes of other lengths are searched by everyone of their length
    known = nodes.where("node >= 0").collect()
    top = top_of(known, centers, m2)
    places = crowds(known, anchor_rows)
    table = dealt.sparkSession.createDataFrame([(d, n, c, k) for (d, n), (c, k) in places.items()], "dims int, node int, begin int, crowds int")
    anchors = dealt.where(is_anchor).join(F.broadcast(table), ["dims", "node"], "left")
    anchors = anchors.select(
        F.col("uid").alias("a_uid"), F.col("vec_id").alias("anchor_id"), "dims", "label", "v",
        F.when(F.col("begin").isNull(), F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(max(1, -(-total // (every * anchor_rows))))).cast("int"))
        .otherwise(F.col("begin") + F.pmod(F.xxhash64("uid", F.lit(2)), "crowds").cast("int")).alias("crowd"),
    )
    anchors = written(anchors, "anchors")
    bound = lambda x: F.array(F.lit(x).cast("long"))
    asked = anchors.drop("anchor_id").withColumns({"low": bound(LOWEST), "high": bound(HIGHEST)})
    near = two_rounds(asked, blocks, parts, top, True, positives, "positives")
    near = written(near.select("a_uid", (F.col("rank") - 1).cast("int").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    share = lambda p: F.col("positive_score").cast("decimal(20,0)") * F.lit(p) / F.lit(100)
    ends = near.select("a_uid", "w", F.ceil(share(least_percent)).cast("long").alias("low"), F.floor(share(most_percent)).cast("long").alias("high"))
    ends = ends.groupBy("a_uid").agg(*[F.map_from_entries(F.collect_list(F.struct("w", c))).alias(c) for c in ("low", "high")])
    every_window = F.sequence(F.lit(0), F.lit(positives - 1))
    # a window that does not exist has its low end above its high end
    fill = lambda c, none: F.transform(every_window, lambda w: F.coalesce(F.try_element_at(c, w), F.lit(none).cast("long")))
    asked = anchors.drop("anchor_id").join(ends, "a_uid").withColumns({"low": fill("low", HIGHEST), "high": fill("high", LOWEST)})
    far = two_rounds(asked, blocks, parts, top, False, negatives, "negatives")
    return far.select("a_uid", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(near, ["a_uid", "w"]).join(
        anchors.select("a_uid", "anchor_id"), "a_uid"
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
