"""Near-duplicate vectors by randomly rotated binary codes with correction factors.

Vectors of one length are normalised and rotated by random orthogonal matrices (seeded, the same in
every task). A vector is coded once, and only codes are shuffled to where vectors meet. A code holds
the signs x_k of each rotation k, the factors f_k = |rotated vector|_1, and the vector itself in four
bits a component of the first rotation, rounded with a fixed random shift. The estimate a'.x_k / f_k
of the cosine of a and b is unbiased over rotations; with r_k = f_k / sqrt(dims), the inner product of
a vector and its code, it is off by more than ``sigmas`` * sqrt((1 - r^2) / (r^2 (dims - 1))) only with
the tail probability of that many standard deviations, and never by more than sqrt(1 - r^2) / r. What
the four bits lose is bounded likewise from the stored length of the rounding error.

The estimate of the first rotation takes bit operations (and, count) over the four bit planes; pairs
whose upper bound reaches the threshold are estimated again over all stored rotations. The vectors of
pairs that still reach it, and no others, are fetched and compared in double precision, and only that
value makes a link.

Which pairs meet at all: the signs are cut into bands; vectors with a band in common meet. The bits
per band follow from the number of vectors (buckets of about ``bucket`` random vectors), the number of
bands from the recall wanted at the threshold, where two vectors agree in a bit with probability
1 - angle / pi. Recall grows quickly above it.

Equal vectors are folded first, with their number as weight. Crowds of near-equal vectors are folded
next: in each bucket of more than a block, members within half the threshold's angle of one of a few
leaders form its ball; any two of a ball are within the whole angle (the angle is a metric), so all
of them are linked and need no comparison. What remains of a bucket, pairs with at least one member
outside its ball, is cut into blocks, and a task compares one pair of blocks. No pair becomes a row:
a first pass returns the members of a block pair that have a surviving pair there, a second one, with
the vectors of these, per vector its number of new links and the least vector it hangs together with
in that block pair. A pair that meets in several bands counts in the first only.

Defined results: vectors that are null, zero or hold a null or non-finite component have no link
and are their own component; vectors of different lengths are not compared; rows with equal ids
are rows of their own; a null id is kept and ranks last. An empty table gives an empty one. Only the id
and vector columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_group, pick, written
from .components import connected_components

#: Vectors per block of a bucket, and leaders tried in a bucket of more than one block.
BLOCK, LEADERS = 4096, 8
#: Bits a component keeps in a code, most rotations with a factor, pairs gathered and rows estimated at a time.
PLANES, FACTORS, GATHER, STRIPE = 4, 8, 1 << 15, 64
SEED = 20240607


@lru_cache(maxsize=8)
def rotations(dims: int, count: int) -> np.ndarray:
    """``count`` random orthogonal matrices side by side: dims x (count * dims)."""
    made = []
    for k in range(count):
        q, r = np.linalg.qr(np.random.default_rng([SEED, dims, k]).standard_normal((dims, dims)))
        made.append(q * np.sign(np.diag(r)))
    return np.hstack(made)


def band_plan(n: int, threshold: float, recall: float, bucket: int) -> tuple[int, int]:
    """(bits per band, bands) for n vectors."""
    bits = min(max(4, math.ceil(math.log2(max(n, 1) / bucket))), 48)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so that nothing overflows."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def rotations_of(dims: int, bits: int, bands: int) -> int:
    """Rotations whose signs fill all bands."""
    return -(-bits * bands // dims)


def band_values(signs: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The keys of the first ``bands`` bands, one column per band."""
    cut = signs[:, : bits * bands].reshape(len(signs), bands, bits)
    return cut.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def words(bits: np.ndarray) -> np.ndarray:
    """The last axis of 0 and 1 as 64-bit words."""
    rest = -bits.shape[-1] % 64
    padded = np.pad(bits.astype(np.uint8), [(0, 0)] * (bits.ndim - 1) + [(0, rest)])
    return np.packbits(padded, axis=-1).view("<u8")


def encoded(units: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes as rows of bytes, signs) of unit vectors under ``count`` rotations.

    A code: low, step and length of the rounding error and the factors (32-bit floats), the bit
    planes of the first rotation (words), the signs of all rotations.
    """
    n, dims = units.shape
    rotated = units @ rotations(dims, count)
    signs = rotated > 0
    kept = min(count, FACTORS)
    factors = np.abs(rotated[:, : kept * dims]).reshape(n, kept, dims).sum(2)
    first, top = rotated[:, :dims], (1 << PLANES) - 1
    low = first.min(1, keepdims=True)
    step = np.maximum((first.max(1, keepdims=True) - low) / top, 1e-12)
    shift = np.random.default_rng([SEED, dims]).random(dims)
    levels = np.clip(np.floor((first - low) / step + shift), 0, top).astype(np.uint8)
    off = np.sqrt(((first - low - step * levels) ** 2).sum(1, keepdims=True))
    planes = words((levels[:, None, :] >> np.arange(PLANES, dtype=np.uint8)[:, None]) & 1)
    head = np.concatenate([low, step, off, factors], 1).astype("<f4")
    parts = [head.view(np.uint8), planes.reshape(n, -1).view(np.uint8), np.packbits(signs, axis=1)]
    return np.concatenate(parts, 1), signs


class Codes:
    """Stored codes read back, with the estimates and bounds they allow."""

    def __init__(self, codes: np.ndarray, dims: int, count: int, sigmas: float):
        n, kept, wide = len(codes), min(count, FACTORS), -(-dims // 64)
        at = 4 * (3 + kept)
        head = np.ascontiguousarray(codes[:, :at]).view("<f4").astype(float)
        self.dims, self.kept = dims, kept
        self.low, self.step, self.off, self.factors = head[:, 0], head[:, 1], head[:, 2], head[:, 3:]
        end = at + PLANES * wide * 8
        self.planes = np.ascontiguousarray(codes[:, at:end]).view("<u8").reshape(n, PLANES, wide)
        self.signs = np.unpackbits(np.ascontiguousarray(codes[:, end:]), axis=1, count=count * dims)
        self.first = words(self.signs[:, :dims])
        self.ones = np.bitwise_count(self.first).sum(1, dtype=np.int64)
        scale = (1 << np.arange(PLANES))[None, :]
        self.levels = (np.bitwise_count(self.planes).sum(2, dtype=np.int64) * scale).sum(1)
        r = np.minimum(self.factors / math.sqrt(dims), 1.0)
        most = np.sqrt(1 - r**2) / r
        share, rounded = sigmas / math.sqrt(max(dims - 1, 1)), min(sigmas / math.sqrt(dims), 1.0)
        self.error_first = most[:, 0] * min(share, 1.0)
        self.error = np.minimum(share * np.sqrt((most**2).sum(1)) / kept, most.mean(1))
        self.round_first, self.round = rounded / r[:, 0], rounded * (1 / r).mean(1)

    def inner(self, a: slice, b: slice) -> np.ndarray:
        """Sums of the levels of a under the set signs of b in the first rotation, by bit operations."""
        shape = len(self.low[a]), len(self.low[b])
        fits = self.dims << PLANES < 1 << 16
        inner = np.zeros(shape, np.uint16 if fits else np.uint32)
        both, count = np.empty(shape, np.uint64), np.empty(shape, np.uint8)  # used again: new ones cost more than the work
        for p in reversed(range(PLANES)):
            inner <<= 1
            for w in range(self.first.shape[1]):
                np.bitwise_and(self.planes[a, p, w][:, None], self.first[b, w], out=both)
                inner += np.bitwise_count(both, out=count)
        return inner

    def estimate(self, a: slice, b: slice) -> np.ndarray:
        """Cosines of the vectors of a with those of b from the first rotation."""
        low, step = self.low[a][:, None], self.step[a][:, None]
        total = self.dims * low + step * self.levels[a][:, None]
        return (2 * (low * self.ones[b] + step * self.inner(a, b)) - total) / self.factors[b, 0]

    def least_inner(self, a: slice, b: slice, threshold: float) -> np.ndarray:
        """The least ``inner`` with which the upper bound of a pair reaches the threshold.

        The bound estimate + error + rounding >= threshold, solved for it: products of four numbers
        of a and four of b.
        """
        low, step, factor = self.low[a], self.step[a], self.factors[b, 0]
        total = self.dims * low + step * self.levels[a]
        left = np.stack([2 * low, -total, np.ones(len(low)), self.off[a]], 1) / (-2 * step[:, None])
        right = np.stack([self.ones[b], np.ones(len(factor)), (self.error_first[b] - threshold) * factor, self.round_first[b] * factor])
        return left.astype(np.float32) @ right.astype(np.float32)

    @cached_property
    def rounded(self) -> np.ndarray:
        """The vectors as their bit planes keep them, under each rotation with a factor: n x kept x dims."""
        bits = np.unpackbits(self.planes.view(np.uint8), axis=2, count=self.dims)
        levels = (bits << np.arange(PLANES, dtype=np.uint8)[:, None]).sum(1)
        turned = rotations(self.dims, 1).T @ rotations(self.dims, self.kept)
        out = (self.low[:, None] + self.step[:, None] * levels) @ turned
        return out.reshape(len(out), self.kept, self.dims)

    def refined(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Estimates of pairs as means over all rotations with a factor."""
        x = self.signs[j, : self.kept * self.dims].reshape(len(j), self.kept, self.dims)
        inner = 2 * np.einsum("nkd,nkd->nk", self.rounded[i], x.astype(float)) - self.rounded[i].sum(2)
        return (inner / self.factors[j]).mean(1)

    def candidates(self, a: slice, b: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (places) of the two slices whose upper bounds reach the threshold."""
        reached = self.inner(a, b) >= self.least_inner(a, b, threshold - 1e-5)
        i, j = np.divmod(np.flatnonzero(reached), reached.shape[1])
        i, j = i + (a.start or 0), j + (b.start or 0)
        if self.kept == 1:
            return i, j
        near = [np.zeros(0, bool)]
        for at in range(0, len(i), GATHER):
            x, y = i[at : at + GATHER], j[at : at + GATHER]
            near.append(self.refined(x, y) + self.error[y] + self.off[x] * self.round[y] >= threshold - 1e-5)
        kept = np.concatenate(near)
        return i[kept], j[kept]


def surviving_pairs(group: pd.DataFrame, bits: int, bands: int, threshold: float, sigmas: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (places) of a block pair to compare exactly: they share no ball (-1: none) and no earlier band.

    ``group`` is sorted by ``own``: 0 for rows of the first block, 1 for those of the second.
    """
    dims, band = int(group["dims"].iloc[0]), int(group["band"].iloc[0])
    raw = np.frombuffer(b"".join(group["code"]), np.uint8).reshape(len(group), -1)
    codes = Codes(raw, dims, rotations_of(dims, bits, bands), sigmas)
    keys, ball = band_values(codes.signs, bits, band), group["ball"].to_numpy()
    crossed = group["i"].iloc[0] != group["j"].iloc[0]
    split = int(np.searchsorted(group["own"].to_numpy(), 1)) if crossed else len(group)
    for begin in range(0, split, STRIPE):
        a = slice(begin, min(begin + STRIPE, split))
        i, j = codes.candidates(a, slice(split if crossed else begin, len(group)), threshold)
        keep = (ball[i] != ball[j]) | (ball[i] < 0)
        if not crossed:
            keep &= i < j
        i, j = i[keep], j[keep]
        for earlier in range(band):
            new = keys[i, earlier] != keys[j, earlier]
            i, j = i[new], j[new]
        if len(i):
            yield i, j


def exact_pairs(units: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least the threshold, in double precision."""
    near = [np.zeros(0, bool)]
    for at in range(0, len(i), GATHER):
        part = slice(at, at + GATHER)
        near.append(np.einsum("ij,ij->i", units[i[part]], units[j[part]]) >= threshold)
    return np.concatenate(near)


def least_reachable(n: int, left: np.ndarray, right: np.ndarray, uids: np.ndarray) -> np.ndarray:
    """The least uid each place hangs together with through the given pairs."""
    least = uids.copy()
    while len(left):
        before = least.copy()
        np.minimum.at(least, left, least[right])
        np.minimum.at(least, right, least[left])
        if (before == least).all():
            break
    return least


KEYS = ["dims", "band", "key", "i", "j"]
LINKS = "uid long, links long, least long"


def surviving_members(rows: DataFrame, bits: int, bands: int, threshold: float, sigmas: float) -> DataFrame:
    """The rows of each block pair, without codes, that have a surviving pair there."""
    columns = [*KEYS, "own", "ball", "uid"]

    def of(group: pd.DataFrame) -> pd.DataFrame | None:
        if len(group) < 2:
            return None
        group = group.sort_values("own", kind="stable")
        hit = np.zeros(len(group), bool)
        for i, j in surviving_pairs(group, bits, bands, threshold, sigmas):
            hit[i] = hit[j] = True
        return group.loc[hit, columns] if hit.any() else None

    kinds = "dims int, band int, key long, i int, j int, own int, ball long, uid long"
    return per_group(rows, KEYS, of, kinds)


def compare_blocks(rows: DataFrame, bits: int, bands: int, threshold: float, sigmas: float) -> DataFrame:
    """Per vector and block pair with links: uid, links (weighted), least."""

    def of(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.sort_values("own", kind="stable")
        units = unit_vectors(np.frombuffer(b"".join(group["vector"]), "<f8").reshape(len(group), -1))
        weight, uids = group["weight"].to_numpy(), group["uid"].to_numpy()
        links, left, right = np.zeros(len(group)), [], []
        for i, j in surviving_pairs(group, bits, bands, threshold, sigmas):
            near = exact_pairs(units, i, j, threshold)
            i, j = i[near], j[near]
            links += np.bincount(i, weight[j], len(group)) + np.bincount(j, weight[i], len(group))
            left.append(i)
            right.append(j)
        hit = links > 0
        if not hit.any():
            return None
        least = least_reachable(len(group), np.concatenate(left), np.concatenate(right), uids)
        return pd.DataFrame({"uid": uids[hit], "links": links[hit].astype(np.int64), "least": least[hit]})

    return per_group(rows, KEYS, of, LINKS)


def ball_members(pairs: DataFrame, folded: DataFrame, threshold: float) -> DataFrame:
    """(uid, ball): vectors within half the threshold's angle of a leader; of several, the most common one."""
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    side = folded.select("uid", "vector", "dims")
    joined = pairs.join(side, "uid").join(side.select(F.col("uid").alias("leader"), F.col("vector").alias("center")), "leader")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            dims = np.array(batch["dims"].to_pylist(), int)
            ends = [batch[c].to_pylist() for c in ("vector", "center")]
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                a, b = (unit_vectors(np.frombuffer(b"".join(e[k] for k in at), "<f8").reshape(len(at), d)) for e in ends)
                keep[at] = np.einsum("ij,ij->i", a, b) >= half
            yield batch.select(["uid", "leader"]).filter(pa.array(keep))

    inside = written(joined.select("uid", "leader", "dims", "vector", "center").mapInArrow(near, "uid long, leader long"), "near-leaders")
    sizes = inside.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    chosen = F.max_by("leader", F.struct("n", -F.col("leader"))).alias("ball")
    return inside.join(sizes, "leader").groupBy("uid").agg(chosen)


def coded(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """uid, dims, the array of band keys and the code, one row per different vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims = batch["vector"].to_pylist(), np.array(batch["dims"].to_pylist(), int)
            keys: list[list[int]] = [[]] * len(vectors)
            codes: list[bytes] = [b""] * len(vectors)
            for d in np.unique(dims):
                places = np.flatnonzero(dims == d)
                values = np.frombuffer(b"".join(vectors[k] for k in places), "<f8").reshape(len(places), d)
                rows, signs = encoded(unit_vectors(values), rotations_of(int(d), bits, bands))
                for k, row, code in zip(places, band_values(signs, bits, bands).tolist(), rows, strict=True):
                    keys[k], codes[k] = row, code.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch["uid"], batch["dims"], pa.array(keys, pa.list_(pa.int64())), pa.array(codes, pa.binary())],
                ["uid", "dims", "keys", "code"],
            )

    return classes.select("uid", "dims", "vector").mapInArrow(run, "uid long, dims int, keys array<long>, code binary")


def as_doubles(rows: DataFrame) -> DataFrame:
    """``vector`` (array) as little-endian doubles; null for vectors that take no part."""
    kept = [c for c in rows.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch["vector"]:
                v = v.as_py()
                a = None if v is None or None in v else np.array(v, "<f8")
                out.append(a.tobytes() if a is not None and len(a) and np.isfinite(a).all() and a.any() else None)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(out, pa.binary())], [*kept, "vector"])

    schema = rows.select(*kept).schema.add("vector", "binary")
    return rows.select(*kept, "vector").mapInArrow(run, schema)


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999, sigmas: float = 4.0, bucket: int = 1024,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = pick(vectors, vec_id=id_column, vector=vector_column).select("vec_id", F.monotonically_increasing_id().alias("row"), "vector")
    rows = written(as_doubles(rows), "vectors")
    folded = rows.where("vector is not null").groupBy("vector").agg(F.min("row").alias("uid"), F.count(F.lit(1)).alias("weight"))
    folded = written(folded.withColumn("dims", (F.octet_length("vector") / 8).cast("int")), "different-vectors")
    bits, bands = band_plan(folded.count(), threshold, recall, bucket)
    keyed = written(coded(folded, bits, bands), "coded-vectors")

    member = keyed.select("uid", "dims", F.posexplode("keys").alias("band", "key"))
    bucket = ["dims", "band", "key"]
    drawn = [F.min_by("uid", F.xxhash64("uid", F.lit(k))) for k in range(LEADERS)]
    sizes = member.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.array_distinct(F.array(*drawn)).alias("leaders"))
    sizes = written(sizes.where("n > 1"), "vector-buckets")
    crowded = sizes.where(F.col("n") > BLOCK)
    pairs = member.join(crowded, bucket).select("uid", F.explode("leaders").alias("leader")).distinct()
    balls = written(ball_members(pairs, folded, threshold), "balls")

    placed = member.join(balls.select("uid", "ball"), "uid", "left").withColumn("ball", F.coalesce("ball", F.lit(-1).cast("long")))
    main = placed.where("ball >= 0").groupBy(*bucket, "ball").agg(F.count(F.lit(1)).alias("inside")).join(crowded.select(*bucket), bucket)
    main = main.groupBy(*bucket).agg(F.max_by(F.struct("ball", "inside"), F.struct("inside", "ball")).alias("main"))
    sizes = sizes.select(*bucket, "n").join(main, bucket, "left")
    inner = F.ceil(F.coalesce("main.inside", F.lit(0)) / BLOCK).cast("int")
    outer = F.ceil((F.col("n") - F.coalesce("main.inside", F.lit(0))) / BLOCK).cast("int")
    placed = placed.join(sizes.select(*bucket, F.col("main.ball").alias("of"), inner.alias("inner"), outer.alias("outer")), bucket)
    # blocks 0 .. inner - 1 hold the ball, which is not compared with itself; the others all else
    in_ball = F.coalesce(F.col("ball") == F.col("of"), F.lit(False))
    mine = F.when(in_ball, F.pmod(F.xxhash64("uid"), "inner")).otherwise(F.col("inner") + F.pmod(F.xxhash64("uid"), "outer")).cast("int")
    last = F.col("inner") + F.col("outer") - 1
    others = F.when(~in_ball, F.sequence(F.lit(0), last)).when(F.col("outer") > 0, F.sequence("inner", last))
    placed = placed.select("uid", *bucket, "ball", mine.alias("mine"), F.explode(others).alias("other")).select(
        "uid", *bucket, "ball", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("own"),
    ).join(keyed.select("uid", "code"), "uid")
    near = written(surviving_members(placed, bits, bands, threshold, sigmas), "surviving-members")
    near = near.join(keyed.select("uid", "code"), "uid").join(folded.select("uid", "weight", "vector"), "uid")
    found = written(compare_blocks(near, bits, bands, threshold, sigmas), "vector-links")
    whole = balls.join(folded.select("uid", "weight"), "uid").groupBy("ball").agg(F.sum("weight").alias("all"), F.min("uid").alias("least"))
    whole = balls.join(folded.select("uid", "weight"), "uid").join(whole, "ball").select("uid", (F.col("all") - F.col("weight")).alias("links"), "least")
    found = found.union(whole)

    linked = connected_components(found.where("uid <> least").select(F.col("uid").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("uid").agg(F.sum("links").alias("links"))
    of_class = folded.join(counts, "uid", "left").join(linked.withColumnRenamed("node", "uid"), "uid", "left").select(
        "vector", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "uid").alias("component")
    )
    each = written(rows.join(of_class, "vector", "left").select(
        "row", "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("component", "row").alias("component"),
    ), "vector-components")
    heads = each.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return each.join(heads, "component").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
