"""Merkle manifest of a table, with SHA-256 midstates kept in its nodes.

Every row is a leaf, the digest of its fields. Leaves of one group (``source``) in ascending order
of their id make a tree in which 16 consecutive nodes hash to their parent, up to the group's
subroot; subroots in order of their group make the tree above, up to the root. A child's digest in
hexadecimal text is exactly one block of SHA-256, so the hash state before each child slot is a
state of 32 bytes between two blocks. Parents retain a copy of it per slot, as a column of the node
tables. To fold a changed leaf, each ancestor resumes the state kept for the slot with the
replaced digest and the siblings to its right; what lies left of it is never hashed again.

On the cluster: leaves are sorted by range on (group, id), so a hot group is spread like any other
data; positions come from row counts per (range, group), at most one row per range for one group.
Each level is a grouping by (group, position / 16), 16 rows a key. Paths go down the same way: a
node's path is its own step and its parent's path, joined on keys of at most 16 children, so no
join has a hot key however high the tree. All levels above the first together have one node per
240 rows. The driver sees the number of levels and the root, nothing else.

Defined results: a null field is `-`; empty texts are fields of length 0; texts of any length are
hashed whole. Null groups come first, as do null ids, which are never tampered with. Rows with
equal ids are leaves of their own, ordered by digest; equal rows have equal leaves. A lone leaf is
its own subroot, a lone subroot the root; both have no siblings there. An empty table gives none.
Columns other than the fields are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, small, written

#: Children of a node, bytes of a digest, and the fields of a leaf in their order.
FANOUT, DIGEST = 16, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- SHA-256 on many messages at once -------------------------------------------------------------


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


# The standard's constants: 32 bits of the fraction of cube and square roots of the first primes.
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
HEX = np.frombuffer(bytes(range(256)).hex().encode(), np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n x 8) after one more block (n x 64 bytes) each."""
    w = list(np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T.copy())
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        small_x = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        small_y = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + small_x + w[t - 7] + small_y)
    a, b, c, d, e, f, g, h = (states[:, k].copy() for k in range(8))
    for t in range(64):
        choice = (e & f) ^ (~e & g)
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + choice + ROUND[t] + w[t]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def as_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) as hexadecimal text, one block each (n x 64)."""
    return HEX[digests].reshape(len(digests), 2 * DIGEST)


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n x 32) of messages of so many whole blocks with these states."""
    last = np.zeros((len(states), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (blocks.astype(np.uint64) * 512).astype(">u8").view(np.uint8).reshape(-1, 8)
    return to_bytes(absorb(states, last))


def to_bytes(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states.astype(">u4")).view(np.uint8).reshape(len(states), DIGEST)


def to_states(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw).view(">u4").astype(np.uint32).reshape(-1, 8)


def retained_states(children: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parents of ``sizes`` children (n x 16 x 32): states before each slot (n x 16 x 32), digests."""
    state = np.tile(START, (len(sizes), 1))
    kept = np.zeros((len(sizes), FANOUT, DIGEST), np.uint8)
    for slot in range(int(sizes.max(initial=0))):
        has = sizes > slot
        kept[has, slot] = to_bytes(state[has])
        state[has] = absorb(state[has], as_blocks(children[has, slot]))
    return kept, finish(state, sizes)


def resume(states: np.ndarray, slots: np.ndarray, replaced: np.ndarray, rights: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Parent digests when the states (n x 32 bytes) kept for the slots go on with the replaced child and its right siblings."""
    state = absorb(to_states(states), as_blocks(replaced))
    for k in range(int(n_right.max(initial=0))):
        has = n_right > k
        state[has] = absorb(state[has], as_blocks(rights[has, k]))
    return finish(state, slots + 1 + n_right)


# --- the tree as tables ---------------------------------------------------------------------------


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest in hexadecimal of the fields: `-` if null, else byte count, colon, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lowered_on_fifths(ident: Column, text: Column) -> tuple[Column, Column]:
    """(which rows are tampered with, their text): A-Z in lower case where 5 divides the id's checksum."""
    hit = F.coalesce(F.crc32(ident.cast("string")) % 5 == 0, F.lit(False))
    return hit, F.translate(text, UPPER, LOWER)


def positioned(rows: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Rows (grp, id, leaf, ..) with g, the number of their group in order, pos in it and total, its size."""
    order = [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.asc("leaf"), F.asc("tie")]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), "sorted-leaves")
    part = F.shiftright("at", 33)
    pieces = dealt.groupBy("grp", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    pieces = written(pieces, "leaf-pieces")
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "grp", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(group).alias("total"), F.min("first").over(group).alias("begin"),
    )
    # groups are numbered by where they begin: one row per range in the last window, not per group
    begins = pieces.select("begin").distinct().withColumn("start", F.shiftright("begin", 33))
    ranges = begins.groupBy("start").agg(F.count(F.lit(1)).alias("groups"))
    ranges = ranges.select("start", F.coalesce(F.sum("groups").over(Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("start").orderBy("begin")) - 1
    numbers = begins.join(ranges, "start").select("begin", (F.col("earlier") + inside).alias("g"))
    pieces = small(written(pieces.join(numbers, "begin").drop("begin"), "leaf-offsets"), 160, broadcast_bytes)
    same = (pieces["part"] == F.shiftright(dealt["at"], 33)) & pieces["grp"].eqNullSafe(dealt["grp"])
    placed = dealt.join(pieces, same)
    kept = [dealt[c] for c in dealt.columns if c not in ("grp", "at")]
    return placed.select(*kept, "g", "total", (F.col("before") + F.col("at") - F.col("first")).alias("pos"))


def hashed(parents: DataFrame) -> DataFrame:
    """Adds states and digest to (.., size, children packed); a lone leaf's parent is the leaf itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            children = packed_rows(batch["children"].to_pylist(), FANOUT)
            states, digests = retained_states(children, sizes)
            alone = batch["alone"].to_numpy(zero_copy_only=False)
            digests[alone] = children[alone, 0]
            kept = [s[:n].tobytes() for s, n in zip(states, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(kept, pa.binary()), pa.array([d.tobytes() for d in digests], pa.binary())],
                [*batch.schema.names, "states", "digest"],
            )

    schema = T.StructType([*parents.schema.fields, T.StructField("states", T.BinaryType()), T.StructField("digest", T.BinaryType())])
    return parents.mapInArrow(run, schema)


def packed_rows(packed: list[bytes], width: int) -> np.ndarray:
    """Digests side by side in one value each, as n x width x 32 (zeros behind the last)."""
    out = np.zeros((len(packed), width * DIGEST), np.uint8)
    for k, value in enumerate(packed):
        out[k, : len(value)] = np.frombuffer(value, np.uint8)
    return out.reshape(len(packed), width, DIGEST)


def _packed(items: str) -> Column:
    """The digests of an array of structs as one binary value."""
    joined = F.array_join(F.transform(items, lambda x: F.hex(x["digest"])), "")
    return F.unhex(joined)


def _above(nodes: DataFrame) -> DataFrame:
    """Parents of (g, idx, digest, nodes) in groups of more than one node."""
    slot = F.struct((F.col("idx") % FANOUT).cast("int").alias("slot"), "digest")
    up = nodes.where("nodes > 1").groupBy("g", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
        F.sort_array(F.collect_list(slot)).alias("items"), F.first("nodes").alias("nodes")
    )
    return hashed(up.select(
        "g", "idx", F.expr(f"(nodes + {FANOUT - 1}) div {FANOUT}").alias("nodes"), F.size("items").alias("size"),
        F.lit(False).alias("alone"), _packed("items").alias("children"),
    ))


@dataclass(frozen=True)
class Manifest:
    """``levels[0]`` are the parents of the leaves (with their rows), the last ones the nodes below the subroots.

    Columns: g (number of the group), idx (place in its level), nodes (of the group in that level),
    size, children and states (packed by slot), digest.
    ``above`` are the levels over the subroots, ``tops`` the subroots, ``root`` the one root.
    """

    levels: list[DataFrame]
    above: list[DataFrame]
    tops: DataFrame
    root: DataFrame


def _levels(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    out = []
    while most > 1:
        nodes = written(_above(nodes), name)
        out.append(nodes)
        most = -(-most // FANOUT)
    return out


def _tops(levels: list[DataFrame]) -> DataFrame:
    out = None
    for level in levels:
        found = level.where("nodes = 1").select("g", "digest")
        out = found if out is None else out.union(found)
    return out


def build(rows: DataFrame, broadcast_bytes: int = 64 << 20) -> Manifest | None:
    """The trees over rows of (grp, id, leaf: binary, changed: binary or null); None for an empty table."""
    placed = positioned(rows, broadcast_bytes)
    item = F.struct((F.col("pos") % FANOUT).cast("int").alias("slot"), F.col("leaf").alias("digest"), "id", "changed")
    runs = placed.groupBy("g", F.expr(f"pos div {FANOUT}").alias("idx")).agg(
        F.sort_array(F.collect_list(item)).alias("items"), F.first("total").alias("total")
    )
    runs = written(hashed(runs.select(
        "g", "idx", "total", F.expr(f"(total + {FANOUT - 1}) div {FANOUT}").alias("nodes"), F.size("items").alias("size"),
        (F.col("total") == 1).alias("alone"), _packed("items").alias("children"),
        F.transform("items", lambda x: x["id"]).alias("ids"), F.transform("items", lambda x: x["changed"]).alias("changed"),
    )), "leaf-parents")
    most, groups = runs.agg(F.max("nodes"), F.max("g")).first()
    if most is None:
        return None
    levels = [runs, *_levels(runs.select("g", "idx", "digest", "nodes"), most, "manifest-nodes")]
    tops = _tops(levels)
    over = tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), "digest", F.lit(groups + 1).cast("long").alias("nodes"))
    above = _levels(over, groups + 1, "manifest-top")
    return Manifest(levels, above, tops, _tops(above).select("digest") if above else tops.select("digest"))


PATH = "array<struct<slot:int,state:binary,left:binary,right:binary>>"


def _downwards(parents: DataFrame) -> DataFrame:
    """(g, idx, path) of the children of parents with a path: the parent's step first."""
    each = parents.select("g", "idx", "children", "states", "path", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("slot"))
    step = F.struct(
        F.col("slot"), F.expr(f"substring(states, slot * {DIGEST} + 1, {DIGEST})").alias("state"),
        F.expr(f"substring(children, 1, slot * {DIGEST})").alias("left"),
        F.expr(f"substring(children, (slot + 1) * {DIGEST} + 1, {FANOUT * DIGEST})").alias("right"),
    )
    return each.select("g", (F.col("idx") * FANOUT + F.col("slot")).alias("idx"), F.concat(F.array(step), F.col("path")).alias("path"))


def with_paths(manifest: Manifest) -> DataFrame:
    """The parents of the leaves, each with its path to the root, its subroot and the root."""
    empty = F.expr(f"cast(array() as {PATH})").alias("path")
    if manifest.above:
        down = manifest.above[-1].withColumn("path", empty)
        for level in reversed(manifest.above[:-1]):
            down = level.join(_downwards(down), ["g", "idx"])
        over = _downwards(down).select(F.col("idx").alias("g"), "path")
    else:
        over = manifest.tops.select("g", empty)
    over = written(over.join(manifest.tops.withColumnRenamed("digest", "subroot"), "g"), "subroot-paths")
    below = None
    for level in reversed(manifest.levels):
        tops = level.where("nodes = 1").join(over.select("g", "path"), "g")
        if below is not None:
            tops = tops.unionByName(level.where("nodes > 1").join(_downwards(below), ["g", "idx"]))
        below = tops if level is manifest.levels[0] else written(tops, "node-paths")
    return below.join(over.select("g", "subroot"), "g")


def _step_arrays(steps: list) -> tuple[np.ndarray, ...]:
    slots = np.array([s["slot"] for s in steps])
    states = np.frombuffer(b"".join(s["state"] for s in steps), np.uint8).reshape(-1, DIGEST)
    return slots, states, packed_rows([s["right"] for s in steps], FANOUT - 1), np.array([len(s["right"]) // DIGEST for s in steps])


def prove(docs: DataFrame, group: str = "source", ident: str = "doc_id", fields: Sequence[str] = FIELDS, text: str = "text") -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root (of the tampered row) and verified."""
    names = {f"f{k}": name for k, name in enumerate(fields)}
    rows = pick(docs, grp=group, id=ident, txt=text, **names)
    columns = [F.col(f) for f in names]
    hit, tampered = lowered_on_fifths(F.col("id"), F.col("txt"))
    other = leaf_of([tampered if name == text else c for c, name in zip(columns, fields, strict=True)])
    rows = rows.select("grp", "id", F.unhex(leaf_of(columns)).alias("leaf"), F.when(hit, F.unhex(other)).alias("changed"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField(ident, id_type), *(T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
        T.StructField("verified", T.BooleanType()),
    ])
    manifest = build(rows)
    if manifest is None:
        return docs.sparkSession.createDataFrame([], schema)
    root = manifest.root.first()[0].hex()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                yield fold_runs(batch.slice(begin, 256))

    def fold_runs(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, alone = batch["size"].to_numpy(), batch["alone"].to_numpy(zero_copy_only=False)
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        slots = np.arange(len(run_of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        packed, paths = batch["children"].to_pylist(), batch["path"].to_pylist()
        leaves = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, DIGEST)
        current = leaves.copy()
        for k, value in enumerate(batch["changed"].flatten().to_pylist()):
            if value is not None:
                current[k] = np.frombuffer(value, np.uint8)
        kept, children = packed_rows(batch["states"].to_pylist(), FANOUT), packed_rows(packed, FANOUT + 1)
        at = np.flatnonzero(~alone[run_of])
        if len(at):
            right = children[run_of[at][:, None], np.minimum(slots[at][:, None] + 1 + np.arange(FANOUT - 1), FANOUT)]
            current[at] = resume(kept[run_of[at], slots[at]], slots[at], current[at], right, sizes[run_of[at]] - slots[at] - 1)
        for height in range(max(map(len, paths), default=0)):
            runs = np.array([r for r, p in enumerate(paths) if len(p) > height])
            place = np.full(len(paths), -1)
            place[runs] = np.arange(len(runs))
            slot, state, right, n_right = _step_arrays([paths[r][height] for r in runs])
            at = np.flatnonzero(place[run_of] >= 0)
            step = place[run_of[at]]
            current[at] = resume(state[step], slot[step], current[at], right[step], n_right[step])
        tails = [b"".join(s["left"] + s["right"] for s in p).hex() for p in paths]
        proofs = []
        for r, slot in zip(run_of, slots, strict=True):
            own = packed[r][: slot * DIGEST] + packed[r][(slot + 1) * DIGEST :]
            proofs.append(hashlib.sha256((own.hex() + tails[r]).encode()).hexdigest())
        folded = [d.tobytes().hex() for d in current]
        subroots = [s.hex() for s in batch["subroot"].to_pylist()]
        return pa.RecordBatch.from_arrays([
            batch["ids"].flatten(), pa.array([d.tobytes().hex() for d in leaves]), pa.array([subroots[r] for r in run_of], pa.string()),
            pa.array([root] * len(run_of), pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
            pa.array([f == root for f in folded], pa.bool_()),
        ], schema.names)

    paths = with_paths(manifest).select("size", "alone", "children", "states", "ids", "changed", "path", "subroot")
    return paths.mapInArrow(fold, schema)
