"""Near-duplicate documents by ProbMinHash: weighted shingles, probability Jaccard.

A document is the set of its five-word shingles (lower case, words parted by white space), each
with weight 1 + ln(occurrences). Two documents' probability Jaccard is

    J(x, y) = sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)

which is the plain Jaccard index where all weights are 1.

1. Signatures. Every shingle emits points of a Poisson process with its weight as rate, each thrown
   into a random register; a register keeps its first arrival. Two documents agree in a register
   with probability J. A shingle stops as soon as its next arrival is later than every register's,
   so long documents need little more than one arrival per shingle. Rounds of arrivals run on all
   documents of a batch at once.
2. Documents with the same weighted shingles are one class; only one of each class goes on.
3. Banding: 20 bands of 5 registers, found alike with probability 1 - (1 - J^5)^20, over 0.9996
   at J = 0.8. In each bucket every member is compared with the bucket's head, exactly; heads are
   drawn by a hash that differs from band to band.
4. Links found so far give components. Buckets whose members lie in several components are
   compared further, in blocks: all pairs across components whose registers agree in ``threshold``
   less three standard errors are compared exactly too, unless joined by then, so no link between
   components is lost, whether a bucket's members are like its head or not. First the registers
   tell which members have such a pair at all; only those bring their shingles. No pair becomes a
   row but the links that join components.
5. The components of all exact links are the groups.

Groups of copies are folded by partial aggregation; buckets of near copies give one pair per
member; nothing collects a bucket. The tables of steps 1 and 5 are written to the shared folder.

Defined results: null, empty and blank texts have no shingle and are in no group with others; a
text of one to four words has one shingle, all of it; repeated rows are copies of each other, so
one stays; the member that stays is the one with the least id (nulls last), then the first read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_group, quoted, slices, small, written
from .components import connected_components

WORDS, BANDS, ROWS = 5, 20, 5
REGISTERS = BANDS * ROWS
#: Bits of a shingle's hash; with a document's number in a batch above them.
BITS = 44
#: Characters that one round of array work takes at once, and members of a block of a bucket.
CHUNK_CHARS, BLOCK = 1 << 19, 512


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, occurrences), ordered by document and shingle."""
    words = [(t or "").lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = list(chain.from_iterable(words))
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = pd.util.hash_array(flat, categorize=True)
    begins = np.cumsum(sizes) - sizes
    shingles = np.maximum(sizes - WORDS + 1, (sizes > 0).astype(np.int64))
    docs = np.repeat(np.arange(len(texts)), shingles)
    first = np.arange(len(docs)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + begins[docs]
    ends = begins[docs] + sizes[docs]
    value = np.zeros(len(docs), np.uint64)
    for k in range(WORDS):
        at = first + k
        word = np.where(at < ends, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k))
    keys = np.sort(docs.astype(np.uint64) << np.uint64(BITS) | value >> np.uint64(64 - BITS))
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    return (keys >> np.uint64(BITS)).astype(np.int64), keys & np.uint64((1 << BITS) - 1), counts


def weights_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def signatures(n_docs: int, docs: np.ndarray, shingles: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first in each register, per document; all ones where there is none."""
    arrival = np.full(n_docs * registers, np.inf)
    winner = np.full(n_docs * registers, ~np.uint64(0))
    time, step = np.zeros(len(docs)), 0
    while len(docs):
        draw = mixed(shingles + np.uint64((0x9E3779B97F4A7C15 * (step + 1)) & (2**64 - 1)))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weights
        register = ((draw & np.uint64(0xFFFF)) * np.uint64(registers) >> np.uint64(16)).astype(np.int64)
        if step:
            live = time < latest[docs]
            docs, shingles, weights, time, register = docs[live], shingles[live], weights[live], time[live], register[live]
        place = docs * registers + register
        np.minimum.at(arrival, place, time)
        won = arrival[place] == time
        winner[place[won]] = shingles[won]
        latest = arrival.reshape(n_docs, registers).max(1)
        live = time < latest[docs]
        docs, shingles, weights, time = docs[live], shingles[live], weights[live], time[live]
        step += 1
    return winner.reshape(n_docs, registers)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band."""
    bands = signature.reshape(len(signature), BANDS, ROWS)
    key = np.zeros(bands.shape[:2], np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return key.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J of two (sorted shingles, weights).

    With y_j / x_j sorted among all shingles, the inner sum for a common i is the x-mass of shingles of
    smaller ratio over x_i plus the y-mass of the others over y_i: one sort and two prefix sums.
    """
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][i], b[1][j]
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    # shingles only in a have ratio 0, those only in b an infinite one
    x_mass = a[1].sum() - x.sum() + np.cumsum(x)
    y_mass = b[1].sum() - np.cumsum(y)
    return float((1 / (x_mass / x + y_mass / y)).sum())


def packed(shingles: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted 32-bit shingles, and (place, count) where a count is above 1."""
    many = np.flatnonzero(counts > 1)
    short = (shingles >> np.uint64(BITS - 32)).astype("<u4")
    return short.tobytes(), np.stack([many, counts[many]], 1).astype("<u4").tobytes()


def unpacked(shingles: bytes, many: bytes) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(shingles, "<u4")
    counts = np.ones(len(values))
    place = np.frombuffer(many, "<u4").reshape(-1, 2)
    counts[place[:, 0]] = place[:, 1]
    weights = weights_of(counts)
    if len(values) > 1 and (values[1:] == values[:-1]).any():  # two shingles alike in 32 bits
        values, starts = np.unique(values, return_index=True)
        weights = np.maximum.reduceat(weights, starts)
    return values, weights


SKETCH = T.StructType([
    T.StructField("content", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    T.StructField("registers", T.BinaryType()), T.StructField("shingles", T.BinaryType()), T.StructField("many", T.BinaryType()),
])


def sketch(texts: list[str | None]) -> list[tuple | None]:
    """A row of ``SKETCH`` per text, None where there is no word."""
    docs, shingles, counts = weighted_shingles(texts)
    winners = signatures(len(texts), docs, shingles, weights_of(counts))
    keys = band_keys(winners)
    ends = np.searchsorted(docs, np.arange(len(texts) + 1))
    short = (winners >> np.uint64(BITS - 32)).astype("<u4")
    out: list[tuple | None] = []
    for d in range(len(texts)):
        mine = slice(ends[d], ends[d + 1])
        if mine.start == mine.stop:
            out.append(None)
            continue
        content = hashlib.blake2b(shingles[mine].tobytes() + counts[mine].astype("<i8").tobytes(), digest_size=16).digest()
        out.append((content, keys[d].tolist(), short[d].tobytes(), *packed(shingles[mine], counts[mine])))
    return out


def sketches(rows: DataFrame) -> DataFrame:
    """``rows`` without ``text``, with the columns of ``SKETCH`` (null where there is no word)."""
    kept = [c for c in rows.columns if c != "text"]
    schema = T.StructType([*(rows.schema[c] for c in kept), *SKETCH.fields])
    kinds = [pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            begin = size = 0
            texts: list[str | None] = []
            for k, text in enumerate(batch["text"]):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= CHUNK_CHARS or k + 1 == batch.num_rows:
                    found = [r or (None,) * 5 for r in sketch(texts)]
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch[c].slice(begin, len(texts)) for c in kept] + columns, schema.names)
                    begin, size, texts = k + 1, 0, []

    return rows.mapInArrow(run, schema)


def chosen(rows: DataFrame, uids: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The ``rows`` with one of the uids; few enough uids go to the rows instead of the rows to them."""
    return rows.join(small(written(uids.distinct(), "chosen"), 48, broadcast_bytes), "uid", "left_semi")


def exact_links(pairs: DataFrame, sketched: DataFrame, threshold: float, broadcast_bytes: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose probability Jaccard reaches the threshold."""
    both = pairs.select(F.col("a").alias("uid")).union(pairs.select(F.col("b").alias("uid")))
    picked = written(chosen(sketched.select("uid", "shingles", "many"), both, broadcast_bytes), "candidates")
    side = lambda n: picked.select(F.col("uid").alias(n), F.struct("shingles", "many").alias(f"s{n}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, held = [], None, None
            for row in zip(batch["b"].to_pylist(), batch["sa"].to_pylist(), batch["sb"].to_pylist(), strict=True):
                if row[0] != last:
                    last, held = row[0], unpacked(row[2]["shingles"], row[2]["many"])
                keep.append(probability_jaccard(unpacked(row[1]["shingles"], row[1]["many"]), held) >= threshold - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(verify, "a long, b long")


KEYS = ["band", "key", "i", "j"]


def likely_pairs(group: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs of a block pair to compare, and their share of equal registers, at least ``least``.

    Only pairs of different components, of the two blocks if they differ, that meet in no earlier band.
    """
    component, own = group["component"].to_numpy(), group["own"].to_numpy()
    values = np.frombuffer(b"".join(group["registers"]), "<u4").reshape(len(group), -1)
    bands = np.stack(group["bands"].to_numpy())[:, : int(group["band"].iloc[0])]
    crossed = group["i"].iloc[0] != group["j"].iloc[0]
    parts = []
    for k in range(len(group) - 1):
        other = component[k + 1 :] != component[k]
        if crossed:
            other &= own[k + 1 :] != own[k]
        at = np.flatnonzero(other) + k + 1
        share = (values[at] == values[k]).mean(1)
        at, share = at[share >= least], share[share >= least]
        new = ~(bands[at] == bands[k]).any(1)
        parts.append((np.full(int(new.sum()), k), at[new], share[new]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 3


def with_likely_pairs(members: DataFrame, least: float) -> DataFrame:
    """The members of each block pair that have a likely pair in it."""
    columns = [*KEYS, "own", "uid", "component"]

    def of(group: pd.DataFrame) -> pd.DataFrame | None:
        a, b, _ = likely_pairs(group, least)
        return group.iloc[np.union1d(a, b)][columns] if len(a) else None

    kinds = "band int, key long, i int, j int, own int, uid long, component long"
    return per_group(members, KEYS, of, kinds)


def links_across(members: DataFrame, least: float, threshold: float) -> DataFrame:
    """Links (a, b) that join components: likely pairs in falling order, compared exactly unless joined by now."""

    def of(group: pd.DataFrame) -> pd.DataFrame | None:
        a, b, share = likely_pairs(group, least)
        uids, component = group["uid"].to_numpy(), group["component"].to_numpy().copy()
        texts = [unpacked(x, y) for x, y in zip(group["shingles"], group["many"], strict=True)]
        found = []
        for k in np.argsort(-share, kind="stable"):
            x, y = component[a[k]], component[b[k]]
            if x != y and probability_jaccard(texts[a[k]], texts[b[k]]) >= threshold - 1e-9:
                component[component == y] = x
                found.append((max(uids[a[k]], uids[b[k]]), min(uids[a[k]], uids[b[k]])))
        return pd.DataFrame(found, columns=["a", "b"]) if found else None

    return per_group(members, KEYS, of, "a long, b long")


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per document: doc_id, group_id (least id of its group), group_size, kept, row_key.

    ``row_key`` is a hash of id and text, for joining the rows back to the documents. Bucket heads and
    ids of candidates are counted and broadcast if they take at most ``broadcast_bytes``; else they
    are shuffled.
    """
    rows = docs.select(
        docs[quoted(id_column)].alias("doc_id"), docs[quoted(text_column)].alias("text"),
    ).select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.monotonically_increasing_id().alias("uid"), "text")
    sketched = written(sketches(rows), "sketches")

    classes = written(
        sketched.where("content is not null").groupBy("content").agg(F.min("uid").alias("a")), "classes"
    )
    single = sketched.select("uid", "bands").join(classes.select(F.col("a").alias("uid")), "uid", "left_semi")
    banded = written(single, "bands").select("uid", F.posexplode("bands").alias("band", "key"))
    # every band draws its heads anew, so a member of a crowd meets up to as many heads as there are bands
    head = F.min_by("uid", F.xxhash64("uid", "band")).alias("head")
    buckets = banded.groupBy("band", "key").agg(head, F.min("uid").alias("low"), F.max("uid").alias("high"))
    buckets = written(buckets.where("low < high").select("band", "key", "head"), "buckets")
    shared = written(banded.join(small(buckets, 160, broadcast_bytes), ["band", "key"]), "shared-buckets")
    pairs = shared.where("uid <> head").select(F.greatest("uid", "head").alias("a"), F.least("uid", "head").alias("b"))
    pairs = written(pairs.distinct(), "pairs")
    links = written(exact_links(pairs, sketched, threshold, broadcast_bytes), "first-links")
    first = connected_components(links)

    placed = shared.join(first.withColumnRenamed("node", "uid"), "uid", "left")
    placed = written(placed.select("band", "key", "uid", F.coalesce("component", "uid").alias("component")), "placed")
    mixed_buckets = placed.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low < high")
    error = (threshold * (1 - threshold) / REGISTERS) ** 0.5
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("uid"), blocks).cast("int")
    members = placed.join(mixed_buckets, ["band", "key"]).select("band", "key", "uid", "component", blocks.alias("blocks"), own.alias("own"))
    members = written(members, "mixed-buckets")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    registers = chosen(sketched.select("uid", "registers", "bands"), members.select("uid"), broadcast_bytes)
    members = members.select("band", "key", "uid", "component", "own", other).select(
        "band", "key", "uid", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    ).join(registers, "uid")
    least = threshold - 3 * error
    likely = written(with_likely_pairs(members, least), "likely-members")
    texts = chosen(sketched.select("uid", "registers", "bands", "shingles", "many"), likely.select("uid"), broadcast_bytes)
    links = links.union(links_across(likely.join(texts, "uid"), least, threshold))

    groups = connected_components(links).withColumnsRenamed({"node": "a"})
    named = classes.join(groups, "a", "left").select("content", F.coalesce("component", "a").alias("component"))
    placed = sketched.select("doc_id", "row_key", "uid", "content").join(named, "content", "left").select(
        "doc_id", "row_key", "uid", F.coalesce("component", "uid").alias("component")
    )
    placed = written(placed, "grouped")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    heads = placed.groupBy("component").agg(best.alias("head"), F.count(F.lit(1)).alias("group_size"))
    return placed.join(heads, "component").select(
        "doc_id", F.col("head.doc_id").alias("group_id"), "group_size", (F.col("uid") == F.col("head.uid")).alias("kept"), "row_key"
    )


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits of id and text."""
    return F.struct(F.xxhash64(doc_id, text).alias("x"), F.xxhash64(text, doc_id, F.lit("row")).alias("y"))


def deduplicated(
    docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """The rows of ``docs``, all columns, of which each group keeps one.

    Texts are shuffled only where a kept row has an equal twin, or where the keys of the kept rows
    take more than ``broadcast_bytes``.
    """
    judged = near_duplicates(docs, threshold, id_column, text_column, broadcast_bytes)
    keys = judged.groupBy(F.col("row_key").alias("_key")).agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = written(keys.where("kept > 0"), "kept-rows")
    names = docs.columns
    shelled = docs.select(F.struct(*[docs[quoted(c)] for c in names]).alias("row"), row_key(docs[quoted(id_column)], docs[quoted(text_column)]).alias("_key"))

    def rows(test: str) -> DataFrame:
        return shelled.join(small(keys.where(test).select("_key"), 160, broadcast_bytes), "_key", "left_semi")

    kept = rows("kept = n").union(rows("kept < n").dropDuplicates(["_key"]))
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
