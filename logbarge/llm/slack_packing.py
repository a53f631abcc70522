"""Pack token sequences by minimum bin slack.

A document's ids fill whole windows from its start; what remains is a piece shorter than a window.
The remaining pieces of a block of documents form a multiset of lengths. For each window the
longest piece is set and a subset-sum programme over a bitset finds the multiset of other lengths
that comes closest to the capacity: bit s of an integer says that sum s can be reached, one shift
per length and copy adds that length, and the integers kept before each length give the counts
back. A window that comes out exact is repeated as long as the counts last. If slack remains, it is
filled by cutting a piece, so every window of a block is full; at most a window's worth of pieces
waits for the next block.

At the end of a task the rest, less than a window, is cut into sequences whose lengths are powers
of two, which need no padding (``power_tails=False``: one short sequence instead).

One pass, no shuffle: each task packs the documents it reads, with memory for one block
(``block_tokens`` ids, or one document where that is longer) and work per window bounded by the
capacity, not by the data. A task that is run again packs the same rows again.

Defined results: a null text counts as empty, so it holds the end id alone; repeated rows and ids
are packed each on their own; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pick, slices
from .tokens import Vocabulary, encoder

#: Sequence ids of a task start here times its number.
IDS_PER_TASK = 1 << 33


def closest_multiset(lengths: list[int], counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum <= room of the given lengths (ascending), each used at most as counted, and its counts."""
    reach, full, kept = 1, 1 << room, []
    within = (full << 1) - 1
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        if not counts[length]:
            continue
        kept.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            more = (reach | reach << length) & within
            if more == reach:
                break
            reach = more
            if reach & full:
                break
        if reach & full:
            break
    rest = total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, before in reversed(kept):
        while not before >> rest & 1:
            rest -= length
            used[length] = used.get(length, 0) + 1
    return total, used


@dataclass
class Packer:
    """Pieces waiting for a window, by length; a piece is (document, start)."""

    capacity: int
    lengths: list[int] = field(default_factory=list)
    counts: dict[int, int] = field(default_factory=dict)
    pieces: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    waiting: int = 0

    def put(self, document: int, start: int, length: int) -> None:
        if not self.counts.get(length):
            insort(self.lengths, length)
            self.pieces[length] = []
        self.counts[length] = self.counts.get(length, 0) + 1
        self.pieces[length].append((document, start))
        self.waiting += length

    def take(self, length: int) -> tuple[int, int, int]:
        document, start = self.pieces[length].pop()
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.lengths[bisect_left(self.lengths, length)]
        self.waiting -= length
        return document, start, length

    def cut(self, size: int) -> tuple[int, int, int]:
        """The first ``size`` ids of the longest piece; its rest waits on."""
        document, start, length = self.take(self.lengths[-1])
        if length > size:
            self.put(document, start + size, length - size)
        return document, start, min(size, length)

    def windows(self, size: int) -> Iterator[list[tuple[int, int, int]]]:
        """Windows of ``size`` ids for which there is enough waiting: at least one, more if they are alike."""
        at = bisect_right(self.lengths, size) - 1
        if at < 0:
            yield [self.cut(size)]
            return
        longest = self.lengths[at]
        self.counts[longest] -= 1
        total, used = closest_multiset(self.lengths, self.counts, size - longest)
        self.counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        slack = size - longest - total
        times = 1 if slack else min(self.counts[length] // k for length, k in used.items())
        for _ in range(times):
            window = [self.take(length) for length, k in used.items() for _ in range(k)]
            yield window + [self.cut(slack)] if slack else window

    def full_windows(self) -> Iterator[list[tuple[int, int, int]]]:
        while self.waiting >= self.capacity:
            yield from self.windows(self.capacity)

    def last_windows(self, power_tails: bool) -> Iterator[list[tuple[int, int, int]]]:
        yield from self.full_windows()
        while self.waiting and power_tails:
            yield next(self.windows(1 << self.waiting.bit_length() - 1))
        if self.waiting:
            yield [self.take(self.lengths[-1]) for _ in range(sum(self.counts.values()))]


def pack_tokens(
    docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), capacity: int = 2048, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = True, power_tails: bool = True, block_tokens: int = 1 << 21,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    ``ids`` and the checksum are those of the piece as little-endian unsigned 32-bit numbers.
    Sequence ids are unique, not gapless; offsets within a sequence are gapless from 0.
    """
    rows = pick(docs, doc_id=id_column, text=text_column)
    numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in numbers)])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        packer, held, names, out = Packer(capacity), {}, {}, []
        sequence, pending, document = TaskContext.get().partitionId() * IDS_PER_TASK, 0, 0
        id_type = None

        def emit(window: list[tuple[int, int, int]]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, length in window:
                ids = held[doc]
                piece = ids[start : start + length].tobytes()
                row = (names[doc], start, length, zlib.crc32(piece), len(ids), sequence, offset)
                out.append((*row, piece) if with_ids else row)
                offset += length
            sequence += 1

        def flushed() -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * len(numbers), *[pa.binary()] * with_ids]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            waiting = {doc for length in packer.lengths for doc, _ in packer.pieces[length]}
            for doc in [d for d in held if d not in waiting]:
                del held[doc], names[doc]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in slices(batches):
            id_type = batch["doc_id"].type
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py())
                held[document], names[document] = ids, name
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    emit([(document, start, capacity)])
                if len(ids) > whole:
                    packer.put(document, whole, len(ids) - whole)
                document += 1
                pending += len(ids)
                if pending >= block_tokens:
                    for window in packer.full_windows():
                        emit(window)
                    pending = 0
                    if out:
                        yield flushed()
        for window in packer.last_windows(power_tails):
            emit(window)
        if out:
            yield flushed()

    return rows.mapInArrow(pack, schema)


def padding(lengths: np.ndarray, capacity: int) -> int:
    """Ids of padding that sequences of these lengths need; a power of two needs none."""
    free = (lengths & (lengths - 1)) == 0
    return int(np.where(free, 0, capacity - lengths).sum())
