"""Write documents as packed matrices of token ids: best-fit decreasing with a segment tree.

Documents longer than a row are split into whole rows and a rest, losing nothing. The pieces of a
block of documents are placed longest first, each in the open row with the least room that still
holds it. Rows are found by a segment tree over room sizes (0 to the row width): a leaf holds the
open rows with that much room, a node how many lie below it, so the search goes up from the wanted
room and down to the first non-empty leaf in O(log width), however many rows are open.

A row of the result is a row of the matrix: its padded ids, the cumulative lengths of its segments
and the positions where counting restarts at 0, so that attention and positions can stay within
documents. ``documents_of`` puts the documents together again.

One pass, no shuffle, memory for one block per task. Defined results: a null text counts as empty
(the end id alone); repeated rows are packed each on their own, told apart by ``piece_keys``; an
empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, slices
from .tokens import Vocabulary, encoder


class RoomTree:
    """Open rows by the room left in them, 0 to ``width``."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.below = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.below[node] += by
            node >>= 1

    def best_fit(self, length: int) -> tuple[int, int] | None:
        """Take out the row with the least room of at least ``length``: (room, row)."""
        node, below = self.leaves + length, self.below
        if not below[node]:
            while node > 1 and (node & 1 or not below[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                if not below[node]:
                    node += 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Indices of the pieces in each row, in the order placed."""
    tree, rows = RoomTree(width), []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.best_fit(lengths[k])
        if found is None:
            found = width, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(k)
        tree.add(room - lengths[k], row)
    return rows


MATRIX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
    T.StructField("input_ids", T.BinaryType()), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
    T.StructField("position_resets", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("piece_keys", T.ArrayType(T.LongType())),
])


def pack_matrix(
    docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), width: int = 2048, pad_id: int = 0, dtype: str = "<u2",
    id_column: str = "doc_id", text_column: str = "text", block_tokens: int = 1 << 21,
) -> DataFrame:
    """The matrix rows of all documents.

    shard and row name a row. ``input_ids`` holds ``width`` ids of ``dtype`` (raises if an id does
    not fit), the last ``width - n_tokens`` of them padding. ``cu_seqlens`` runs from 0 to n_tokens.
    Per segment: ``position_resets`` (where it begins in the row), ``starts`` (its place in its
    document), ``doc_ids``, ``piece_keys`` (number of the document in its shard).
    """
    rows = pick(docs, doc_id=id_column, text=text_column)
    schema = T.StructType([*MATRIX.fields, T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType))])
    top = np.iinfo(dtype).max

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(vocabulary), TaskContext.get().partitionId()
        pieces: list[tuple] = []  # (key, doc_id, start, ids)
        written, held, id_type = 0, 0, None

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal written
            filled = best_fit_decreasing([len(p[3]) for p in pieces], width)
            out = []
            for members in filled:
                segments = [pieces[k] for k in members]
                ends = np.cumsum([0, *(len(p[3]) for p in segments)])
                ids = np.full(width, pad_id, dtype)
                ids[: ends[-1]] = np.concatenate([p[3] for p in segments])
                out.append((
                    shard, written, int(ends[-1]), ids.tobytes(), ends.tolist(), ends[:-1].tolist(),
                    [p[2] for p in segments], [p[0] for p in segments], [p[1] for p in segments],
                ))
                written += 1
            pieces.clear()
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), *[pa.list_(pa.int32())] * 2, *[pa.list_(pa.int64())] * 2, pa.list_(id_type)]
            for k in range(0, len(out), 1024):
                columns = zip(*out[k : k + 1024], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], schema.names)

        key = 0
        for batch in slices(batches):
            id_type = batch["doc_id"].type
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py())
                if ids.max() > top:
                    raise ValueError(f"id {ids.max()} does not fit {dtype}")
                pieces += [(key, name, start, ids[start : start + width]) for start in range(0, len(ids), width)]
                held += len(ids)
                key += 1
                if held >= block_tokens:
                    yield from block()
                    held = 0
        if pieces:
            yield from block()

    return rows.mapInArrow(pack, schema)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """The matrix as Parquet files, one or more per shard."""
    matrix.write.parquet(path)


def documents_of(matrix: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(shard, piece_key, doc_id, ids): every document's ids, put together from its segments."""
    size = np.dtype(dtype).itemsize
    segment = F.explode(F.arrays_zip("piece_keys", "doc_ids", "starts", "position_resets", F.slice("cu_seqlens", F.lit(2), F.size("starts")).alias("ends")))
    parts = matrix.select("shard", "input_ids", segment.alias("s")).select(
        "shard", F.col("s.piece_keys").alias("piece_key"), F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"),
        F.substring("input_ids", F.col("s.position_resets") * size + 1, (F.col("s.ends") - F.col("s.position_resets")) * size).alias("ids"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("start", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return parts.groupBy("shard", "piece_key", "doc_id").agg(joined.alias("ids"))
