"""Binary columns of Arrow batches: parts of bounded size, and raw Snappy blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Plain bytes that are in a worker's memory together, and values at most.
PART_BYTES, PART_ROWS = 4 << 20, 256


def plain_length(block: bytes) -> tuple[int, int]:
    """(plain length of a raw Snappy block, bytes of the varint that tells it)."""
    length = 0
    for k, b in enumerate(block[:5]):
        length |= (b & 127) << 7 * k
        if b < 128:
            return length, k + 1
    raise ValueError("no raw Snappy block")


def plain(block: bytes) -> bytes:
    return pa.decompress(block, decompressed_size=plain_length(block)[0], codec="snappy", asbytes=True)


def parts(batch: pa.RecordBatch, at: int, packed: bool = False) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose binary column holds ``PART_BYTES`` at most, or a single row.

    ``packed`` values are raw Snappy blocks and count with their plain length.
    """
    column = batch.column(at)
    if packed:
        sizes = [plain_length(v)[0] if v else 0 for v in pc.binary_slice(column, 0, 5).to_pylist()]
    else:
        sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
    begin = held = 0
    for k, size in enumerate(sizes):
        if k > begin and (held + size > PART_BYTES or k - begin == PART_ROWS):
            yield batch.slice(begin, k - begin)
            begin, held = k, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)
