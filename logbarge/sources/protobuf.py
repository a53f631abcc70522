"""Read pushed Protobuf messages back into records.

The layout is that of ``functions/wire.py``. A batch of messages is read as one array of bytes: at each
level one cursor per message goes from field to field, all cursors at the same time, so varints and
lengths are decoded as arrays. What is left per entry is a slice of bytes to text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.blocks import parts, plain

VARINT, EIGHT_BYTES, BYTES, FOUR_BYTES = 0, 1, 2, 5
LABEL = re.compile(r'([^=]*)="((?:[^"\\]|\\"|\\)*?)"(?=[,}]),?', re.DOTALL)


class Malformed(ValueError):
    """The bytes are no message of this layout."""


def varints(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The base-128 numbers that begin at these places, as signed 64 bits, and the places behind them."""
    value, at = np.zeros(len(at), np.uint64), at.copy()
    live = np.arange(len(at))
    for k in range(10):
        if len(live) and at[live].max() >= len(raw):
            raise Malformed("a number goes beyond the end")
        byte = raw[at[live]]
        value[live] |= (byte & 127).astype(np.uint64) << np.uint64(7 * k)
        at[live] += 1
        live = live[byte >= 128]
        if not len(live):
            return value.astype(np.int64), at
    raise Malformed("a number has more than ten bytes")


@dataclass
class Fields:
    """Fields in order of their messages and places: message, number, value (of numbers), bytes begin and end."""

    of: np.ndarray
    number: np.ndarray
    value: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def where(self, number: int) -> Fields:
        keep = self.number == number
        return Fields(self.of[keep], self.number[keep], self.value[keep], self.begin[keep], self.end[keep])

    def last(self, number: int, messages: int) -> Fields:
        """One field of that number per message: the last, or none as empty bytes and 0."""
        some = self.where(number)
        out = Fields(np.arange(messages), np.full(messages, number), *(np.zeros(messages, np.int64) for _ in range(3)))
        out.value[some.of], out.begin[some.of], out.end[some.of] = some.value, some.begin, some.end
        return out


def fields(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Fields:
    """The fields of the messages at these places."""
    found: list[tuple] = []
    live = np.flatnonzero(begin < end)
    at = begin[live]
    while len(live):
        tag, at = varints(raw, at)
        kind, number = tag & 7, tag >> 3
        value, start, stop = np.zeros(len(live), np.int64), at.copy(), at.copy()
        counted = (kind == VARINT) | (kind == BYTES)
        value[counted], start[counted] = varints(raw, at[counted])
        stop = start + np.select([kind == BYTES, kind == EIGHT_BYTES, kind == FOUR_BYTES], [value, 8, 4], 0)
        if ((stop > end[live]) | (stop < start) | ~np.isin(kind, (VARINT, EIGHT_BYTES, BYTES, FOUR_BYTES))).any():
            raise Malformed("a field goes beyond its message")
        found.append((live, number, value, start, stop))
        more = stop < end[live]
        live, at = live[more], stop[more]
    columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(5)]
    order = np.argsort(columns[0], kind="stable")
    return Fields(*(c[order] for c in columns))


@lru_cache(maxsize=65_536)
def labels_of(text: str) -> tuple[tuple[str, str], ...]:
    """Labels of a selector. Only quotes are escaped there, so a value that ends in a backslash before a comma can't be told apart."""
    inner, out, at = text[1:], [], 0
    while at < len(inner) - 1:
        match = LABEL.match(inner, at)
        if match is None:
            raise Malformed(f"no label set: {text[:100]}")
        out.append((match[1], match[2].replace('\\"', '"')))
        at = match.end()
    return tuple(out)


def _texts(raw: bytes, some: Fields) -> list[str]:
    return [raw[b:e].decode() for b, e in zip(some.begin.tolist(), some.end.tolist(), strict=True)]


def _maps(sizes: np.ndarray, keys: list[str], values: list[str]) -> pa.MapArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.MapArray.from_arrays(pa.array(offsets), pa.array(keys, pa.string()), pa.array(values, pa.string()))


def read_messages(payloads: list[bytes]) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """(payload of each entry, its columns)."""
    raw = b"".join(payloads)
    data = np.frombuffer(raw, np.uint8)
    ends = np.cumsum([len(p) for p in payloads]).astype(np.int64)
    streams = fields(data, ends - [len(p) for p in payloads], ends).where(1)
    parts = fields(data, streams.begin, streams.end)
    texts = _texts(raw, parts.last(1, len(streams.of)))
    sets = [labels_of(t) if t else () for t in texts]
    entries = parts.where(2)
    n = len(entries.of)
    inner = fields(data, entries.begin, entries.end)
    when = inner.last(1, n)
    time = fields(data, when.begin, when.end)
    seconds, nanos = time.last(1, n).value, time.last(2, n).value
    pairs = inner.where(3)
    names = fields(data, pairs.begin, pairs.end)
    first = np.searchsorted(entries.of, entries.of)
    labels = _maps(np.array([len(s) for s in sets], np.int64), [k for s in sets for k, _ in s], [v for s in sets for _, v in s])
    return streams.of[entries.of], {
        "labels": labels.take(pa.array(entries.of)),
        "entry_no": pa.array((np.arange(n) - first).astype(np.int32)),
        "ts_ms": pa.array(seconds * 1000 + nanos // 1_000_000),
        "nanos_in_ms": pa.array((nanos % 1_000_000).astype(np.int32)),
        "line": pa.array(_texts(raw, inner.last(2, n)), pa.string()),
        "metadata": _maps(
            np.bincount(pairs.of, minlength=n), _texts(raw, names.last(1, len(pairs.of))), _texts(raw, names.last(2, len(pairs.of)))
        ),
    }


def read_proto_payloads(df: DataFrame, col: str = "payload_bin", snappy: bool = False) -> DataFrame:
    """``read_payloads`` for Protobuf messages; ``snappy`` ones are decompressed by the worker that reads them.

    A worker has the entries of a few MB of messages in memory together, or of one larger message. A null payload has no entries. Bytes that are no message fail the query, so that their entries are
    not lost unseen.
    """
    names, at = [c for c in df.columns if c != col], df.columns.index(col)
    text_map = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([
        *(df.schema[c] for c in names), T.StructField("labels", text_map), T.StructField("entry_no", T.IntegerType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("nanos_in_ms", T.IntegerType()), T.StructField("line", T.StringType()), T.StructField("metadata", text_map),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, at, snappy):
                messages = [p or b"" for p in part.column(at).to_pylist()]
                of, columns = read_messages([plain(m) if m else m for m in messages] if snappy else messages)
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part[c].take(rows) for c in names), *columns.values()], schema.names)

    return df.mapInArrow(read, schema)
