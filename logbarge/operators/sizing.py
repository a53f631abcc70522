"""Record sizes and the oversize split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import map_bytes
from ..functions.text import utf8_len
from ..settings import MAX_BYTES

# Bytes counted on top of the texts, whatever the output format.
PER_MESSAGE = 24
PER_METADATA = 24
PER_METADATA_ENTRY = 4
PER_STREAM = 8


def message_size() -> Column:
    return utf8_len("line") + PER_MESSAGE


def metadata_size() -> Column:
    entries = F.size("metadata")
    return map_bytes("metadata") + F.when(entries > 0, PER_METADATA).otherwise(0) + entries * PER_METADATA_ENTRY


def stream_size() -> Column:
    return map_bytes("labels") + PER_STREAM


def known(size: Column) -> Column:
    """A size, failing on null: as a number it would switch the byte limit off."""
    return F.coalesce(size, F.raise_error(F.lit("a record has no size: set records without line or labels aside")))


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows behind a one-row ``inline``.

    Sizes and the oversize filter use labels, metadata and line several times. Without this step the
    filter is pushed below the projection that renders them, and every use renders them again.
    The price: a filter added behind this step does not reach the scan, so filter events before it.
    """
    return df.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))


def with_size(df: DataFrame) -> DataFrame:
    """Add msg_sz, meta_sz and stream_sz; the last counts once per stream of a batch."""
    return evaluated_once(df).withColumns(
        {"msg_sz": message_size(), "meta_sz": metadata_size(), "stream_sz": stream_size()}
    )


def split_oversize(df: DataFrame, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """(records that fit into a batch of their own, records that are refused).

    A record without a size (a null line or map) is refused, so no record is in neither.
    """
    sized = df if "msg_sz" in df.columns else with_size(df)
    total = F.col("msg_sz") + F.col("meta_sz") + F.col("stream_sz")
    fits = F.coalesce(total <= max_bytes, F.lit(False))
    return sized.filter(fits), sized.filter(~fits)
