"""Queries over delivered records, and reconciliation with what was sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stream_key


def select_stream(
    df: DataFrame,
    matchers: Mapping[str, str],
    end_ns: int | None = None,
    limit: int | None = None,
    direction: str = "forward",
    order: str = "seq",
) -> DataFrame:
    """Records whose labels equal the matchers, before a time, the first ``limit`` in time order.

    Order and limit together are planned as a top-k, not as a full sort. ``order`` breaks ties and
    also decides when records with the same nanosecond compete for the last places.
    """
    ns = F.col("ts_ms") * 1_000_000 + F.col("nanos_in_ms")
    for name, value in matchers.items():
        # a label that is missing equals the empty value
        df = df.filter(F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit("")) == value)
    if end_ns is not None:
        # the first test is implied by the second, and reaches the file scan
        df = df.filter((F.col("ts_ms") <= end_ns // 1_000_000) & (ns < end_ns))
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction: {direction}")
    by = [ns.asc(), F.col(order).asc()] if direction == "forward" else [ns.desc(), F.col(order).desc()]
    df = df.orderBy(*by)
    return df if limit is None else df.limit(limit)


def drop_labels(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove labels, which merges streams; an existing stream key is computed anew."""
    kept = F.map_filter("labels", lambda k, _: ~k.isin(list(names)))
    df = df.withColumn("labels", kept)
    return df.withColumn("stream_key", stream_key("labels")) if "stream_key" in df.columns else df


#: What makes two records the same.
CONTENT = ["stream_key", "ts_ms", "nanos_in_ms", "line", "_metadata"]


def _content(df: DataFrame) -> DataFrame:
    return df.select(
        stream_key("labels").alias("stream_key"), "ts_ms", "nanos_in_ms", "line", stream_key("metadata").alias("_metadata")
    )


def reconcile(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """Per stream: records sent, stored, missing (sent, not stored) and extra, as multisets.

    Both sides are tagged, united and grouped by content once, in place of two set differences and
    a join; the counts per stream are then partial sums.
    """
    return _balance(_content(sent), _content(stored))


def _balance(sent: DataFrame, stored: DataFrame) -> DataFrame:
    def side(df: DataFrame, n_sent: int) -> DataFrame:
        return df.select(*CONTENT, F.lit(n_sent).alias("_sent"), F.lit(1 - n_sent).alias("_stored"))

    balance = (
        side(sent, 1)
        .unionAll(side(stored, 0))
        .groupBy(*CONTENT)
        .agg(F.sum("_sent").alias("_sent"), F.sum("_stored").alias("_stored"))
    )
    gap = F.col("_sent") - F.col("_stored")
    return balance.groupBy("stream_key").agg(
        F.sum("_sent").alias("sent"),
        F.sum("_stored").alias("stored"),
        F.sum(F.greatest(gap, F.lit(0))).alias("missing"),
        F.sum(F.greatest(-gap, F.lit(0))).alias("extra"),
    )


def bucket_digests(df: DataFrame, bucket_ms: int) -> DataFrame:
    """(stream_key, bucket, n, digest_a, digest_b): a digest of the multiset of records per stream and time bucket.

    Sums of two independent 64-bit hashes: they do not depend on the order, add up over buckets, and are
    partial sums in Spark. Written beside the payloads when they are sent, they spare the next
    reconciliation a pass over that side.
    """
    hashed = [F.sum(F.xxhash64(*CONTENT, *salt).cast("decimal(38,0)")) for salt in ((), (F.lit("second"),))]
    return _content(df).groupBy("stream_key", _bucket(bucket_ms).alias("bucket")).agg(
        F.count("*").alias("n"), hashed[0].alias("digest_a"), hashed[1].alias("digest_b")
    )


def _bucket(bucket_ms: int) -> Column:
    return F.floor(F.col("ts_ms") / F.lit(bucket_ms)).cast("bigint")


def _differing(sent: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose digests differ, or that only one side has (null keys equal each other)."""
    marks = ("n", "digest_a", "digest_b")
    tell = lambda df, sign: df.groupBy(*keys).agg(*[(F.sum(m) * sign).alias(m) for m in marks])
    both = tell(sent, 1).unionAll(tell(stored, -1)).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in marks])
    return both.where(" or ".join(f"{m} <> 0" for m in marks)).select(*keys)


def reconcile_by_digest(
    sent: DataFrame, stored: DataFrame, bucket_ms: int = 3_600_000, sent_digests: DataFrame | None = None, stored_digests: DataFrame | None = None
) -> DataFrame:
    """``reconcile``, which compares records only where digests differ: by stream, then by time bucket.

    ``sent_digests`` and ``stored_digests`` may give ``bucket_digests`` of the sides, for the same bucket
    width; they are used three times, so give written tables. The span of the differing buckets becomes
    a filter on time that reaches the scan; within it, records of other buckets are dropped before
    the shuffle. Runs two small jobs to find the span.
    """
    a = bucket_digests(sent, bucket_ms) if sent_digests is None else sent_digests
    b = bucket_digests(stored, bucket_ms) if stored_digests is None else stored_digests
    streams = _differing(a, b, ["stream_key"])
    streams = streams.select(F.col("stream_key").alias("_of"))
    within = lambda df: df.join(streams, F.col("stream_key").eqNullSafe(F.col("_of")), "left_semi")
    buckets = _differing(within(a), within(b), ["stream_key", "bucket"])
    first, last, loose = buckets.agg(F.min("bucket"), F.max("bucket"), F.count_if(F.col("bucket").isNull())).first()
    totals = a.groupBy("stream_key").agg(F.sum("n").alias("sent")).unionByName(b.groupBy("stream_key").agg(F.sum("n").alias("stored")), allowMissingColumns=True)
    totals = totals.groupBy("stream_key").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("sent", "stored")])
    if first is None and not loose:
        zero = F.lit(0).cast("bigint")
        return totals.withColumns({"missing": zero, "extra": zero})
    span = F.lit(False)
    if first is not None:
        span = (F.col("ts_ms") >= first * bucket_ms) & (F.col("ts_ms") < (last + 1) * bucket_ms)
    if loose:
        span = span | F.col("ts_ms").isNull()
    wanted = buckets.select(F.col("stream_key").alias("_of"), F.col("bucket").alias("_in"))

    def part(df: DataFrame) -> DataFrame:
        rows = _content(df.where(span)).withColumn("_bucket", _bucket(bucket_ms))
        return rows.join(wanted, F.col("stream_key").eqNullSafe(F.col("_of")) & F.col("_bucket").eqNullSafe(F.col("_in")), "left_semi")

    gaps = _balance(part(sent), part(stored)).select(F.col("stream_key").alias("_of"), "missing", "extra")
    joined = totals.join(gaps, F.col("stream_key").eqNullSafe(F.col("_of")), "left")
    return joined.select("stream_key", "sent", "stored", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("missing", "extra")])
