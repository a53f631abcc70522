"""Counters of the flow as tables. All are partial aggregates; only group rows are shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..settings import BLOCK_ROWS
from .position import with_position


def _summary(prefix: str, c: Column | str) -> list[Column]:
    return [
        F.count(c).alias(f"{prefix}_count"),
        F.sum(c).alias(f"{prefix}_total"),
        F.max(c).alias(f"{prefix}_max"),
    ]


def delivery_metrics(
    payloads: DataFrame,
    outcomes: DataFrame | None = None,
    name: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Batches, events and bytes encoded and sent, each as count, total and maximum.

    Events and bytes of the encoder are separate metrics. ``name`` are the columns to report by.
    """
    df = payloads
    if outcomes is not None:
        states = outcomes.select(*keys, "batch_no", "state")
        df = df.join(states, [*keys, "batch_no"], "left")
    sent = F.col("state") == "delivered" if outcomes is not None else F.lit(True)
    return df.groupBy(*name).agg(
        F.count("*").alias("encoded_batches"),
        *_summary("encoded_events", "items"),
        *_summary("encoded_bytes", "size_bytes"),
        F.count_if(sent).alias("sent_batches"),
        *_summary("sent_bytes", F.when(sent, F.col("size_bytes"))),
    )


#: Size of a quantile sketch; its ranks are off by less than ``rank_error`` of it.
SKETCH = 2048


def rank_error(k: int = SKETCH) -> float:
    """Share of the values by which a quantile's rank may be off, for 99 of 100 sketches of this size."""
    return 2.3 / k**0.9


def distributions(
    df: DataFrame, metrics: Mapping[str, Column | str], by: Sequence[str] = (), window_ms: int | None = None, ts_ms: str = "ts_ms", k: int = SKETCH
) -> DataFrame:
    """(by, window_ms, metric, sketch): quantile sketches of whole-number metrics, per window of time if wanted.

    Sketches are of bounded size, are built on the map side and merge: those of small windows, stored as a
    table, give any larger window without another look at the data. Nulls are not counted.
    """
    groups = list(by)
    if window_ms is not None:
        df = df.withColumn("window_ms", F.col(ts_ms) - F.pmod(F.col(ts_ms), F.lit(window_ms)))
        groups.append("window_ms")
    sketched = df.groupBy(*groups).agg(*[
        F.kll_sketch_agg_bigint((F.col(c) if isinstance(c, str) else c).cast("bigint"), k).alias(name) for name, c in metrics.items()
    ])
    each = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").alias("sketch")) for name in metrics])
    return sketched.select(*groups, F.inline(each)).where(F.kll_sketch_get_n_bigint("sketch") > 0)


def merge_distributions(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH) -> DataFrame:
    """Fewer groups from the sketches of more."""
    return sketches.groupBy(*by, "metric").agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, at: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """The groups of ``sketches`` with n (values seen), quantile and value, one row per quantile."""
    groups = [c for c in sketches.columns if c != "sketch"]
    each = [F.struct(F.lit(q).cast("double").alias("quantile"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias("value")) for q in at]
    return sketches.select(*groups, F.kll_sketch_get_n_bigint("sketch").alias("n"), F.inline(F.array(*each)))


def observe_payloads(payloads: DataFrame, observation: Observation | str) -> DataFrame:
    """The same counters while the payloads pass by, with no job of their own."""
    return payloads.observe(
        observation,
        F.count("*").alias("encoded_batches"),
        *_summary("encoded_events", "items"),
        *_summary("encoded_bytes", "size_bytes"),
    )


def error_counts(
    df: DataFrame, stage: str, reason: str = "reason", name: Sequence[str] = ()
) -> DataFrame:
    """Failures of a stage (append, encode, retry, send) by reason."""
    failed = df.filter(F.col(reason).isNotNull())
    return failed.groupBy(*name, F.lit(stage).alias("stage"), F.col(reason).alias("reason")).agg(
        F.count("*").alias("errors")
    )


def attempt_errors(
    classified: DataFrame, outcomes: DataFrame, max_retries: int, name: Sequence[str] = ()
) -> DataFrame:
    """Retry errors (a failure that is tried again) and send errors (a batch given up), by reason."""
    again = classified.filter(F.col("made") & F.col("retryable") & (F.col("ordinal") < max_retries))
    gone = outcomes.filter(F.col("state") == "dropped")
    return error_counts(again, "retry", name=name).unionByName(error_counts(gone, "send", name=name))


def dropped_counts(rejected: DataFrame, name: Sequence[str] = ()) -> DataFrame:
    """Records that were refused."""
    return rejected.groupBy(*name).agg(F.count("*").alias("dropped_events"))


def unsent(batches: DataFrame, outcomes: DataFrame, keys: Sequence[str] = (), items: str = "items") -> DataFrame:
    """Accepted records that are neither sent nor given up, per shard."""
    open_batches = batches.join(outcomes.select(*keys, "batch_no"), [*keys, "batch_no"], "left_anti")
    total = F.coalesce(F.sum(items), F.lit(0)).alias("unsent_events")
    return open_batches.groupBy(*keys).agg(total)


# Fixed values: (last count, step) of the thinned report; beyond RESTART the count starts anew.
THIN_STEPS = (
    (90, 20),
    (900, 100),
    (900_000, 1_000),
    (9_000_000, 10_000),
    (900_000_000, 1_000_000),
)
RESTART = 1_000_000_000


def thin_by_count(
    df: DataFrame, keys: Sequence[str] = (), order: str = "seq", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Keep the first row of each key and ever rarer ones after it; adds the running ``count``.

    Only keys and order are numbered; the few rows kept are joined with the table by them.
    """
    narrow = df.select(*keys, order)
    counted = with_position(narrow, order, keys, block_rows).withColumn(
        "count", F.col("pos") % (RESTART + 1) + 1
    )
    keep = (F.col("count") == 1) | (F.col("count") > RESTART)
    for last, step in THIN_STEPS:
        keep = keep | ((F.col("count") <= last) & (F.col("count") % step == 0))
    kept = counted.filter(keep).drop("pos", "shard_rows")
    return df.join(kept, [*keys, order]).select(*df.columns, "count")
