"""Delivery as tables: retry delays, classification of attempts, outcomes, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import MAX_BACKOFF_MS, MAX_JITTER_MS, MAX_RETRIES, MIN_BACKOFF_MS

# Failures worth another try, of JVM senders and of Python transports.
RETRY_EXCEPTIONS = (
    "ConnectException",
    "HttpHostConnectException",
    "HttpTimeoutException",
    "HttpConnectTimeoutException",
    "ConnectionRefusedError",
    "TimeoutError",
)
UNAVAILABLE = 503
RATE_LIMITED = 429


def retry_delay(retry: Column | str, min_ms: int = MIN_BACKOFF_MS, max_ms: int = MAX_BACKOFF_MS) -> Column:
    """Delay before the n-th retry (from 1): doubling from ``min_ms``, capped at ``max_ms``."""
    retry = F.col(retry) if isinstance(retry, str) else retry
    # 2**62 is beyond any cap, so a larger power need not be computed
    doubled = F.lit(min_ms) * F.pow(F.lit(2.0), F.least(retry - 1, F.lit(62)))
    return F.least(doubled, F.lit(float(max_ms))).cast("bigint")


def retry_schedule(
    df: DataFrame,
    min_ms: int = MIN_BACKOFF_MS,
    max_ms: int = MAX_BACKOFF_MS,
    n: int | Column = MAX_RETRIES,
    max_jitter_ms: int = 0,
    seed: int | None = None,
) -> DataFrame:
    """The retries of each batch with their delays; the schedule restarts for every batch."""
    count = F.lit(n) if isinstance(n, int) else n
    rows = df.withColumn(
        "retry", F.explode(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")))
    )
    delay = retry_delay("retry", min_ms, max_ms)
    if max_jitter_ms:
        delay = delay + F.floor(F.rand(seed) * max_jitter_ms)
    return rows.withColumn("delay_ms", delay)


def classify_attempts(
    attempts: DataFrame,
    keys: Sequence[str] = (),
    max_retries: int = MAX_RETRIES,
    drop_rate_limited: bool = False,
    sticky: bool = True,
    retry_exceptions: Sequence[str] = RETRY_EXCEPTIONS,
) -> DataFrame:
    """Judge each attempt of a batch: ordinal (from 0), success, retryable, reason, whether it is made at all.

    Attempts stop after the first success, after a failure that is not retryable, and after
    ``max_retries`` more than the first. With ``sticky`` an exception (or status) seen earlier stays
    in force for later attempts of the batch; otherwise each attempt is judged alone. The window
    runs inside one batch, which holds a handful of attempts.
    """
    batch = Window.partitionBy(*keys, "batch_no").orderBy("attempt")
    so_far = batch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = batch.rowsBetween(Window.unboundedPreceding, -1)

    def seen(c: str) -> Column:
        return F.last(c, ignorenulls=True).over(so_far) if sticky else F.col(c)

    rows = attempts.withColumns(
        {
            "_no": F.row_number().over(batch) - 1,
            "_exception": seen("exception"),
            "_status": seen("status"),
            "success": F.coalesce(
                F.col("exception").isNull() & F.col("status").between(200, 299), F.lit(False)
            ),
        }
    )
    by_status = F.col("_status") == UNAVAILABLE
    if not drop_rate_limited:
        by_status = by_status | (F.col("_status") == RATE_LIMITED)
    retryable = F.coalesce(F.col("_exception").isin(list(retry_exceptions)), F.lit(False)) | F.coalesce(
        by_status, F.lit(False)
    )
    rows = rows.withColumns(
        {
            "retryable": ~F.col("success") & retryable,
            "reason": F.when(
                ~F.col("success"),
                F.coalesce(
                    F.concat(F.lit("exception:"), F.col("_exception")),
                    F.concat(F.lit("status:"), F.col("_status").cast("string")),
                ),
            ),
        }
    )
    goes_on = F.col("retryable") & (F.col("_no") < max_retries)
    made = F.coalesce(F.every(goes_on).over(earlier), F.lit(True))
    return rows.withColumn("made", made).withColumnRenamed("_no", "ordinal").drop("_exception", "_status")


def delivery_outcomes(classified: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per batch: state (delivered or dropped), retries used, and the reason of a drop."""
    last = F.max_by(F.struct("success", "reason"), "attempt")
    return (
        classified.filter("made")
        .groupBy(*keys, "batch_no")
        .agg(F.count("*").alias("sends"), last.alias("_last"))
        .select(
            *keys,
            "batch_no",
            F.when(F.col("_last.success"), "delivered").otherwise("dropped").alias("state"),
            (F.col("sends") - 1).alias("retries"),
            F.col("_last.reason").alias("reason"),
        )
    )


def dead_letters(payloads: DataFrame, outcomes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Payloads that were not delivered, kept instead of lost."""
    delivered = outcomes.filter(F.col("state") == "delivered")
    return payloads.join(delivered, [*keys, "batch_no"], "left_anti")


__all__ = [
    "MAX_JITTER_MS", "RETRY_EXCEPTIONS", "classify_attempts", "dead_letters", "delivery_outcomes",
    "retry_delay", "retry_schedule",
]
