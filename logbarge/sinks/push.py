"""Delivery of payloads through a transport, with retries.

The transport is any picklable callable ``(body: bytes, headers: dict) -> (status, text)``, which may
raise. It runs in Spark tasks, one payload per call. For tables waiting between retries is per task; on
a stream (``push_attempts_stream``) a payload waits in state and holds no core.

Each payload carries (run, shard, batch) as an idempotency key. A task that runs again would send its
payloads again; with a ``Ledger`` it skips those that are delivered. Speculative copies of tasks run at
the same time and must be off.
"""

from __future__ import annotations

import base64
import random
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)

from pyspark.sql.streaming import StatefulProcessor

from ..operators.delivery import RATE_LIMITED, UNAVAILABLE
from ..schemas import ATTEMPT_FIELDS
from ..settings import MAX_BACKOFF_MS, MAX_JITTER_MS, MAX_RETRIES, MIN_BACKOFF_MS
from .ledger import Ledger

Transport = Callable[[bytes, dict], tuple[int, str]]

# Content types and header names of the push request.
JSON_TYPE = "application/json"
PROTO_TYPE = "application/x-protobuf"
CONTENT_TYPE = "Content-Type"
TENANT = "X-Scope-OrgID"
AUTHORIZATION = "Authorization"
IDEMPOTENCY = "Idempotency-Key"
ATTEMPT = "Retry-Attempt"


@dataclass(frozen=True)
class PushOptions:
    payload: str = "payload_json"
    keys: tuple[str, ...] = ()
    tenant: str | None = None
    username: str | None = None
    password: str | None = None
    max_retries: int = MAX_RETRIES
    min_ms: int = MIN_BACKOFF_MS
    max_ms: int = MAX_BACKOFF_MS
    jitter_ms: int = MAX_JITTER_MS
    drop_rate_limited: bool = False
    # only failures to connect or in time: after others the store may have taken the batch
    retry_on: tuple[type[Exception], ...] = (ConnectionRefusedError, TimeoutError)
    # batch numbers start anew in every run, so a store that honours the key needs the run as well
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def headers(self, row: dict) -> dict[str, str]:
        binary = isinstance(row[self.payload], (bytes, bytearray))
        out = {
            CONTENT_TYPE: PROTO_TYPE if binary else JSON_TYPE,
            IDEMPOTENCY: "/".join((self.run_id, *(str(row[k]) for k in (*self.keys, "batch_no")))),
        }
        tenant = row.get("tenant") or self.tenant
        if tenant:
            out[TENANT] = tenant
        if self.username is not None and self.password is not None:
            token = base64.b64encode(f"{self.username}:{self.password}".encode()).decode()
            out[AUTHORIZATION] = f"Basic {token}"
        return out

    def delay_ms(self, retry: int) -> int:
        jitter = random.randrange(self.jitter_ms) if self.jitter_ms > 0 else 0
        return min(self.min_ms << min(retry - 1, 62), self.max_ms) + jitter


@dataclass
class Sending:
    """One payload on its way. A failure seen once stays in force for later tries."""

    body: bytes
    headers: dict[str, str]
    options: PushOptions
    attempt: int = 0
    status: int | None = None
    retry_error: bool = False

    @classmethod
    def of(cls, row: dict, options: PushOptions) -> Sending:
        body = row[options.payload]
        return cls(body.encode() if isinstance(body, str) else bytes(body), options.headers(row), options)

    def send(self, transport: Transport, delay: int) -> dict:
        """Make the next attempt and say how it went."""
        got, raised = None, None
        try:
            got, _ = transport(self.body, {**self.headers, ATTEMPT: str(self.attempt)})
        except Exception as e:  # noqa: BLE001 - any transport failure is an attempt result
            raised = e
        self.status = self.status if got is None else got
        self.retry_error = self.retry_error if raised is None else isinstance(raised, self.options.retry_on)
        out = {
            "attempt": self.attempt, "status": got, "exception": None if raised is None else type(raised).__name__, "delay_ms": delay,
        }
        self.attempt += 1
        return out

    def again(self, last: dict) -> bool:
        """Whether another attempt follows the last one."""
        if delivered(last) or self.attempt > self.options.max_retries:
            return False
        limited = self.status == RATE_LIMITED and not self.options.drop_rate_limited
        return self.retry_error or self.status == UNAVAILABLE or limited


def delivered(attempt: dict) -> bool:
    return attempt["status"] is not None and 200 <= attempt["status"] < 300


def deliver(row: dict, transport: Transport, options: PushOptions) -> Iterator[dict]:
    """Send one payload; yields each attempt."""
    sending, delay = Sending.of(row, options), 0
    while True:
        attempt = sending.send(transport, delay)
        yield attempt
        if not sending.again(attempt):
            return
        delay = options.delay_ms(sending.attempt)
        time.sleep(delay / 1000)


def delivered_once(row: dict, transport: Transport, options: PushOptions, ledger: Ledger | None) -> list[dict]:
    """The attempts for one payload; none if the ledger says that it is delivered."""
    key = options.headers(row)[IDEMPOTENCY]
    if ledger is not None and key in ledger:
        return []
    attempts = list(deliver(row, transport, options))
    if ledger is not None and delivered(attempts[-1]):
        ledger.add(key)
    return attempts


def attempt_schema(df: DataFrame, options: PushOptions) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in options.keys), *ATTEMPT_FIELDS])


def wanted_columns(df: DataFrame, options: PushOptions) -> list[str]:
    return list(dict.fromkeys([*options.keys, "batch_no", options.payload, *(["tenant"] if "tenant" in df.columns else [])]))


def push_attempts(
    df: DataFrame, transport: Transport, options: PushOptions | None = None, ledger: Ledger | None = None
) -> DataFrame:
    """Send every payload and return the attempts made: keys, batch_no, attempt, status, exception.

    Sending happens when the result is computed, so write it to a table and read that. Payloads that
    the ledger has make no attempt.
    """
    options = options or PushOptions()
    names = [*options.keys, "batch_no"]
    schema = attempt_schema(df, options)

    def send(parts):
        for part in parts:
            rows = [
                {**{n: row[n] for n in names}, **attempt}
                for row in part.to_dict("records")
                for attempt in delivered_once(row, transport, options, ledger)
            ]
            out = pd.DataFrame(rows, columns=schema.names)
            out["status"] = out["status"].astype("Int32")
            yield out
        if ledger is not None:
            ledger.flush()

    return df.select(*wanted_columns(df, options)).mapInPandas(send, schema)


@dataclass
class Delivered(WriterCommitMessage):
    batches: int
    attempts: int
    skipped: int = 0


def push_sink(
    transport: Transport, options: PushOptions | None = None, name: str = "log_push", fail: bool = False, ledger: Ledger | None = None
) -> type[DataSource]:
    """A data source for ``df.write.format(name)`` and ``df.writeStream.format(name)``.

    Register it with ``spark.dataSource.register``. ``fail`` raises for an undelivered batch;
    by default it is given up after the last retry, as ``push_attempts`` would report.

    With a ledger, tasks note each delivery as it happens. The commit of the write, or of a stream's
    trigger, adds its totals to the ledger; an aborted write leaves the notes, so that running it again
    under the same ``run_id`` sends only what is missing.
    """

    options = options or PushOptions()

    class Writer(DataSourceWriter, DataSourceStreamWriter):
        def write(self, iterator):
            sent = tries = skipped = 0
            for row in iterator:
                attempts = delivered_once(row.asDict(), transport, options, ledger)
                if fail and attempts and not delivered(attempts[-1]):
                    raise RuntimeError(f"batch not delivered: {attempts[-1]}")
                sent, tries, skipped = sent + bool(attempts), tries + len(attempts), skipped + (not attempts)
            if ledger is not None:
                ledger.flush()
            return Delivered(sent, tries, skipped)

        def commit(self, messages, batchId=None):
            self.close("committed", messages, batchId)

        def abort(self, messages, batchId=None):
            self.close("aborted", messages, batchId)

        def close(self, state, messages, trigger):
            if ledger is not None:
                done = [m for m in messages if m is not None]
                ledger.close(options.run_id, state, trigger, *(sum(getattr(m, f) for m in done) for f in ("batches", "attempts", "skipped")))

    class PushSink(DataSource):
        @classmethod
        def name(cls):
            return name

        def writer(self, schema, overwrite):
            return Writer()

        def streamWriter(self, schema, overwrite):
            return Writer()

    return PushSink


def write_push(
    df: DataFrame,
    transport: Transport,
    options: PushOptions | None = None,
    attempts_path: str | None = None,
    ledger: Ledger | None = None,
) -> None:
    """Send every payload now. With ``attempts_path`` the attempts are kept as a table."""
    if attempts_path is not None:
        push_attempts(df, transport, options, ledger).write.mode("append").parquet(attempts_path)
        return
    sink = push_sink(transport, options, ledger=ledger)
    df.sparkSession.dataSource.register(sink)
    df.write.format(sink.name()).mode("append").save()


class RetryQueue(StatefulProcessor):
    """A payload between its attempts: its columns, how it went so far, and a timer for the next one."""

    def __init__(self, columns: T.StructType, out: T.StructType, transport: Transport, options: PushOptions):
        self.columns, self.out, self.transport, self.options = columns, out, transport, options
        self.state = T.StructType([
            *columns.fields, T.StructField("_attempt", T.IntegerType()), T.StructField("_status", T.IntegerType()),
            T.StructField("_retry_error", T.BooleanType()), T.StructField("_delay", T.LongType()),
        ])

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", self.state)

    def handleInputRows(self, key, rows, timerValues):
        for part in rows:
            for row in part.to_dict("records"):
                # one that waits already is the same payload, read again
                if not self.waiting.exists():
                    yield self._attempt(row, Sending.of(row, self.options), 0, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.waiting.exists():
            return
        *values, attempt, status, retry_error, delay = self.waiting.get()
        row = dict(zip(self.columns.names, values, strict=True))
        sending = Sending.of(row, self.options)
        sending.attempt, sending.status, sending.retry_error = attempt, status, retry_error
        yield self._attempt(row, sending, delay, timerValues)

    def close(self) -> None:
        pass

    def _attempt(self, row: dict, sending: Sending, delay: int, timerValues) -> pd.DataFrame:
        made = sending.send(self.transport, delay)
        if sending.again(made):
            delay = self.options.delay_ms(sending.attempt)
            values = (row[n] for n in self.columns.names)
            self.waiting.update((*values, sending.attempt, sending.status, sending.retry_error, delay))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + delay)
        else:
            self.waiting.clear()
        out = pd.DataFrame([{**{n: row[n] for n in (*self.options.keys, "batch_no")}, **made}], columns=self.out.names)
        out["status"] = out["status"].astype("Int32")
        return out


def push_attempts_stream(df: DataFrame, transport: Transport, options: PushOptions | None = None) -> DataFrame:
    """``push_attempts`` for a stream of payloads: attempts in append mode, without waiting in tasks.

    A payload to be sent again is kept in state with a timer for the time it is due, so others go on
    meanwhile, however long a store is down. Choose a processing-time trigger: it sets how late a retry
    may be. Needs the RocksDB state store (``use_rocksdb``). State holds the waiting payloads only.
    """
    options = options or PushOptions()
    payloads = df.select(*wanted_columns(df, options))
    out = attempt_schema(df, options)
    return payloads.groupBy(*options.keys, "batch_no").transformWithStateInPandas(
        statefulProcessor=RetryQueue(payloads.schema, out, transport, options), outputStructType=out, outputMode="Append", timeMode="ProcessingTime",
    )


__all__: Sequence[str] = ["PushOptions", "deliver", "push_attempts", "push_attempts_stream", "push_sink", "write_push"]
