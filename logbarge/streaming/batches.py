"""Batch cutting over a stream: count, bytes, and the idle drain by wall clock."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor

from ..operators.cutting import DRAIN, OPEN, Limits, Run, batches
from ..operators.grouping import prepared
from ..operators.sizing import known
from ..settings import MAX_BYTES, MAX_ITEMS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Rows that leave a task as one pandas frame.
OUT_ROWS = 10_000


class Packed:
    """Rows in Arrow buffers, which take a fraction of what they do as Python objects.

    Rows come in frame by frame and are read back by their places. Texts of the ``repeated`` columns are held
    once each. Columns of other types than text, numbers and booleans stay in pandas.
    """

    def __init__(self, schema: T.StructType, repeated: Sequence[str]):
        self.types = {
            f.name: pa.large_string() if isinstance(f.dataType, T.StringType)
            else to_arrow_type(f.dataType) if isinstance(f.dataType, (T.IntegralType, T.FractionalType, T.BooleanType)) and not isinstance(f.dataType, T.DecimalType)
            else None
            for f in schema.fields
        }
        self.repeated = {c for c in repeated if self.types[c] == pa.large_string()}
        self.parts: dict[str, list] = {c: [] for c in self.types}
        self.columns: dict[str, pa.Array | pd.Series] = {}
        self.rows = 0

    def add(self, rows: pd.DataFrame) -> None:
        self.rows += len(rows)
        for name, kind in self.types.items():
            part = rows[name] if kind is None else pa.Array.from_pandas(rows[name], type=kind)
            self.parts[name].append(part.dictionary_encode() if name in self.repeated else part)

    def closed(self) -> Packed:
        """One array per column; no rows can be added any more."""
        for name, kind in self.types.items():
            parts = self.parts.pop(name)
            if kind is None:
                self.columns[name] = pd.concat(parts, ignore_index=True)
                continue
            found = pa.chunked_array(parts)
            self.columns[name] = pa.concat_arrays((found.unify_dictionaries() if name in self.repeated else found).chunks)
            del parts, found
        return self

    def numbers(self, name: str) -> np.ndarray:
        return self.columns[name].to_numpy(zero_copy_only=False)

    def codes(self, name: str) -> np.ndarray:
        """Numbers that are equal where the texts of a repeated column are; a null one has its own."""
        return self.columns[name].indices.fill_null(-1).to_numpy(zero_copy_only=False)

    def _taken(self, name: str, places: np.ndarray) -> pa.Array | pd.Series:
        column = self.columns[name]
        if isinstance(column, pd.Series):
            return column.iloc[places]
        taken = column.take(pa.array(places))
        return taken.dictionary_decode() if name in self.repeated else taken

    def frame(self, places: np.ndarray) -> pd.DataFrame:
        taken = {name: self._taken(name, places) for name in self.types}
        return pd.DataFrame({
            n: c.reset_index(drop=True) if isinstance(c, pd.Series) else c.to_pandas(integer_object_nulls=True) for n, c in taken.items()
        })

    def tuples(self, places: np.ndarray) -> list[tuple]:
        taken = (self._taken(name, places) for name in self.types)
        return list(zip(*(c.tolist() if isinstance(c, pd.Series) else c.to_pylist() for c in taken), strict=True))


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Make RocksDB the session's state store, which transformWithState needs."""
    spark.conf.set(PROVIDER, ROCKSDB)
    return spark


class OpenBatch(StatefulProcessor):
    """One open batch per shard.

    State: the records of the open batch (at most ``max_items`` or ``max_bytes`` of them), the number
    of the next batch, and the time of the last cut. Bytes and streams follow from the records.
    """

    def __init__(self, schema: T.StructType, out: T.StructType, keys: Sequence[str], order: str,
                 limits: Limits):
        self.schema, self.out, self.keys, self.order, self.limits = schema, out, list(keys), order, limits

    def init(self, handle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", self.schema)
        self.cursor = handle.getValueState("cursor", "next_batch bigint, last_cut bigint")

    def handleInitialState(self, key, initialState, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs() if self.limits.timeout_ms is not None else 0
        self.cursor.update((int(initialState["next_batch"].iloc[0]), now))

    def handleInputRows(self, key, rows, timerValues):
        kept = [tuple(r) for r in self.records.get()] if self.records.exists() else []
        pending = Packed(self.schema, dict.fromkeys([*self.keys, "labels", "stream_key"]))
        if kept:
            pending.add(pd.DataFrame(kept, columns=self.schema.names))
        for some in rows:
            pending.add(some)
        pending.closed()
        # arrival order inside one trigger is the order column
        fresh = len(kept) + np.argsort(pending.numbers(self.order)[len(kept):], kind="stable")
        places = np.concatenate([np.arange(len(kept)), fresh])
        now = timerValues.getCurrentProcessingTimeInMs() if self.limits.timeout_ms is not None else 0
        number, last_cut = self.cursor.get() if self.cursor.exists() else (0, now)

        own_bytes = pending.numbers("msg_sz") + pending.numbers("meta_sz")
        run = Run(own_bytes[places], pending.codes("stream_key")[places], pending.numbers("stream_sz")[places])
        by_size = Limits(self.limits.max_items, self.limits.max_bytes)
        first, whys, sizes, at = number, [], [], 0
        for begin, end, why in batches(run, 0, len(run), None, by_size):
            if why == OPEN:
                break
            whys.append(why)
            sizes.append(end - begin)
            number, at, last_cut = number + 1, end, now
        held = len(kept) if not at else 0
        self._keep(pending.tuples(places[at + held:]), number, last_cut, held)
        batch_of = np.repeat(np.arange(len(sizes)), np.array(sizes, dtype=np.int64))
        for begin in range(0, at, OUT_ROWS):
            of = batch_of[begin:begin + OUT_ROWS]
            yield self._closed(pending.frame(places[begin:begin + len(of)]), first + of, [whys[b] for b in of])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.records.exists():
            return
        number, _ = self.cursor.get()
        rows = pd.DataFrame([tuple(r) for r in self.records.get()], columns=self.schema.names)
        self._keep([], number + 1, timerValues.getCurrentProcessingTimeInMs())
        yield self._closed(rows, np.full(len(rows), number), np.full(len(rows), DRAIN))

    def close(self) -> None:
        pass

    def _keep(self, rows: list[tuple], number: int, last_cut: int, held: int = 0) -> None:
        """Hold ``rows`` behind the ``held`` ones that are in state already and stay."""
        if not held and self.records.exists():
            self.records.clear()
        if rows:
            self.records.appendList(rows)
        self.cursor.update((int(number), int(last_cut)))
        if self.limits.timeout_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if rows or held:
                # the drain fires once the timeout is exceeded, not when it is reached
                self.handle.registerTimer(int(last_cut) + self.limits.timeout_ms + 1)

    def _closed(self, rows: pd.DataFrame, numbers, whys) -> pd.DataFrame:
        return rows.assign(batch_no=np.asarray(numbers, dtype=np.int64), condition=list(whys))[self.out.names]


def drain_open(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The batches still open when a stream was stopped, as rows of ``cut_batches_stream``: condition DRAIN.

    Reads the stopped query's state as a table, so shards are drained in parallel. Union it with the
    closed batches; leave it out to lose what was never closed.
    """

    def state(variable: str) -> DataFrame:
        reader = spark.read.format("statestore").option("stateVarName", variable)
        return reader.load(checkpoint)

    shard = [F.col(f"key.{k}").alias(f"_{k}") for k in keys]
    records = state("records").select(F.col("list_element.*"))
    cursor = state("cursor").select(*shard, F.col("value.next_batch").alias("batch_no"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    out = records.join(cursor, same).drop(*(f"_{k}" for k in keys)).withColumn("condition", F.lit(DRAIN))
    maps = [c for c in ("labels", "metadata") if c in out.columns]
    return out.withColumns({m: F.from_json(m, "map<string,string>") for m in maps})


def next_batches(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """(keys, next_batch) of a stopped stream, behind its drained batches: what a new one goes on with."""
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    shard = [F.col(f"key.{k}").alias(k) for k in keys]
    numbers = read("cursor").select(*shard, F.col("value.next_batch").alias("next_batch"), F.lit(0).alias("open"))
    still = read("records").select(*shard, F.lit(0).cast("bigint").alias("next_batch"), F.lit(1).alias("open"))
    return numbers.unionByName(still).groupBy(*keys).agg((F.max("next_batch") + F.max("open")).alias("next_batch"))


def cut_batches_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "seq",
    max_items: int = MAX_ITEMS,
    max_bytes: int = MAX_BYTES,
    timeout_ms: int | None = None,
    lanes: int = 1,
    continues: DataFrame | None = None,
) -> DataFrame:
    """``cut_batches`` for a stream of records; closed batches are emitted in append mode.

    ``timeout_ms`` drains an open batch when more wall-clock time has passed since the last cut
    (choose a processing-time trigger, which sets how often it is checked). Without it an open batch
    waits for more records; ``drain_open`` gives what is open when the stream has stopped.

    ``continues`` (see ``next_batches``) hands the batch numbers of a drained stream over to a new one with
    a checkpoint of its own, so that they have no gap.

    Set records without order, time, line or labels aside first (``split_bad``): one without a size ends
    the query. A null key is a shard like any other. ``ParallelCut`` does both, and cuts a hot shard in
    parallel.

    A stream is batched per shard, one after the other. ``lanes`` splits every shard into that many
    independent sequences by a hash of the order column, so that a hot shard is not bound to one
    task; a ``lane`` column joins the keys. A task holds the rows of one key and trigger at a time, in
    Arrow buffers, so the source's rate limit bounds its memory. Needs the RocksDB state store, which the session has to
    name (``use_rocksdb``).
    """
    if df.sparkSession.conf.get(PROVIDER, None) != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}, or call use_rocksdb")
    records = prepared(df).withColumns({c: known(F.col(c)) for c in ("msg_sz", "meta_sz", "stream_sz")})
    keys = list(keys)
    if lanes > 1:
        records = records.withColumn("lane", F.pmod(F.xxhash64(order), F.lit(lanes)).cast("int"))
        keys.append("lane")
    # maps travel through state as canonical text
    maps = [f.name for f in records.schema.fields if isinstance(f.dataType, T.MapType)]
    flat = records.withColumns({m: F.to_json(m) for m in maps})
    out = T.StructType(
        [*flat.schema.fields, T.StructField("batch_no", T.LongType()), T.StructField("condition", T.StringType())]
    )
    cut = flat.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=OpenBatch(flat.schema, out, keys, order, Limits(max_items, max_bytes, timeout_ms)),
        outputStructType=out,
        outputMode="Append",
        timeMode="None" if timeout_ms is None else "ProcessingTime",
        initialState=None if continues is None else continues.select(*keys, "next_batch").groupBy(*keys),
    )
    return cut.withColumns({m: F.from_json(m, "map<string,string>") for m in maps})
