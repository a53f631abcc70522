"""Cutting the ordered records of a shard into bounded batches.

``cut_by_count`` is pure Columns. ``cut_batches`` also bounds bytes and idle time, which makes each
batch depend on where the one before it ended. One task per shard would be exact but would put a hot
shard on one core, so the fold is split exactly:

1. Rows get their position in the shard (``with_position``) and are dealt into chunks of
   ``chunk_rows`` positions. A chunk also sees the first ``max_items`` rows of the next one, so
   every batch that starts in a chunk can be completed there.
2. A batch reaches at most ``max_items`` rows into the next chunk, so a chunk is fully described by
   a table of that many entries: entry state -> exit state, batches started. All chunks of shards
   with more than one compute theirs at the same time.
3. Tables compose. Groups of ``GROUP_CHUNKS`` chunks are composed in parallel, one short walk per
   shard over the groups and one per group over its chunks give the entry state of every chunk.
4. With its entry state each chunk cuts its own rows, again in parallel.

Only narrow columns (key, order, sizes, stream key) take part; the records are joined once at the
end on (shard, order), which is unique and so cannot be skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import stream_key
from ..settings import BLOCK_ROWS, MAX_BYTES, MAX_ITEMS
from .cutting import BYTES, DRAIN, ITEMS, OPEN, Limits, Run, batches, compose, transfer
from .position import with_position
from .sizing import known, with_size

# The functions handed to applyInArrow carry no annotations: Spark reads them as eval-type hints.
GROUP_CHUNKS = 1024


def cut_by_count(
    df: DataFrame,
    keys: Sequence[str] = (),
    order: str = "seq",
    max_items: int = MAX_ITEMS,
    drain_on_stop: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Batches of ``max_items`` records; adds batch_no and condition. A repeated order value is an error.

    Batches bound records, not bytes: set oversize records aside first where lines may be long.
    """
    placed = with_position(df, order, keys, block_rows, unique=True)
    full = (F.expr(f"pos div {max_items}") + 1) * max_items <= F.col("shard_rows")
    out = placed.withColumns(
        {
            "batch_no": F.expr(f"pos div {max_items}"),
            "condition": F.when(full, ITEMS).otherwise(DRAIN),
        }
    ).drop("pos", "shard_rows")
    return out if drain_on_stop else out.filter(F.col("condition") != DRAIN)


def cut_batches(
    df: DataFrame,
    keys: Sequence[str] = (),
    order: str = "seq",
    max_items: int = MAX_ITEMS,
    max_bytes: int = MAX_BYTES,
    timeout_ms: int | None = None,
    drain_on_stop: bool = True,
    chunk_rows: int = BLOCK_ROWS,
    group_chunks: int = GROUP_CHUNKS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Batches bounded by items, bytes and (with ``timeout_ms``) event time since the last cut.

    Adds batch_no, condition and stream_key. The clock starts at the first record of the shard.
    ``drain_on_stop=False`` loses the records of the last, still open batch.
    """
    records = df if "msg_sz" in df.columns else with_size(df)
    if "stream_key" not in records.columns:
        records = records.withColumn("stream_key", stream_key("labels"))
    assigned = assign_batches(
        records, keys, order, Limits(max_items, max_bytes, timeout_ms), drain_on_stop,
        chunk_rows, group_chunks, block_rows, df,
    )
    return records.join(assigned, [*keys, order])


def assign_batches(
    records: DataFrame,
    keys: Sequence[str],
    order: str,
    limits: Limits,
    drain_on_stop: bool = True,
    chunk_rows: int = BLOCK_ROWS,
    group_chunks: int = GROUP_CHUNKS,
    block_rows: int = BLOCK_ROWS,
    counted: DataFrame | None = None,
    begins: DataFrame | None = None,
    keep_open: bool = False,
) -> DataFrame:
    """The narrow half of ``cut_batches``: (keys, order, batch_no, condition).

    ``counted`` may give the same rows before their sizes are computed (see ``with_position``).
    ``begins`` continues earlier cuts: (keys, next_batch, by_items, last_ts) per shard, where the last
    two say whether the last cut was by items and the time of the record before it. ``keep_open``
    marks the records of a shard's last, still open batch with condition OPEN.
    """
    chunk_rows = max(chunk_rows, limits.max_items)
    shard = list(keys) or ["_all"]
    if begins is not None and not keys:
        begins = begins.withColumn("_all", F.lit(0))
    narrow = records.select(
        *(keys or [F.lit(0).alias("_all")]),
        F.col(order).cast("bigint").alias("_seq"),
        known(F.col("msg_sz") + F.col("meta_sz")).alias("_own"),
        known(F.col("stream_sz")).alias("_stream_sz"),
        F.col("stream_key").alias("_stream"),
        *([F.col("ts_ms").alias("_ts")] if limits.timeout_ms is not None else []),
    )
    if counted is not None:
        counted = counted.select(*(keys or [F.lit(0).alias("_all")]), F.col(order).cast("bigint").alias("_seq"))
    placed = with_position(narrow, "_seq", shard, block_rows, counted)
    if begins is not None and limits.timeout_ms is not None:
        # the record before the first one, for its time
        sizes = narrow.groupBy(*shard).agg(F.count("*").alias("shard_rows"))
        before = begins.where("last_ts is not null").join(sizes, shard)
        before = before.select(*shard, F.col("last_ts").alias("_ts"), F.lit(-1).cast("bigint").alias("pos"), "shard_rows")
        placed = placed.unionByName(before, allowMissingColumns=True)
    dealt = _deal(placed, chunk_rows, limits).repartition(*shard, "_chunk")
    key_fields = [f for f in dealt.schema.fields if f.name in shard]

    # The last chunk of a shard, often the only one, hands nothing on. The always-zero random term
    # keeps this filter above the shuffle, so that both passes read the same shuffled rows.
    zero = F.floor(F.rand(0)).cast("bigint")
    handing_on = F.col("_chunk") + zero < F.expr(f"(shard_rows - 1) div {chunk_rows}")
    tables = _tables(dealt.filter(handing_on), shard, key_fields, chunk_rows, group_chunks, limits)
    if begins is not None:
        by_items = F.col("by_items").cast("bigint") if limits.clocks == 2 else F.lit(0).cast("bigint")
        begins = begins.select(*shard, by_items.alias("_state"), F.col("next_batch").alias("_before"))
    entries = _entries(tables, shard, key_fields, begins)

    out_schema = T.StructType(
        [
            *key_fields,
            T.StructField(order, T.LongType()),
            T.StructField("batch_no", T.LongType()),
            T.StructField("condition", T.StringType()),
        ]
    )
    cut = (
        dealt.join(entries, [*shard, "_chunk"], "left")
        .groupBy(*shard, "_chunk")
        .applyInArrow(_cutter(len(shard), chunk_rows, limits, drain_on_stop, keep_open, out_schema), out_schema)
    )
    return cut if keys else cut.drop("_all")


def _deal(placed: DataFrame, chunk_rows: int, limits: Limits) -> DataFrame:
    """Give rows to their chunk, the head of a chunk also to the one before it (and, when the clock
    matters, the last row of a chunk also to the one after it)."""
    home = F.expr(f"pos div {chunk_rows}")
    offset = F.col("pos") % chunk_rows
    chunks = F.when((offset < limits.max_items) & (home > 0), F.array(home, home - 1))
    if limits.timeout_ms is not None:
        chunks = F.array_union(
            chunks.otherwise(F.array(home)),
            F.when(offset == chunk_rows - 1, F.array(home + 1)).otherwise(F.array().cast("array<bigint>")),
        )
    else:
        chunks = chunks.otherwise(F.array(home))
    dealt = placed.withColumn("_chunk", F.explode(chunks))
    return dealt.filter(F.col("_chunk") * chunk_rows < F.col("shard_rows"))


def _run(table: pa.Table, chunk_rows: int, limits: Limits):
    """The rows of a chunk in order: (sorted table, Run, rows owned)."""
    table = table.combine_chunks()
    pos = table["pos"].to_numpy()
    if (pos[1:] < pos[:-1]).any():
        table = table.take(pa.array(np.argsort(pos)))
    first = table["_chunk"][0].as_py() * chunk_rows
    ts = ts_before = None
    before = int(table["pos"][0].as_py() < first)
    if limits.timeout_ms is not None:
        times = table["_ts"].to_numpy()
        ts_before, ts = (times[0] if before else None), times[before:]
    table = table.slice(before)
    streams = table["_stream"].combine_chunks()
    streams = streams.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    run = Run(table["_own"].to_numpy(), streams, table["_stream_sz"].to_numpy(), ts, ts_before)
    own = int(np.searchsorted(table["pos"].to_numpy(), first + chunk_rows))
    return table, run, own


def _tables(dealt, shard, key_fields, chunk_rows, group_chunks, limits) -> DataFrame:
    """Step 2: one row per chunk, (keys, _group, _chunk, exits, counts)."""
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("_group", T.LongType()),
            T.StructField("_index", T.LongType()),
            T.StructField("exits", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )

    def describe(key, table):
        _, run, own = _run(table, chunk_rows, limits)
        exits, counts = transfer(run, own, limits)
        chunk = key[-1].as_py()
        return _one_row(key[:-1], schema, [chunk // group_chunks, chunk, exits, counts])

    return dealt.groupBy(*shard, "_chunk").applyInArrow(describe, schema)


def _one_row(key, schema: T.StructType, values) -> pa.Table:
    columns = [pa.array([k.as_py()], k.type) for k in key]
    for v in values:
        columns.append(pa.array([v], pa.list_(pa.int64()) if isinstance(v, np.ndarray) else pa.int64()))
    return pa.table(columns, names=schema.names)


def _in_order(table: pa.Table):
    """(indexes, [(exits, counts), ..]) of transfer rows sorted by index."""
    table = table.sort_by("_index")
    lists = zip(table["exits"].combine_chunks(), table["counts"].combine_chunks())
    return (
        table["_index"].to_pylist(),
        [(e.values.to_numpy(), c.values.to_numpy()) for e, c in lists],
    )


def _walk(key, table: pa.Table, state: int, before: int, schema: T.StructType) -> pa.Table:
    """Follow the transfers from a known state: the entry of the index after each of them."""
    indexes, transfers = _in_order(table)
    states, befores = [], []
    for exits, counts in transfers:
        before += int(counts[state])
        state = int(exits[state])
        states.append(state)
        befores.append(before)
    n = len(indexes)
    columns = [pa.array([k.as_py()] * n, k.type) for k in key]
    columns += [pa.array([i + 1 for i in indexes], pa.int64()), pa.array(states, pa.int64()),
                pa.array(befores, pa.int64())]
    return pa.table(columns, names=schema.names)


def _entries(tables: DataFrame, shard, key_fields, begins: DataFrame | None = None) -> DataFrame:
    """Step 3: (keys, _chunk, _state, _before) for every chunk after the first.

    With ``begins`` (keys, _state, _before) also for the first chunk of the shards in it.
    """
    group_schema = T.StructType(
        [*key_fields, *(f for f in tables.schema.fields if f.name in ("_index", "exits", "counts"))]
    )

    def entry_schema(index: str) -> T.StructType:
        return T.StructType(
            [*key_fields, *(T.StructField(n, T.LongType()) for n in (index, "_state", "_before"))]
        )

    group_entry, chunk_entry = entry_schema("_group"), entry_schema("_chunk")

    def join_group(key, table):
        exits, counts = compose(_in_order(table)[1])
        return _one_row(key[:-1], group_schema, [key[-1].as_py(), exits, counts])

    def walk_groups(key, table):
        return _walk(key, table, 0, 0, group_entry)

    def walk_on(key, table, begin):
        if table.num_rows == 0:
            return group_entry_none()
        known = begin.num_rows > 0
        return _walk(key, table, begin["_state"][0].as_py() if known else 0, begin["_before"][0].as_py() if known else 0, group_entry)

    def group_entry_none():
        fields = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in group_entry.fields])
        return fields.empty_table()

    def walk_chunks(key, chunks, entry):
        if chunks.num_rows == 0:
            return pa.table([pa.array([], f.type) for f in pa.schema(
                [(n, chunks.schema.field(n).type) for n in shard])] + [pa.array([], pa.int64())] * 3,
                names=chunk_entry.names)
        state, before = 0, 0
        if entry.num_rows:
            state, before = entry["_state"][0].as_py(), entry["_before"][0].as_py()
        return _walk(key[:-1], chunks, state, before, chunk_entry)

    groups = tables.groupBy(*shard, "_group").applyInArrow(join_group, group_schema)
    if begins is None:
        entered = groups.groupBy(*shard).applyInArrow(walk_groups, group_entry)
    else:
        entered = groups.groupBy(*shard).cogroup(begins.groupBy(*shard)).applyInArrow(walk_on, group_entry)
        first = F.lit(0).cast("bigint")
        entered = entered.unionByName(begins.withColumn("_group", first))
    entries = (
        tables.groupBy(*shard, "_group")
        .cogroup(entered.groupBy(*shard, "_group"))
        .applyInArrow(walk_chunks, chunk_entry)
    )
    return entries if begins is None else entries.unionByName(begins.withColumn("_chunk", first))


def _cutter(n_keys: int, chunk_rows: int, limits: Limits, drain_on_stop: bool, keep_open: bool, schema: T.StructType):
    """Step 4: the batches that start in a chunk, one output row per record in them."""

    def cut(key, table):
        table, run, own = _run(table, chunk_rows, limits)
        order = table["_seq"].to_numpy()
        if (order[1:] == order[:-1]).any():
            raise ValueError(f"order is not unique in shard {[k.as_py() for k in key[:n_keys]]}")
        # a chunk without an entry is the first of a shard that begins here
        state, number = table["_state"][0].as_py() or 0, table["_before"][0].as_py() or 0
        start, by_items = divmod(state, limits.clocks)
        clock = None
        if limits.timeout_ms is not None and start < own:
            clock = run.clock(start, by_items)
        at, numbers, whys, sizes = start, [], [], []
        for begin, end, why in batches(run, start, own, clock, limits):
            if why == OPEN and not keep_open:
                if not drain_on_stop:
                    break
                why = DRAIN
            numbers.append(number)
            whys.append(why)
            sizes.append(end - begin)
            number, at = number + 1, end
        rows = at - start if numbers else 0
        batch_of = pa.array(np.repeat(np.arange(len(sizes)), np.array(sizes, dtype=np.int64)))
        columns = [pa.repeat(k, rows) for k in key[:n_keys]]
        columns += [
            table["_seq"].slice(start, rows),
            pa.array(numbers, pa.int64()).take(batch_of),
            pa.array(whys, pa.string()).take(batch_of),
        ]
        return pa.table(columns, names=schema.names)

    return cut


def summarize_batches(df: DataFrame, keys: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Per batch: condition, items, streams, estimated bytes; with ``order`` also its first and last.

    Grouping by stream first keeps the distinct count a plain sum, and rows shrink on the map side.
    """
    batch = [*keys, "batch_no"]
    df = df.withColumn("_bytes", F.col("msg_sz") + F.col("meta_sz"))
    ends = [F.min(order).alias("_first"), F.max(order).alias("_last")] if order else []
    streams = df.groupBy(*batch, "stream_key").agg(
        F.first("condition").alias("condition"),
        F.count("*").alias("_items"),
        (F.sum("_bytes") + F.max("stream_sz")).alias("_bytes"),
        *ends,
    )
    ends = [F.min("_first").alias(f"first_{order}"), F.max("_last").alias(f"last_{order}")] if order else []
    return streams.groupBy(*batch).agg(
        F.first("condition").alias("condition"),
        F.sum("_items").alias("items"),
        F.count("*").alias("streams"),
        F.sum("_bytes").alias("est_bytes"),
        *ends,
    )


__all__ = ["BYTES", "DRAIN", "ITEMS", "OPEN", "assign_batches", "cut_batches", "cut_by_count", "summarize_batches"]
