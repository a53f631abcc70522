"""The catalog's queries written once more as plain SQL over the same tables."""

from __future__ import annotations

from .catalog import BYTES, COUNT, HOLED_BYTES, IDLE_MS, ITEMS, MOVED_BACK, MOVED_ON, OVERSIZE

NL = "chr(10)"

EV = """ev AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, (epoch_us(ts) % 1000) * 1000 AS nanos,
    user_id, event_type AS level, 'user-' || (user_id % 8) AS thread,
    'shop.events.' || event_type AS logger,
    event_type || ' ' || CAST(round(value * 100) AS BIGINT) AS message,
    CAST(round(value * 100) AS BIGINT) AS cents, regexp_extract(props, '[0-9]+') AS k
  FROM events)"""

SHORT_20 = "CASE WHEN length(logger) < 20 THEN logger ELSE 's.events.' || level END"

REC = EV + f""", rec AS (
  SELECT *, thread AS shard, '{{"app":"shop","level":"' || level || '"}}' AS labels,
    '{{"app":"shop","level":"' || level || '"}}' AS stream_key,
    '{{"thread":"' || thread || '","k":"' || k || '"}}' AS metadata,
    '[' || thread || '] ' || {SHORT_20} || ' - ' || message || {NL} AS line,
    strlen('[' || thread || '] ' || {SHORT_20} || ' - ' || message || {NL}) + 24
      + 7 + strlen(thread) + strlen(k) + 24 + 8 AS own,
    12 + strlen(level) + 8 AS ssz,
    ts_ms || lpad(CAST(nanos AS VARCHAR), 6, '0') AS ts_ns
  FROM ev)"""

TURNS = """rec AS (
  SELECT conv_id * 1000 + turn AS seq, turn AS ts_ms, 0 AS nanos, 0 AS shard,
    '{"role":"' || role || '"}' AS stream_key, '{"role":"' || role || '"}' AS labels, text AS line,
    strlen(text) + 24 + 4 + strlen(CAST(conv_id AS VARCHAR)) + 24 + 4 AS own, 4 + strlen(role) + 8 AS ssz
  FROM conversations)"""

ORDERS = """rec AS (
  SELECT o_orderkey AS seq, epoch_us(o_orderdate) // 1000 AS ts_ms,
    CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderstatus END AS tenant,
    '{"priority":"' || o_orderpriority || '"}' AS stream_key,
    'order ' || o_orderkey || ' of ' || o_custkey AS line
  FROM orders)"""


def _counted(keys: str = "", size: int = COUNT) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""placed AS (
  SELECT *, row_number() OVER ({part} ORDER BY seq) - 1 AS pos, count(*) OVER ({part}) AS total FROM rec),
cut AS (
  SELECT *, pos // {size} AS batch_no,
    CASE WHEN (pos // {size} + 1) * {size} <= total THEN 'MAX_ITEMS' ELSE 'DRAIN' END AS condition
  FROM placed)"""


def _fold(items: int, size: int, idle: int | None = None) -> str:
    """Cut batches row by row with a recursive query."""
    late = f"r.ts_ms - f.clock > {idle}" if idle is not None else "false"
    cost = "r.own + CASE WHEN list_contains(f.streams, r.stream_key) THEN 0 ELSE r.ssz END"
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY seq) AS rn FROM rec),
fold AS (
  SELECT shard, rn, 0::BIGINT AS batch_no, 1 AS items, own + ssz AS bytes, [stream_key] AS streams,
    ts_ms AS clock, ts_ms AS ts, '' AS why
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT s.shard, s.rn, CASE WHEN s.why <> '' THEN s.batch_no + 1 ELSE s.batch_no END,
    CASE WHEN s.why <> '' THEN 1 ELSE s.items + 1 END,
    CASE WHEN s.why <> '' THEN s.own + s.ssz ELSE s.bytes + s.cost END,
    CASE WHEN s.why <> '' THEN [s.stream_key] ELSE list_append(s.streams, s.stream_key) END,
    CASE s.why WHEN '' THEN s.clock WHEN 'MAX_ITEMS' THEN s.before ELSE s.ts_ms END, s.ts_ms, s.why
  FROM (
    SELECT r.shard, r.rn, r.own, r.ssz, r.stream_key, r.ts_ms, f.batch_no, f.items, f.bytes, f.streams,
      f.clock, f.ts AS before, {cost} AS cost,
      CASE WHEN f.items = {items} THEN 'MAX_ITEMS' WHEN {late} THEN 'DRAIN'
        WHEN f.bytes + {cost} > {size} THEN 'MAX_BYTES' ELSE '' END AS why
    FROM fold f JOIN numbered r ON r.shard = f.shard AND r.rn = f.rn + 1) s),
cut AS (
  SELECT n.*, f.batch_no, max(f.items) OVER b AS n_items,
    max(f.batch_no) OVER (PARTITION BY f.shard) AS last_batch, f.why
  FROM numbered n JOIN fold f ON n.shard = f.shard AND n.rn = f.rn
  WINDOW b AS (PARTITION BY f.shard, f.batch_no)),
whys AS (SELECT shard, batch_no - 1 AS batch_no, why FROM cut WHERE why <> ''),
ends AS (
  SELECT c.*, CASE WHEN n_items = {items} THEN 'MAX_ITEMS' ELSE coalesce(w.why, 'DRAIN') END AS condition
  FROM cut c LEFT JOIN whys w ON c.shard = w.shard AND c.batch_no = w.batch_no)"""


def _batch_table(base: str, keys: str, fold: str, where: str = "") -> str:
    key = f"{keys}, " if keys else ""
    return f"""WITH RECURSIVE {base}, {fold}
SELECT {key}batch_no, min(condition) AS condition, CAST(sum(n) AS BIGINT) AS items, count(*) AS streams,
  CAST(sum(bytes) AS BIGINT) AS est_bytes, min(first_seq) AS first_seq, max(last_seq) AS last_seq
FROM (SELECT {key}batch_no, stream_key, min(condition) AS condition, count(*) AS n,
    sum(own) + max(ssz) AS bytes, min(seq) AS first_seq, max(seq) AS last_seq
  FROM ends GROUP BY ALL) {where} GROUP BY ALL"""


# --- typed pairs, traces and maps of the events ---------------------------------------------------

AMOUNT = "((cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '1')"
EVEN = "CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END"
VIP = """CASE WHEN user_id % 3 = 0 THEN ',"{}vip":"yes"' ELSE '' END"""
LIST = f"""'[' || user_id || ',"' || level || '","' || {AMOUNT} || '",null,' || {EVEN} || ']'"""
TRACE_1 = f"'Failure: ' || level || {NL} || chr(9) || 'at a.B.c(B:1)' || {NL}"
TRACE = (
    f"{TRACE_1} || chr(9) || 'at d.E.f(E:' || user_id || ')' || {NL} || chr(9) || 'at g.H.i(H:3)' || {NL}"
)
ON_ERROR = "CASE WHEN level = 'error' THEN {} ELSE '' END"


def _short(n: int) -> str:
    last = "length(level) + 1"
    return f"""CASE WHEN 12 + length(level) < {n} THEN logger
    ELSE 's.' || CASE WHEN 3 < 11 - greatest({n} - ({last}), 0) THEN 'e.' ELSE 'events.' END || level END"""


def _varint(n: str) -> str:
    def groups(size: int) -> str:
        each = [f"({n} >> {7 * i}) & 127" for i in range(size)]
        return ", ".join(f"({g}) + 128" if i < size - 1 else f"({g})" for i, g in enumerate(each))

    out = f"CASE WHEN {n} < 0 THEN printf('{'%02X' * 10}', {groups(9)} + 128, 1) WHEN {n} < 128 THEN printf('%02X', {n})"
    for size in range(2, 9):
        out += f" WHEN {n} < {1 << 7 * size} THEN printf('{'%02X' * size}', {groups(size)})"
    return out + " END"


def _proto_pair(name: str, value: str) -> str:
    """A metadata pair; name and value are short, so their lengths take one byte."""
    return (
        f"printf('1A%02X0A%02X', strlen({name}) + strlen({value}) + 4, strlen({name})) || hex({name})"
        f" || printf('12%02X', strlen({value})) || hex({value})"
    )


def _proto(base: str, cut: str, key: str = "", rows: str = "cut") -> str:
    """CTEs up to ``messages``: (key, batch_no, condition, items, streams, est_bytes, payload)."""
    return f"""{base}, {cut},
times AS (
  SELECT *, CASE WHEN trunc(ts_ms / 1000) = 0 THEN '' ELSE '08' || {_varint('((ts_ms - ts_ms % 1000) // 1000)')} END
    || CASE WHEN ts_ms % 1000 * 1000000 + nanos = 0 THEN ''
    ELSE '10' || {_varint('(ts_ms % 1000 * 1000000 + nanos)')} END AS t FROM {rows}),
bodies AS (
  SELECT *, printf('0A%02X', length(t) // 2) || t || '12' || {_varint('strlen(line)')} || hex(line)
    || {_proto_pair("'thread'", "thread")} || {_proto_pair("'k'", "k")} AS body FROM times),
entries AS (SELECT *, '12' || {_varint('(length(body) // 2)')} || body AS entry FROM bodies),
grouped AS (
  SELECT {key}batch_no, stream_key, min(condition) AS condition, count(*) AS n, sum(own) + max(ssz) AS bytes,
    '{{app="shop",level="' || level || '"}}' AS sel, string_agg(entry, '' ORDER BY seq) AS entries
  FROM entries GROUP BY {key}batch_no, stream_key, level),
streams AS (SELECT *, '0A' || {_varint('strlen(sel)')} || hex(sel) || entries AS body FROM grouped),
messages AS (
  SELECT {key}batch_no, min(condition) AS condition, CAST(sum(n) AS BIGINT) AS items, count(*) AS streams,
    CAST(sum(bytes) AS BIGINT) AS est_bytes,
    string_agg('0A' || {_varint('(length(body) // 2)')} || body, '' ORDER BY stream_key) AS payload
  FROM streams GROUP BY {key}batch_no)"""


PROTO = _proto(REC, _counted())
MOVED = f"ts_ms + (CASE seq % 3 WHEN 0 THEN -{MOVED_BACK} WHEN 1 THEN {MOVED_ON} ELSE 0 END)"
MOVED_REC = REC.replace("rec AS", "still AS") + f", rec AS (SELECT * REPLACE ({MOVED} AS ts_ms) FROM still)"
PROTO_COLUMNS = (
    "batch_no, condition, items, streams, est_bytes, md5(unhex(payload)) AS payload_bin,"
    " CAST(length(payload) // 2 AS INTEGER) AS size_bytes"
)
DEEP = "(cents // 100) || '.251'"


def _json(base: str, cut: str, key: str = "", meta: bool = True, sizes: bool = True, rows: str = "cut") -> str:
    """CTEs up to ``payloads``: (key, batch_no, condition, items, streams, est_bytes, doc)."""
    third = "|| ',' || metadata" if meta else ""
    size = "sum(own) + max(ssz)" if sizes else "0"
    ts = "ts_ms || lpad(CAST(nanos AS VARCHAR), 6, '0')" if sizes else "ts_ms || '000000'"
    return f"""{base}, {cut},
grouped AS (
  SELECT {key}batch_no, stream_key, min(condition) AS condition, count(*) AS n, {size} AS bytes,
    '{{"stream":' || stream_key || ',"values":[' || string_agg(
      '["' || {ts} || '",' || CAST(to_json(line) AS VARCHAR) {third} || ']', ',' ORDER BY seq) || ']}}' AS s
  FROM {rows} GROUP BY {key}batch_no, stream_key),
payloads AS (
  SELECT {key}batch_no, min(condition) AS condition, CAST(sum(n) AS BIGINT) AS items, count(*) AS streams,
    CAST(sum(bytes) AS BIGINT) AS est_bytes,
    '{{"streams":[' || string_agg(s, ',' ORDER BY stream_key) || ']}}' AS doc
  FROM grouped GROUP BY {key}batch_no)"""


ATTEMPTS = """attempts AS (
  SELECT event_id // 3 AS batch_no, CAST(event_id % 3 AS INTEGER) AS attempt,
    CASE event_type WHEN 'view' THEN 204 WHEN 'click' THEN 503 WHEN 'purchase' THEN 429
      WHEN 'signup' THEN 500 END AS status,
    CASE WHEN event_type = 'error' THEN
      ['ConnectException', 'HttpConnectTimeoutException', 'SSLException'][user_id % 3 + 1] END AS exception
  FROM events)"""


def _judged(retries: int = 2, limited: bool = False, sticky: bool = True,
            exceptions: str = "'ConnectException', 'HttpConnectTimeoutException'") -> str:
    seen = "last_value({0} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    e, s = (seen.format("exception"), seen.format("status")) if sticky else ("exception", "status")
    codes = "503" if limited else "503, 429"
    return f"""seen AS (
  SELECT *, {e} AS e, {s} AS s, coalesce(exception IS NULL AND status BETWEEN 200 AND 299, false) AS success
  FROM attempts WINDOW w AS (PARTITION BY batch_no ORDER BY attempt)),
rated AS (
  SELECT *, NOT success AND (coalesce(e IN ({exceptions}), false) OR coalesce(s IN ({codes}), false)) AS retryable,
    CASE WHEN NOT success THEN coalesce('exception:' || e, 'status:' || s) END AS reason
  FROM seen),
judged AS (
  SELECT batch_no, attempt, status, exception, success, retryable, reason, coalesce(bool_and(retryable AND attempt < {retries})
    OVER (PARTITION BY batch_no ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS made
  FROM rated)"""


STATES = f"""{ATTEMPTS}, {_judged()},
states AS (
  SELECT batch_no, CASE WHEN arg_max(success, attempt) THEN 'delivered' ELSE 'dropped' END AS state,
    count(*) - 1 AS retries, CASE WHEN NOT arg_max(success, attempt) THEN arg_max(reason, attempt) END AS reason
  FROM judged WHERE made GROUP BY batch_no)"""

TEN = """sizes AS (
  SELECT o_orderkey // 10 AS batch_no, count(*) AS items,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS size_bytes
  FROM orders GROUP BY ALL)"""

URL_QUERY = """q AS (
  SELECT page_id, string_split(split_part(split_part(url, '#', 1), '?', 2), '&') AS parts FROM pages)"""

JUDGED_COLUMNS = "batch_no, attempt, success, retryable, reason, made"

BLANK_SQL = (
    r"'^[\t-\r\x1c-\x1f \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}]*$'"
)

_PAYLOAD_COLUMNS = (
    "batch_no, condition, items, streams, est_bytes, md5(doc) AS {0}, CAST(strlen(doc) AS INTEGER) AS size_bytes"
)

ORACLES: dict[str, str] = {
    "event_formats": f"""WITH {EV}
SELECT format, level, count(*) AS events, CAST(sum(ts_ms) AS BIGINT) AS ts_ms, CAST(sum(nanos) AS BIGINT) AS nanos
FROM ev, (SELECT unnest(['parquet', 'orc', 'json', 'csv']) AS format) GROUP BY ALL""",
    "shape_records": f"WITH {REC} SELECT seq AS event_id, ts_ns, labels, line, metadata FROM rec",
    "default_rules": f"""WITH {REC}
SELECT seq AS event_id, '{{"app":"shop","host":"h1","agent":"a"}}' AS labels, line,
  '{{"level":"' || level || '","thread":"' || thread || '","logger":"' || logger || '","user":"' || user_id
    || '","k":"' || k || '"}}' AS metadata
FROM rec""",
    "bulk_kvp": f"""WITH {EV}
SELECT seq AS event_id,
  '{{"level":"' || level || '","kind":"' || level || '","user":"' || user_id || '"' || {VIP.format("")} || '}}' AS labels,
  '{{"t":"' || thread || '","kvp_amount":"' || {AMOUNT} || '","kvp_even":"' || {EVEN} || '","kvp_list":"['
    || user_id || ', ' || level || ', ' || {AMOUNT} || ', null, ' || {EVEN} || ']","kvp_name":"' || level
    || '","kvp_nested":"{{\\"user\\":' || user_id || '}}","kvp_user":"' || user_id || '"}}' AS metadata
FROM ev""",
    "bulk_include_exclude": f"""WITH {EV}
SELECT seq AS event_id,
  '{{"c":"' || level || '","m_kind":"' || level || '","m_user":"' || user_id || '"}}' AS labels,
  '{{"t":"again","user":"' || user_id || '"' || {VIP.format("")} || '}}' AS metadata
FROM ev""",
    "marker_labels": f"""WITH {EV}
SELECT seq AS event_id,
  CASE level WHEN 'error' THEN '{{"level":"error","severity":"high"}}' WHEN 'purchase' THEN '{{"level":"PAID"}}'
    ELSE '{{"level":"' || level || '"}}' END AS labels,
  '{{"thread":"' || thread || '"' || CASE WHEN level = 'purchase' THEN ',"amount":"' || cents || '"' ELSE '' END
    || '}}' AS metadata
FROM ev""",
    "static_labels_shard": f"""WITH {REC}
SELECT seq AS event_id, first_value(labels) OVER (PARTITION BY shard ORDER BY seq) AS labels, line FROM rec""",
    "static_labels_all": f"""WITH {REC}
SELECT seq AS event_id, (SELECT arg_min(labels, seq) FROM rec) AS labels, line FROM rec""",
    "logger_short": f"""WITH {EV}
SELECT seq AS event_id, level AS to_0, {_short(8)} AS to_8, {_short(14)} AS to_14, {_short(17)} AS to_17,
  {_short(20)} AS to_20, logger AS whole FROM ev""",
    "url_params": f"""WITH {URL_QUERY},
p AS (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS n FROM q)
SELECT page_id, CAST(n AS INTEGER) AS position, split_part(part, '=', 1) AS key, split_part(part, '=', 2) AS value
FROM p WHERE part <> ''""",
    "bad_records": f"""WITH {URL_QUERY}
SELECT 'append' AS stage, 'no pairs' AS reason, count(*) AS errors FROM q WHERE parts = ['']""",
    "attribute_pairs": """WITH s AS (
  SELECT page_id, list_filter(string_split_regex(regexp_replace(url, '^https?://', 'site='), '/[^?#]*[?#]?|[&#]'),
    lambda x: x <> '') AS parts FROM pages),
e AS (SELECT *, len(list_filter(parts, lambda x: len(string_split(x, '=')) <> 2)) > 0 AS bad FROM s)
SELECT page_id, CAST(CASE WHEN bad THEN 0 ELSE len(parts) END AS INTEGER) AS pairs,
  CASE WHEN bad THEN 'bad pair' END AS error FROM e""",
    "blank_lines": f"""WITH l AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line FROM documents)
SELECT doc_id, count(*) AS lines, count(*) FILTER (regexp_matches(line, {BLANK_SQL})) AS blank FROM l GROUP BY ALL""",
    "text_layouts": f"""WITH {EV}
SELECT seq AS event_id,
  level || '/' || thread || ' ' || {SHORT_20} || ': ' || message || '; ' || {ON_ERROR.format(TRACE_1)} AS short_trace,
  rpad(level, 9, ' ') || '[' || lpad(thread, 10, ' ') || '] ' || level || ' - ' || message || {NL}
    || {ON_ERROR.format(TRACE)} AS padded,
  message || ' ' || {ON_ERROR.format(TRACE)} AS whole_trace
FROM ev""",
    "json_layout": f"""WITH {EV}
SELECT seq AS event_id, '{{"timestamp_ms":' || ts_ms || ',"logger_name":"' || logger || '","level":"' || level
  || '","thread_name":"' || thread || '","message":"' || message || '"'
  || {ON_ERROR.format("',\"stack_trace\":' || CAST(to_json(" + TRACE + ") AS VARCHAR)")}
  || ',"mdc_kind":"' || level || '","mdc_user":"' || user_id || '"' || {VIP.format("mdc_")}
  || ',"kvp_k":' || k || '}}' AS doc
FROM ev""",
    "json_layout_custom": f"""WITH {EV}
SELECT seq AS event_id, '{{"logger_name":"' || level || '","level":"' || level || '","message":"' || message
  || '","user":"' || user_id || '"' || {VIP.format("")} || ',"both_pair_k":{{"pair_k":' || k || '}},"words_in_all":2'
  || ',"raw":{{"user":' || user_id || '}},"words":["' || level || '","' || cents
  || '"],"objects":[{{"w":"' || level || '"}},{{"w":"' || cents || '"}}]}}' AS doc
FROM ev""",
    "json_typed": f"""WITH {EV}
SELECT seq AS event_id, '{{"kvp_amount":"' || {AMOUNT} || '","kvp_even":' || {EVEN} || ',"kvp_list":' || {LIST}
  || ',"kvp_name":"' || level || '","kvp_nested":{{"user":' || user_id || '}},"kvp_user":' || user_id || '}}' AS doc,
  '{{"list":' || {LIST} || ',"user":' || user_id || '}}' AS some, '{{}}' AS nothing
FROM ev""",
    "quoted_text": """WITH t AS (
  SELECT 'documents' AS source, doc_id AS id, text FROM documents
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 'pages', page_id, html FROM pages)
SELECT source, id, md5(CAST(to_json(text) AS VARCHAR)) AS quoted_md5,
  CAST(strlen(CAST(to_json(text) AS VARCHAR)) AS BIGINT) AS quoted_bytes FROM t""",
    "record_sizes": """SELECT doc_id, CAST(strlen(text) + 24 AS BIGINT) AS msg_sz,
  CAST(5 + strlen(CAST(n_chars AS VARCHAR)) + 24 + 4 AS BIGINT) AS meta_sz,
  CAST(4 + strlen(lang) + 6 + strlen(source) + 8 AS BIGINT) AS stream_sz FROM documents""",
    "oversize": f"""SELECT doc_id, CASE WHEN strlen(text) + 24 + 33 + strlen(CAST(n_chars AS VARCHAR)) + 18
  + strlen(lang) + strlen(source) <= {OVERSIZE} THEN 'kept' ELSE 'refused' END AS state FROM documents""",
    "dropped_events": f"""SELECT lang, count(*) AS dropped_events FROM documents
WHERE strlen(text) + 24 + 33 + strlen(CAST(n_chars AS VARCHAR)) + 18 + strlen(lang) + strlen(source) > {OVERSIZE}
GROUP BY ALL""",
    "batches_by_count": f"""WITH {REC}, {_counted("shard")},
g AS (SELECT shard, batch_no, stream_key, min(condition) AS condition, count(*) AS n, sum(own) + max(ssz) AS bytes
  FROM cut GROUP BY ALL)
SELECT shard, batch_no, min(condition) AS condition, CAST(sum(n) AS BIGINT) AS items, count(*) AS streams,
  CAST(sum(bytes) AS BIGINT) AS est_bytes FROM g GROUP BY ALL""",
    "batches_bounded": _batch_table(REC, "shard", _fold(ITEMS, BYTES)),
    "batches_idle": _batch_table(REC, "shard", _fold(ITEMS, BYTES, IDLE_MS)),
    "batches_no_drain": _batch_table(REC, "shard", _fold(ITEMS, BYTES), "WHERE condition <> 'DRAIN'"),
    "batches_one_shard": _batch_table(
        REC.replace("thread AS shard", "0 AS shard"), "", _fold(ITEMS, BYTES, IDLE_MS)
    ),
    "batches_of_text": _batch_table(TURNS, "", _fold(20, OVERSIZE)),
    "tenant_batches": f"""WITH {ORDERS}, {_counted("tenant", 100)}
SELECT tenant, batch_no, min(condition) AS condition, stream_key, count(*) AS items,
  string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq) AS order_ids FROM cut GROUP BY tenant, batch_no, stream_key""",
    "stream_groups": f"""WITH {REC}, {_counted()}
SELECT batch_no, stream_key, count(*) AS items, CAST(sum(own) + max(ssz) AS BIGINT) AS est_bytes,
  string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq) AS event_ids FROM cut GROUP BY batch_no, stream_key""",
    "payload_json": f"WITH {_json(REC, _counted())} SELECT {_PAYLOAD_COLUMNS.format('payload_json')} FROM payloads",
    "payload_json_static": f"""WITH {REC.replace("rec AS", "own_rec AS")},
rec AS (SELECT seq, ts_ms, nanos, line, metadata, own, (SELECT arg_min(stream_key, seq) FROM own_rec) AS stream_key,
  (SELECT arg_min(ssz, seq) FROM own_rec) AS ssz FROM own_rec),
{_json("one AS (SELECT 1)", _counted())} SELECT {_PAYLOAD_COLUMNS.format('payload_json')} FROM payloads""",
    "payload_text": f"""WITH {REC}, {_counted()},
grouped AS (
  SELECT batch_no, stream_key, min(condition) AS condition, count(*) AS n, sum(own) + max(ssz) AS bytes,
    string_agg('{{app=shop, level=' || level || '}} %%% {{thread=' || thread || ', k=' || k || '}} %%% ts=' || ts_ms
      || ' ' || line || {NL}, '' ORDER BY seq) AS s
  FROM cut GROUP BY batch_no, stream_key),
payloads AS (
  SELECT batch_no, min(condition) AS condition, CAST(sum(n) AS BIGINT) AS items, count(*) AS streams,
    CAST(sum(bytes) AS BIGINT) AS est_bytes, string_agg(s, '' ORDER BY stream_key) AS doc
  FROM grouped GROUP BY batch_no)
SELECT {_PAYLOAD_COLUMNS.format('payload_text')} FROM payloads""",
    "payload_proto": f"WITH {PROTO} SELECT {PROTO_COLUMNS} FROM messages",
    "payload_proto_times": f"WITH {_proto(MOVED_REC, _counted())} SELECT {PROTO_COLUMNS} FROM messages",
    "ship_json": f"""WITH RECURSIVE {_json(REC, _fold(ITEMS, BYTES, IDLE_MS), "thread, ", rows="ends")}
SELECT thread, {_PAYLOAD_COLUMNS.format('payload_json')} FROM payloads""",
    "ship_proto": f"""WITH RECURSIVE {_proto(REC, _fold(ITEMS, BYTES, IDLE_MS), "thread, ", "ends")}
SELECT thread, {PROTO_COLUMNS} FROM messages""",
    "shape_bad_records": f"""WITH {EV}, holed AS (
  SELECT seq, thread AS user_thread, CASE WHEN user_id % 13 <> 0 THEN thread END AS shard,
    CASE WHEN user_id % 7 <> 0 THEN thread ELSE '' END AS thread, level, logger,
    CASE WHEN user_id % 5 <> 0 THEN message ELSE '' END AS message, k, CASE WHEN seq % 401 <> 0 THEN ts_ms END AS ts_ms FROM ev),
sized AS (
  SELECT *, strlen('[' || thread || '] ' || {SHORT_20} || ' - ' || message || {NL}) + 24 + 7 + strlen(thread) + strlen(k) + 24 + 8
    + 12 + strlen(level) + 8 AS size FROM holed),
judged AS (
  SELECT seq, CASE WHEN shard IS NULL THEN 'no shard' WHEN ts_ms IS NULL THEN 'no time' END AS reason, size FROM sized)
SELECT CASE WHEN reason IS NOT NULL THEN 'bad' WHEN size <= {HOLED_BYTES} THEN 'kept' ELSE 'refused' END AS state, reason,
  count(*) AS events, CAST(sum(seq) AS BIGINT) AS ids FROM judged GROUP BY ALL""",
    "json_deep": f"""WITH {EV} SELECT seq AS event_id,
  '[[[[[["' || {DEEP} || '",{{"x":' || {DEEP} || '}},"' || level || '","99999999999999999999' || user_id || '",null]]]]],' || user_id || ']' AS typed,
  '[[[[[[' || {DEEP} || ', {{"x":' || {DEEP} || '}}, ' || level || ', 99999999999999999999' || user_id || ', null]]]]], ' || user_id || ']' AS plain
FROM ev""",
    "payload_snappy": f"""WITH {PROTO}
SELECT batch_no, items, CAST(length(payload) // 2 AS INTEGER) AS plain_bytes, md5(unhex(payload)) AS plain_md5,
  true AS smaller FROM messages""",
    "encode_errors": f"""WITH {REC}, {_counted()},
failed AS (
  SELECT batch_no, min(CASE WHEN seq % 997 = 0 THEN 'no time' WHEN seq % 1499 = 0 THEN 'no line' END) AS reason
  FROM cut GROUP BY batch_no)
SELECT 'encode' AS stage, reason, count(*) AS errors FROM failed WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'encode', 'none', count(*) FROM failed WHERE reason IS NULL""",
    "label_selector": r"""SELECT doc_id, '{lang="' || lang || '",quote="'
  || replace('"' || text || '"\', '"', '\"') || '"}' AS selector FROM documents""",
    "payload_records": f"""WITH {REC}, {_counted()}
SELECT batch_no, labels, CAST(row_number() OVER (PARTITION BY batch_no, stream_key ORDER BY seq) - 1 AS INTEGER) AS entry_no,
  ts_ms, CAST(nanos AS INTEGER) AS nanos_in_ms, line, metadata FROM cut""",
    "payload_roundtrip": f"""WITH {REC}
SELECT stream_key, count(*) AS sent, count(*) AS stored, 0::BIGINT AS missing, 0::BIGINT AS extra FROM rec GROUP BY ALL""",
    "payload_lost": f"""WITH RECURSIVE {TURNS}, {_fold(20, OVERSIZE)}
SELECT stream_key, count(*) AS sent, count(*) FILTER (condition <> 'MAX_BYTES') AS stored,
  count(*) FILTER (condition = 'MAX_BYTES') AS missing, 0::BIGINT AS extra FROM ends GROUP BY ALL""",
    "payload_files": f"""WITH {_json(ORDERS, _counted("tenant", 100), "tenant, ", meta=False, sizes=False)}
SELECT tenant, count(*) AS batches, CAST(sum(items) AS BIGINT) AS items, CAST(sum(strlen(doc)) AS BIGINT) AS bytes
FROM payloads GROUP BY ALL""",
    "select_errors": f"""WITH {REC} SELECT seq AS event_id, ts_ns, line FROM rec
WHERE level = 'error' AND ts_ms * 1000000 + nanos < 1705000000000000000 ORDER BY ts_ms, nanos, seq LIMIT 100""",
    "select_indexed": f"""WITH {REC} SELECT line, count(*) AS records FROM rec
WHERE level = 'error' AND ts_ms * 1000000 + nanos < 1705000000000000000 GROUP BY line""",
    "select_backward": f"""WITH {REC} SELECT seq AS event_id, ts_ns, line FROM rec
WHERE level = 'view' ORDER BY ts_ms DESC, nanos DESC, seq DESC LIMIT 50""",
    "drop_label": """SELECT '{"lang":"' || lang || '"}' AS stream_key, count(*) AS records FROM documents GROUP BY ALL""",
    "stream_time_order": f"WITH {TURNS} SELECT seq, ts_ms, stream_key FROM rec ORDER BY lower(stream_key), ts_ms, seq",
    "retry_delays": """SELECT o_orderkey AS batch_no, CAST(r AS INTEGER) AS retry,
  CAST(least(500 * power(2, r - 1), 3000) AS BIGINT) AS delay_ms
FROM (SELECT o_orderkey, unnest(range(1, o_orderkey % 7 + 1)) AS r FROM orders)""",
    "attempts_classified": f"WITH {ATTEMPTS}, {_judged()} SELECT {JUDGED_COLUMNS} FROM judged",
    "attempts_separate": f"WITH {ATTEMPTS}, {_judged(1, True, False)} SELECT {JUDGED_COLUMNS} FROM judged",
    "delivery_states": f"WITH {STATES} SELECT batch_no, state, retries, reason FROM states",
    "dead_letter_batches": f"""WITH {STATES}, {TEN}
SELECT batch_no, items, size_bytes FROM sizes WHERE batch_no NOT IN (SELECT batch_no FROM states WHERE state = 'delivered')""",
    "delivery_totals": f"""WITH {STATES}, {TEN},
j AS (SELECT s.*, coalesce(state = 'delivered', false) AS sent FROM sizes s LEFT JOIN states USING (batch_no))
SELECT count(*) AS encoded_batches, count(items) AS encoded_events_count, CAST(sum(items) AS BIGINT) AS encoded_events_total,
  max(items) AS encoded_events_max, count(size_bytes) AS encoded_bytes_count,
  CAST(sum(size_bytes) AS BIGINT) AS encoded_bytes_total, max(size_bytes) AS encoded_bytes_max,
  count(*) FILTER (sent) AS sent_batches, count(*) FILTER (sent) AS sent_bytes_count,
  CAST(sum(size_bytes) FILTER (sent) AS BIGINT) AS sent_bytes_total, max(size_bytes) FILTER (sent) AS sent_bytes_max FROM j""",
    "delivery_quantiles": f"""WITH {ORDERS}, n AS (SELECT tenant, count(*) AS n FROM rec GROUP BY ALL)
SELECT tenant, metric, quantile::DOUBLE AS quantile, n, true AS within FROM n, (SELECT unnest(['bytes', 'cents']) AS metric),
  (SELECT unnest([0.5, 0.9, 0.99]) AS quantile)""",
    "send_errors": f"""WITH {STATES}
SELECT 'retry' AS stage, reason, count(*) AS errors FROM judged WHERE made AND retryable AND attempt < 2 GROUP BY ALL
UNION ALL SELECT 'send', reason, count(*) FROM states WHERE state = 'dropped' GROUP BY ALL""",
    "unsent_events": f"""WITH {STATES}
SELECT count(*) AS unsent_events FROM lineitem WHERE l_orderkey // 4 NOT IN (SELECT batch_no FROM states)""",
    "thin_drops": """WITH n AS (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS count FROM events)
SELECT * FROM n WHERE count = 1 OR (count <= 90 AND count % 20 = 0) OR (count <= 900 AND count % 100 = 0)
  OR (count <= 900000 AND count % 1000 = 0) OR (count <= 9000000 AND count % 10000 = 0)
  OR (count <= 900000000 AND count % 1000000 = 0)""",
    "push_delivery": f"""WITH {_json(ORDERS, _counted(), meta=False, sizes=False)}
SELECT batch_no, 0::INTEGER AS attempt, 204::INTEGER AS status, md5(doc) AS body_md5, strlen(doc) AS body_bytes FROM payloads""",
}
ORACLES["send_errors_from_one"] = ORACLES["send_errors"]
ORACLES["stream_batches"] = ORACLES["batches_bounded"]
ORACLES["stream_batches_no_drain"] = ORACLES["batches_no_drain"]
ORACLES["stream_one_shard"] = ORACLES["batches_one_shard"]
ORACLES["stream_bad_records"] = ORACLES["shape_bad_records"]
ORACLES["proto_roundtrip"] = ORACLES["payload_roundtrip"]
ORACLES["payload_lost_digests"] = ORACLES["payload_lost"]
