"""DuckDB SQL for each registered query (independent oracle).

Tables are the pre-registered views named like the parquet files. Column
names and types match the Spark output; casts make DuckDB's rounding
behave like Spark's truncation where they differ.
"""

from __future__ import annotations

# -- shared fragments ---------------------------------------------------------

_LANDING_PATH = (
    "'landing/orders/date=' || strftime(o.o_orderdate, '%Y-%m-%d') || '/hr=' || "
    "CAST(hour(o.o_orderdate) AS VARCHAR) || '/part-' || "
    "lpad(CAST(o.o_orderkey % 16 AS VARCHAR), 5, '0') || '.json'"
)

_RESULT_COLS = [
    ("o_orderkey", "CAST(o.o_orderkey AS BIGINT)"),
    ("o_custkey", "CAST(o.o_custkey AS BIGINT)"),
    ("o_orderstatus", "CAST(o.o_orderstatus AS VARCHAR)"),
    ("o_totalprice", "CAST(o.o_totalprice AS DOUBLE)"),
    ("o_orderdate", "CAST(o.o_orderdate AS TIMESTAMP)"),
    ("o_orderpriority", "CAST(o.o_orderpriority AS VARCHAR)"),
    ("c_custkey", "CAST(c.c_custkey AS BIGINT)"),
    ("c_name", "CAST(c.c_name AS VARCHAR)"),
    ("c_nationkey", "CAST(c.c_nationkey AS BIGINT)"),
    ("c_acctbal", "CAST(c.c_acctbal AS DOUBLE)"),
    ("c_mktsegment", "CAST(c.c_mktsegment AS VARCHAR)"),
    ("l_orderkey", "CAST(l.l_orderkey AS BIGINT)"),
    ("l_partkey", "CAST(l.l_partkey AS BIGINT)"),
    ("l_suppkey", "CAST(l.l_suppkey AS BIGINT)"),
    ("l_linenumber", "CAST(l.l_linenumber AS BIGINT)"),
    ("l_quantity", "TRY_CAST(trunc(l.l_quantity) AS BIGINT)"),
    ("l_extendedprice", "CAST(l.l_extendedprice AS DOUBLE)"),
    ("l_discount", "CAST(l.l_discount AS DOUBLE)"),
    ("l_tax", "CAST(l.l_tax AS DOUBLE)"),
    ("l_returnflag", "CAST(l.l_returnflag AS VARCHAR)"),
    ("l_linestatus", "CAST(l.l_linestatus AS VARCHAR)"),
    ("l_shipdate", "CAST(l.l_shipdate AS TIMESTAMP)"),
    ("file_path", _LANDING_PATH),
]

_RESULT_SELECT = ",\n  ".join(f"{e} AS {n}" for n, e in _RESULT_COLS)
_RESULT_NAMES = [n for n, _ in _RESULT_COLS]


def _content_id(cols) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in cols]
    return "md5(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts) + "))"


def _path_date(col: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({col}, 'date=([^/]+)', 1), '') AS DATE)"


def _path_hour(col: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({col}, 'hr=([0-9]+)', 1), '') AS INTEGER)"


_RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"

# flat, distinct, conformed rows of the nested landing records
_FLAT_DISTINCT = f"""
SELECT DISTINCT
  {_RESULT_SELECT}
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["flatten_pipeline"] = f"""
SELECT f.*,
  {_path_date('f.file_path')} AS date_,
  {_path_hour('f.file_path')} AS hr_,
  CAST(f.l_shipdate AS DATE) AS transaction_date,
  {_content_id('f.' + n for n in _RESULT_NAMES)} AS ale_id,
  {_RUN_TS} AS ale_transform_time
FROM ({_FLAT_DISTINCT}) f
"""

_ORDER_ENV = f"""
SELECT o.*, c.*, {_LANDING_PATH} AS source_path
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""

ORACLE_SQL["scan_nested"] = """
SELECT o.o_orderkey, c.c_custkey,
  DATE '2024-01-30' AS date_, CAST(o.o_orderkey % 24 AS INTEGER) AS hr_,
  CAST(coalesce(li.n, 0) AS BIGINT) AS n_items
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey
"""

ORACLE_SQL["file_lineage"] = """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey,
  DATE '2024-01-30' AS date_, CAST(o.o_orderkey % 24 AS INTEGER) AS hr_, true AS is_uri
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""

ORACLE_SQL["struct_flatten"] = _ORDER_ENV

ORACLE_SQL["explode_records"] = f"""
SELECT o.*, c.*, {_LANDING_PATH} AS source_path, l.*
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""

ORACLE_SQL["explode_outer_records"] = f"""
SELECT o.*, c.*, {_LANDING_PATH} AS source_path, l.*
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""

ORACLE_SQL["project"] = "SELECT l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem"

ORACLE_SQL["add_columns"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  TRY_CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
  CAST(l_shipdate AS DATE) AS transaction_date, {_RUN_TS} AS ale_transform_time
FROM lineitem
"""

# -- casts ----------------------------------------------------------------------


def _bigint_text(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(trim({x}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') AS BIGINT)"


_K_TEXT = "regexp_extract(props, '([0-9]+)', 1)"

ORACLE_SQL["conform_schema"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type,
  TRY_CAST(trunc(value) AS BIGINT) AS value, props, CAST(NULL AS BIGINT) AS props_k
FROM events
"""

ORACLE_SQL["cast_bigint"] = f"""
SELECT event_id,
  TRY_CAST(trunc(value) AS BIGINT) AS value_bigint,
  {_bigint_text('props')} AS props_bigint,
  {_bigint_text(_K_TEXT)} AS k_bigint,
  {_bigint_text('event_type')} AS type_bigint,
  {_bigint_text('CAST(value AS VARCHAR)')} AS value_text_bigint
FROM events
"""

ORACLE_SQL["cast_double"] = f"""
SELECT event_id,
  CAST(user_id AS DOUBLE) AS user_double,
  TRY_CAST(trim(props) AS DOUBLE) AS props_double,
  TRY_CAST(trim({_K_TEXT}) AS DOUBLE) AS k_double,
  TRY_CAST(trim(event_type) AS DOUBLE) AS type_double
FROM events
"""

ORACLE_SQL["cast_string"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey_text, CAST(l_linenumber AS VARCHAR) AS linenumber_text,
  CAST(l_shipdate AS VARCHAR) AS shipdate_text, l_returnflag
FROM lineitem
"""

ORACLE_SQL["cast_timestamp"] = """
SELECT event_id,
  TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_from_text,
  TIMESTAMP '1970-01-01 00:00:00' + to_microseconds((event_id * 3600 + 1704067200) * 1000000) AS ts_from_epoch_s,
  TIMESTAMP '1970-01-01 00:00:00' + to_microseconds((event_id * 3600 + 1704067200) * 1000000) AS ts_from_epoch_ms,
  TRY_CAST(trim(event_type) AS TIMESTAMP) AS ts_bad
FROM events
"""

ORACLE_SQL["cast_whitespace"] = """
SELECT event_id, CAST(user_id AS BIGINT) AS padded_bigint, CAST(user_id AS DOUBLE) AS padded_double FROM events
"""

ORACLE_SQL["cast_timestamp_zoned"] = """
SELECT event_id, epoch_us(date_trunc('second', ts) - INTERVAL 5 HOUR) AS instant_us,
  date_trunc('second', ts) - INTERVAL 5 HOUR AS utc_wall_clock,
  CAST((event_id * 3600 + 1704067200) * 1000000 AS BIGINT) AS epoch_us, CAST(NULL AS BIGINT) AS huge_us
FROM events
"""

ORACLE_SQL["derive_date"] = """
SELECT event_id, CAST(ts AS DATE) AS transaction_date,
  CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS date_from_text
FROM events
"""


def _reject(col: str, target: str, cast_expr: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, '{target}' AS target_type, "
        f"CAST(count(*) FILTER (WHERE {col} IS NOT NULL AND ({cast_expr}) IS NULL) AS BIGINT) AS rejected "
        "FROM events"
    )


ORACLE_SQL["cast_rejects"] = "\nUNION ALL\n".join(
    [
        _reject("event_id", "bigint", "TRY_CAST(event_id AS BIGINT)"),
        _reject("ts", "timestamp_ntz", "TRY_CAST(ts AS TIMESTAMP)"),
        _reject("user_id", "int", "TRY_CAST(user_id AS INTEGER)"),
        _reject("event_type", "bigint", _bigint_text("event_type")),
        _reject("value", "bigint", "TRY_CAST(trunc(value) AS BIGINT)"),
        _reject("props", "bigint", _bigint_text("props")),
    ]
)



def _rejected(name: str, target: str, cast: str, raw: str) -> str:
    return f"""SELECT event_id, '{name}' AS column_name, {raw} AS raw, '{target}' AS target_type FROM events
WHERE {name} IS NOT NULL AND ({cast}) IS NULL"""


_REJECTED = "\nUNION ALL\n".join(
    _rejected(name, target, cast, f"CAST({name} AS VARCHAR)")
    for name, target, cast in (
        ("event_type", "bigint", _bigint_text("event_type")),
        ("props", "bigint", _bigint_text("props")),
    )
)
ORACLE_SQL["rejected_rows"] = f"""
SELECT r.*, count(*) OVER (PARTITION BY column_name, target_type) AS rejected FROM ({_REJECTED}) r
"""

# -- paths, keys, windows ---------------------------------------------------------

_D = "strftime(ts, '%Y-%m-%d')"
_H = "CAST(hour(ts) AS VARCHAR)"
_EVENT_PATH = f"""CASE
  WHEN event_type = 'error' THEN 'landing/events/date=' || {_D} || '/' || CAST(event_id AS VARCHAR) || '.avro'
  WHEN event_type = 'signup' THEN 'landing/date=' || {_D} || '/replay/date=1999-12-31/hr=' || {_H} || '/' || CAST(event_id AS VARCHAR) || '.avro'
  ELSE 'landing/events/date=' || {_D} || '/hr=' || {_H} || '/' || CAST(event_id AS VARCHAR) || '.avro'
END"""

ORACLE_SQL["path_partitions"] = f"""
SELECT event_id, file_path, {_path_date('file_path')} AS date_, {_path_hour('file_path')} AS hr_
FROM (SELECT event_id, {_EVENT_PATH} AS file_path FROM events) p
"""

ORACLE_SQL["partition_keys"] = """
SELECT DISTINCT 'events/date=' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS partition_key, CAST(ts AS DATE) AS day
FROM events
"""

ORACLE_SQL["trailing_days"] = """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
"""

ORACLE_SQL["retention"] = """
SELECT CAST(ts AS DATE) AS transaction_date, count(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) < DATE '2024-01-21' GROUP BY 1
"""

ORACLE_SQL["surrogate_key"] = f"""
SELECT event_id, {_content_id(['event_id', 'user_id', 'event_type', 'ts'])} AS row_id FROM events
"""

ORACLE_SQL["stamp_rows"] = f"SELECT event_id, ts, {_RUN_TS} AS ale_transform_time FROM events"

# -- dedup -------------------------------------------------------------------------

ORACLE_SQL["distinct_rows"] = "SELECT DISTINCT text, lang, source, n_chars FROM documents"

ORACLE_SQL["dedup_by_key"] = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"

ORACLE_SQL["dedup_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
      l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
      l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) t
WHERE rn = 1
"""

ORACLE_SQL["dup_count"] = """
SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_count FROM lineitem
"""

# -- merge / partitions --------------------------------------------------------------

_EVENT_ROWS = "SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS transaction_date FROM events"
_STORED = f"SELECT *, CAST(NULL AS VARCHAR) AS batch FROM ({_EVENT_ROWS}) e WHERE ts < TIMESTAMP '2024-01-20 00:00:00'"
_NEW = f"SELECT *, 'new' AS batch FROM ({_EVENT_ROWS}) e WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'"

ORACLE_SQL["merge_union"] = f"{_NEW}\nUNION ALL\n{_STORED}"

ORACLE_SQL["merge_insert_only"] = f"""
SELECT * FROM ({_STORED}) s
UNION ALL
SELECT * FROM ({_NEW}) n
WHERE NOT EXISTS (SELECT 1 FROM ({_STORED}) s2
                  WHERE s2.event_id = n.event_id AND s2.transaction_date = n.transaction_date)
"""

_TOUCHED = f"SELECT DISTINCT transaction_date FROM ({_NEW}) n"

ORACLE_SQL["touched_partitions"] = _TOUCHED

ORACLE_SQL["existing_partitions"] = f"""
{_TOUCHED} WHERE transaction_date IN (SELECT transaction_date FROM ({_STORED}) s)
"""

ORACLE_SQL["scan_partitions"] = f"""
SELECT * FROM ({_STORED}) s WHERE transaction_date IN ({_TOUCHED})
"""

ORACLE_SQL["partition_overwrite"] = f"""
SELECT * FROM ({_STORED}) s WHERE transaction_date NOT IN ({_TOUCHED})
UNION ALL {_NEW}
"""

ORACLE_SQL["upsert_partitions"] = ORACLE_SQL["merge_insert_only"]

_NEW_WINS = f"""
SELECT * FROM ({_NEW}) n
UNION ALL
SELECT * FROM ({_STORED}) s WHERE NOT EXISTS (SELECT 1 FROM ({_NEW}) n2
  WHERE s.event_id = n2.event_id AND s.transaction_date = n2.transaction_date)
"""
ORACLE_SQL["upsert_new_wins"] = _NEW_WINS

# of each pair in the overlap the stored copy is an hour later for even ids, an hour earlier for odd ones
ORACLE_SQL["upsert_latest"] = f"""
SELECT event_id, ts, transaction_date,
  CASE WHEN batch = 'new' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND event_id % 2 = 0 THEN NULL ELSE batch END AS batch,
  CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN ts
       WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 HOUR
       WHEN batch = 'new' THEN ts ELSE ts - INTERVAL 1 HOUR END AS seen
FROM ({_NEW_WINS}) w
"""

_AWKWARD = "event_type || ': a,b {' || CAST(event_id % 3 AS VARCHAR)"
ORACLE_SQL["upsert_string_partition"] = f"""
SELECT event_id, value, {_AWKWARD} AS kind, batch FROM ({_NEW_WINS}) w
"""

ORACLE_SQL["upsert_extra_columns"] = f"""
SELECT w.*, CASE WHEN batch IS NULL THEN 'kept-' || CAST(event_id AS VARCHAR) END AS note FROM ({_NEW_WINS}) w
"""

ORACLE_SQL["replay_idempotent"] = ORACLE_SQL["merge_insert_only"]

# -- audit ---------------------------------------------------------------------------

_END_TS = "ts + to_microseconds(CAST(trunc(value * 1000000) AS BIGINT))"
_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'Started' ELSE 'COMPLETED' END"
_AUDIT = f"""
SELECT 'run-' || CAST(event_id AS VARCHAR) AS etl_run_id,
  'job_' || CAST(user_id AS VARCHAR) AS etl_job_name,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS etl_start_time,
  strftime({_END_TS}, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS etl_end_time,
  {_STATUS} AS etl_status,
  ts AS start_ts, {_END_TS} AS end_ts
FROM events
"""

ORACLE_SQL["audit_append"] = f"""
SELECT etl_run_id, etl_job_name, etl_start_time, etl_end_time, etl_status FROM ({_AUDIT}) a
"""

ORACLE_SQL["audit_scan"] = f"""
SELECT etl_run_id, etl_job_name, epoch_us(start_ts) AS start_us, epoch_us(end_ts) AS end_us, etl_status
FROM ({_AUDIT}) a
"""

ORACLE_SQL["latest_run"] = f"""
SELECT etl_job_name, etl_run_id, etl_start_time, etl_end_time, etl_status FROM (
  SELECT *, row_number() OVER (PARTITION BY etl_job_name ORDER BY start_ts DESC, etl_run_id DESC) AS rn
  FROM ({_AUDIT}) a) t
WHERE rn = 1
"""

ORACLE_SQL["watermark"] = f"""
SELECT etl_job_name,
  coalesce(max(epoch_us(start_ts)) FILTER (WHERE etl_status = 'COMPLETED'), -62135596800000000) AS watermark_us
FROM ({_AUDIT}) a GROUP BY etl_job_name
"""

# -- files ---------------------------------------------------------------------------

ORACLE_SQL["file_inventory"] = "SELECT DISTINCT CAST(ts AS DATE) AS date, true AS files_nonempty FROM events"

ORACLE_SQL["partition_file_counts"] = f"""
SELECT transaction_date AS date, count(*) AS n_files
FROM (SELECT DISTINCT transaction_date, batch FROM ({_STORED}) s UNION ALL {_TOUCHED.replace("transaction_date", "transaction_date, batch", 1)}) d
GROUP BY 1
"""

ORACLE_SQL["incremental_files"] = """
SELECT event_id, ts, CAST(ts AS DATE) AS date FROM events
WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-17' AND DATE '2024-01-30'
"""

ORACLE_SQL["write_layout"] = """
SELECT CAST(ts AS DATE) AS transaction_date, count(*) AS n_rows, true AS within_cap FROM events GROUP BY 1
"""

# -- streaming -----------------------------------------------------------------------

ORACLE_SQL["stream_ingest"] = _EVENT_ROWS
ORACLE_SQL["stream_dedup"] = _EVENT_ROWS

# -- the whole job ---------------------------------------------------------------------

_ETL_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "transaction_date"]
_ETL_ORDER = ", ".join(
    f"{n} DESC NULLS LAST" for n in _RESULT_NAMES if n not in _ETL_KEYS and n != "file_path"
)

ORACLE_SQL["etl_end_to_end"] = f"""
SELECT * EXCLUDE (rn, file_path) FROM (
  SELECT f.*,
    CASE WHEN f.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN DATE '2024-01-29'
         ELSE DATE '2024-01-30' END AS date_,
    CAST(f.o_orderkey % 24 AS INTEGER) AS hr_,
    CAST(f.l_shipdate AS DATE) AS transaction_date,
    {_RUN_TS} AS ale_transform_time,
    row_number() OVER (PARTITION BY f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey,
                       CAST(f.l_shipdate AS DATE) ORDER BY {_ETL_ORDER}) AS rn
  FROM ({_FLAT_DISTINCT}) f) t
WHERE rn = 1
"""

ORACLE_SQL["flat_layer"] = f"""
SELECT f.* EXCLUDE (file_path),
  DATE '2024-01-30' AS date_,
  CAST(f.o_orderkey % 24 AS INTEGER) AS hr_,
  CAST(f.l_shipdate AS DATE) AS transaction_date,
  {_RUN_TS} AS ale_transform_time,
  count(*) OVER () AS run_flat_rows
FROM (SELECT {_RESULT_SELECT}
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      LEFT JOIN customer c ON c.c_custkey = o.o_custkey) f
"""

ORACLE_SQL["surrogate_key_random"] = """
SELECT count(*) AS n_rows, count(*) AS n_ids, 36 AS id_len FROM events
"""

ORACLE_SQL["file_ledger"] = """
SELECT event_id, ts, CAST(ts AS DATE) AS date,
  CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 1 WHEN hour(ts) < 12 THEN 2 ELSE 3 END AS run
FROM events
"""

ORACLE_SQL["compaction"] = """
SELECT CAST(ts AS DATE) AS transaction_date, count(*) AS n_rows, bit_xor(event_id) AS ids, true AS few_files,
  (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS days_compacted
FROM events GROUP BY 1
"""

ORACLE_SQL["retention_drop"] = """
SELECT CAST(ts AS DATE) AS transaction_date,
  CASE WHEN CAST(ts AS DATE) < DATE '2024-01-21' THEN 0 ELSE count(*) END AS n_rows,
  CASE WHEN CAST(ts AS DATE) < DATE '2024-01-21' THEN 'expired' ELSE 'kept' END AS state
FROM events GROUP BY 1
"""

ORACLE_SQL["nested_records"] = """
SELECT l_orderkey AS o_orderkey, (count(*) + 1) // 2 AS n_records, count(*) AS n_items, count(*) // 2 AS n_full
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
"""

_METRIC_ROWS = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS transaction_date,
  CAST(o_orderstatus IS NOT NULL AND ({_bigint_text('o_orderstatus')}) IS NULL AS BIGINT)
    + CAST(c_name IS NOT NULL AND TRY_CAST(c_name AS DOUBLE) IS NULL AS BIGINT) AS bad
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
"""
ORACLE_SQL["run_metrics"] = f"""
SELECT 'run-1' AS etl_run_id, 'COMPLETED' AS etl_status, count(*) AS rows_read, CAST(sum(bad) AS BIGINT) AS rows_rejected,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, transaction_date)) AS rows_duplicate,
  count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, transaction_date)) AS rows_written, CAST(sum(bad) AS BIGINT) AS reject_rows
FROM ({_METRIC_ROWS}) m
UNION ALL
SELECT 'run-2', 'COMPLETED', count(*), CAST(sum(bad) AS BIGINT), count(*), 0, CAST(sum(bad) AS BIGINT)
FROM ({_METRIC_ROWS}) m WHERE l_orderkey % 3 = 0
"""

ORACLE_SQL["array_text"] = """
SELECT l_orderkey, '[' || string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY l_linenumber) || ']' AS lines_text,
  '[' || string_agg('{"line":' || CAST(l_linenumber AS VARCHAR) || '}', ',' ORDER BY l_linenumber) || ']' AS lines_json
FROM lineitem GROUP BY 1
"""

ORACLE_SQL["other_case_names"] = """
SELECT DISTINCT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type FROM events
"""

ORACLE_SQL["trailing_partition_days"] = f"""
SELECT * FROM ({_EVENT_ROWS}) e WHERE transaction_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'
"""

_ZONED = "date_trunc('second', ts) - to_hours(CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 9 ELSE 0 END)"
ORACLE_SQL["cast_timestamp_named_zones"] = f"""
SELECT event_id, {_ZONED} AS utc_wall_clock, epoch_us({_ZONED}) AS instant_us, CAST(NULL AS TIMESTAMP) AS no_day
FROM events WHERE ts IS NOT NULL
"""
