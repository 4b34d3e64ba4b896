"""SQL that computes the result of each registered query straight from the tables,
without any JSON in between."""

from __future__ import annotations

from tidemark.plans.queries import KEYS

# --- shared relations ----------------------------------------------------------------

_EV = """
ev AS (
  SELECT event_id AS pos, user_id, user_id % 4 AS part, epoch_us(ts) // 1000 AS ts_ms, value, props, event_type,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
         CASE WHEN event_type = 'purchase' THEN NULL ELSE value END AS sent_value
  FROM events)"""

_STEPS = """
steps AS (
  SELECT o.*, s.k, o_orderkey * 4 + s.k AS pos, epoch_us(o_orderdate) // 1000 AS ms,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE WHEN s.k = 1 THEN 'u' WHEN s.k = 2 THEN 'd' WHEN s.k = 0 AND o_orderkey % 2 = 0 THEN 'r' ELSE 'c' END AS op,
         CASE s.k WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'INSERT' END AS operation
  FROM orders o JOIN (VALUES (0), (1), (2), (3)) s(k)
    ON s.k = 0 OR (s.k = 1 AND o_orderkey % 3 = 0) OR (s.k = 2 AND o_orderkey % 5 = 0)
       OR (s.k = 3 AND o_orderkey % 35 = 0))"""

_MESSAGES = """
msg AS (
  SELECT c.*, s.k, (conv_id * 100000 + turn) * 4 + s.k AS pos, 1700000000000 + turn * 1000 + s.k AS ts_ms,
         CASE s.k WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'c' END AS op
  FROM conversations c JOIN (VALUES (0), (1), (2)) s(k)
    ON s.k = 0 OR (s.k = 1 AND role = 'assistant') OR (s.k = 2 AND turn % 3 = 0))"""

_HOSTILE = """
hostile AS (
  SELECT c_custkey + 1000000000 AS user_id, c_name, c_nationkey % 13 AS kind,
         CASE c_nationkey % 13 WHEN 5 THEN 'mysql_src.shop.nosuch' WHEN 6 THEN 'mysql_src.shop.log'
              WHEN 11 THEN 'mysql_src.shop' WHEN 12 THEN 'mysql_src.shop.audit'
              ELSE 'mysql_src.shop.user_state' END AS topic,
         CASE c_nationkey % 13 WHEN 5 THEN 'nosuch' WHEN 6 THEN 'log' WHEN 12 THEN 'audit' ELSE 'user_state' END AS tbl,
         CASE c_nationkey % 13 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'd' WHEN 3 THEN 'x' WHEN 4 THEN NULL
              WHEN 8 THEN 'u' ELSE 'c' END AS op,
         CASE c_nationkey % 13 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'DELETE' WHEN 3 THEN 'UNKNOWN'
              WHEN 4 THEN 'UNKNOWN' WHEN 8 THEN 'UPDATE' ELSE 'INSERT' END AS operation,
         CASE c_nationkey % 13 WHEN 0 THEN 'parse_error' WHEN 1 THEN 'parse_error' WHEN 2 THEN 'missing_key'
              WHEN 3 THEN 'unknown_operation' WHEN 4 THEN 'unknown_operation' WHEN 5 THEN 'unknown_table'
              WHEN 7 THEN 'missing_key' WHEN 8 THEN 'no_columns_to_update' WHEN 9 THEN 'cast_error'
              WHEN 10 THEN 'unknown_column' WHEN 12 THEN 'no_primary_key' END AS reason
  FROM customer)"""

_LOG = f"""
WITH {_EV}, {_STEPS}, {_MESSAGES}, {_HOSTILE},
log AS (
  SELECT 'mysql_src.shop.user_state' AS topic, part AS part, pos, op, operation, ts_ms, 'shop' AS db,
         'user_state' AS tbl, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS deleted, FALSE AS parse_error
  FROM ev
  UNION ALL
  SELECT 'mysql_src.shop.orders', o_orderkey % 8, pos, op, operation, ms + k * 1000, 'shop', 'orders',
         CASE WHEN op = 'd' THEN 'true' ELSE 'false' END, FALSE
  FROM steps
  UNION ALL
  SELECT 'mysql_src.shop.messages', conv_id % 4, pos, op,
         CASE op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'INSERT' END, ts_ms, 'shop', 'messages',
         CASE WHEN op = 'd' THEN 'true' ELSE 'false' END, FALSE
  FROM msg
  UNION ALL
  SELECT topic, user_id % 4, user_id, op, operation, CASE WHEN kind > 2 THEN 1710000000000 END,
         CASE WHEN kind > 2 THEN 'shop' END, tbl,
         CASE WHEN kind = 2 THEN 'true' WHEN kind > 2 THEN 'false' END, kind < 2
  FROM hostile)"""

_PRICE = "printf('%d.%02d', {0} // 100, {0} % 100)"


def _toronto(wall: str) -> str:
    return f"epoch_us(timezone('America/Toronto', {wall})) // 1000"


_ORDERED = "o_orderdate + to_milliseconds(o_orderkey % 1000)"
_TIME_MS = "greatest(o_orderkey * 7919 % 400000000 - 1000, 0)"
_TIME_TEXT = (
    f"printf('%02d:%02d:%02d', {_TIME_MS} // 3600000, {_TIME_MS} // 60000 % 60, {_TIME_MS} // 1000 % 60)"
)
_SIX = "o_orderdate + INTERVAL '6 hours 7 minutes 8 seconds'"
_PLACED = f"""CASE o_orderkey % 4 WHEN 0 THEN epoch_us({_SIX}) // 1000
     WHEN 3 THEN epoch_us({_SIX} - INTERVAL '2 hours') // 1000 ELSE {_toronto(_SIX)} END"""
_URGENT = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority LIKE '1%' END"
_NOTE = "hex(encode(o_orderpriority))"

# What is left of an orders row once all its events are applied.
_STATUS = "CASE WHEN o_orderkey % 35 <> 0 AND o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END"
_CENTS = (
    "(CAST(round(o_totalprice * 100) AS BIGINT)"
    " + CASE WHEN o_orderkey % 35 <> 0 AND o_orderkey % 3 = 0 THEN 100 ELSE 0 END)"
)
_DELETED = (
    "CASE WHEN o_orderkey % 35 <> 0 AND o_orderkey % 5 = 0 THEN epoch_us(o_orderdate) // 1000 + 2000 END"
)

_USER_STATE = f"""
WITH {_EV}, {_HOSTILE},
first AS (SELECT user_id, min(pos) AS first_pos FROM ev WHERE operation = 'INSERT' GROUP BY user_id),
applied AS (SELECT ev.* FROM ev JOIN first USING (user_id) WHERE pos >= first_pos),
state AS (
  SELECT user_id,
         arg_max_null(sent_value, pos) FILTER (operation <> 'DELETE') AS value,
         arg_max_null(props, pos) FILTER (operation = 'INSERT') AS props,
         arg_max_null(event_type, pos) FILTER (operation <> 'DELETE') AS last_type,
         arg_max_null(CASE WHEN operation = 'DELETE' THEN ts_ms END, pos) FILTER (operation <> 'UPDATE') AS deleted_ms
  FROM applied GROUP BY user_id)"""

_STATE_ROWS = f"{_USER_STATE} SELECT user_id, value, props, last_type, deleted_ms FROM state"

_RAW_TAIL = (
    """',"__ts_ms":1710000000000,"__source_db":"shop","__source_table":"user_state","__deleted":"false"}'"""
)
_RAW_OP = """',"__op":"' || op || '"'"""
_RAW_NAME = """'"last_type":"' || c_name || '"'"""
_RAW_ID = """'{"user_id":' || user_id"""
_RAW = f"""CASE kind WHEN 0 THEN '{{bad' WHEN 1 THEN '[1]' WHEN 2 THEN NULL
     WHEN 4 THEN {_RAW_ID} || ',' || {_RAW_NAME} || {_RAW_TAIL}
     WHEN 7 THEN '{{' || {_RAW_NAME} || {_RAW_OP} || {_RAW_TAIL}
     WHEN 8 THEN {_RAW_ID} || {_RAW_OP} || {_RAW_TAIL}
     WHEN 9 THEN {_RAW_ID} || ',"value":"many"' || {_RAW_OP} || {_RAW_TAIL}
     WHEN 10 THEN {_RAW_ID} || ',' || {_RAW_NAME} || ',"color":1' || {_RAW_OP} || {_RAW_TAIL}
     WHEN 12 THEN '{{"c_name":"' || c_name || '"' || {_RAW_OP} || {_RAW_TAIL}
     ELSE {_RAW_ID} || ',' || {_RAW_NAME} || {_RAW_OP} || {_RAW_TAIL} END"""

_REJECTED = "reason IS NOT NULL"

# Types of the given tables' columns as a catalog spells them.
_COLUMNS = {
    "region": "r_regionkey int, r_name varchar",
    "nation": "n_nationkey int, n_name varchar, n_regionkey int",
    "customer": "c_custkey bigint, c_name varchar, c_nationkey int, c_acctbal double, c_mktsegment varchar",
    "supplier": "s_suppkey bigint, s_name varchar, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name varchar, p_brand varchar, p_type varchar, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double, "
    "o_orderdate datetime, o_orderpriority varchar",
    "events": "event_id bigint, ts datetime, user_id bigint, event_type varchar, value double, props varchar",
    "documents": "doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint",
    "embeddings": "vec_id bigint, embedding json, label int",
    "pages": "page_id bigint, url varchar, html varchar",
    "benchmark": "item_id bigint, text varchar",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role varchar, text varchar",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag varchar, l_linestatus varchar, "
    "l_shipdate datetime",
}


def _catalog_sql() -> str:
    parts = []
    for name, columns in _COLUMNS.items():
        keys = KEYS.get(name, [])
        for ordinal, item in enumerate(columns.split(", "), 1):
            column, kind = item.split(" ")
            pk_pos = keys.index(column) + 1 if column in keys else "NULL"
            parts.append(
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, {ordinal} AS ordinal, '{kind}' AS data_type,"
                f" count({column}) < count(*) AS nullable, CAST({pk_pos} AS INTEGER) AS pk_pos FROM {name}"
            )
    return "\nUNION ALL ".join(parts)


_POSITIONS = 'count(*) AS n_rows, min(pos) AS first_offset, max(pos) AS last_offset'
_ORDERS_FIELD = "WITH " + _STEPS + " SELECT pos AS \"offset\", k <> 1 AS carried, {0} FROM steps"
# Snapshot of the seen columns of every table, for the reconcile queries.
_SEEN = f"""
WITH {_HOSTILE},
seen AS (
  SELECT DISTINCT 'user_state' AS table_name, unnest(['user_id', 'value', 'props', 'last_type']) AS column_name FROM events
  UNION SELECT DISTINCT 'orders', unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
    'o_orderday', 'o_ordertime', 'o_orderedat', 'o_orderpriority', 'o_urgent', 'o_note']) FROM orders
  UNION SELECT DISTINCT 'messages', unnest(['conv_id', 'turn', 'role', 'text']) FROM conversations
  UNION SELECT DISTINCT 'messages', 'n_chars' FROM conversations WHERE role = 'assistant'
  UNION SELECT DISTINCT 'user_state', 'color' FROM hostile WHERE kind = 10
  UNION SELECT DISTINCT tbl, unnest(['user_id', 'last_type']) FROM hostile WHERE kind IN (3, 4, 5, 6, 11)
  UNION SELECT DISTINCT 'audit', 'c_name' FROM hostile WHERE kind = 12),
target AS (
  SELECT 'user_state' AS table_name, unnest(['user_id', 'value', 'props', 'last_type', 'deleted_at']) AS column_name
  UNION SELECT 'orders', unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
    'o_orderday', 'o_ordertime', 'o_orderedat', 'o_orderpriority', 'o_urgent', 'o_note', 'deleted_at'])
  UNION SELECT 'messages', unnest(['conv_id', 'turn', 'role', 'text', 'n_chars', 'deleted_at'])
  UNION SELECT 'audit', unnest(['c_name', 'deleted_at']))"""

_BUCKETS = "0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10".split(", ")


def _histogram_sql() -> str:
    bounds = ", ".join(f"('{b}', CAST({b} AS DOUBLE))" for b in _BUCKETS) + ", ('+Inf', CAST('inf' AS DOUBLE))"
    return f"""
WITH {_EV},
batches AS (SELECT pos // 100 AS batch, count(*) AS n, (max(ts_ms) - min(ts_ms)) / 100000.0::DOUBLE AS seconds
            FROM ev GROUP BY 1),
d AS (SELECT operation, seconds / n AS duration FROM ev JOIN batches ON batch = pos // 100),
b AS (SELECT * FROM (VALUES {bounds}) v(le, bound))
SELECT 'user_state' AS source_table, operation, count(*) AS observations, round(sum(duration), 3) AS total_seconds,
       le, count(*) FILTER (duration <= bound) AS cumulative
FROM d, b GROUP BY operation, le"""


ORACLES: dict[str, str] = {
    "cdc_source_prefix": f"""{_LOG} SELECT topic, CAST(part AS INTEGER) AS partition, {_POSITIONS}
        FROM log WHERE topic LIKE 'mysql_src.shop.%' GROUP BY topic, part""",
    "cdc_start_offset": f"""WITH {_EV},
        last AS (SELECT part, max(pos) FILTER (operation = 'INSERT') AS taken FROM ev GROUP BY part)
        SELECT 'mysql_src.shop.user_state' AS topic, CAST(part AS INTEGER) AS partition, {_POSITIONS},
               'earliest' AS start FROM ev GROUP BY part
        UNION ALL
        SELECT 'mysql_src.shop.user_state', CAST(part AS INTEGER), count(*), min(pos), max(pos), 'after_last_insert'
        FROM ev JOIN last USING (part) WHERE taken IS NULL OR pos > taken GROUP BY part""",
    "cdc_snapshot_bootstrap": f"""SELECT o_orderkey, o_custkey, {_STATUS} AS o_orderstatus,
        {_PRICE.format(_CENTS)} AS price, {_toronto(_ORDERED)} AS ordered_ms, o_orderpriority, {_DELETED} AS deleted_ms
        FROM orders""",
    "cdc_replay_rebuild": f"""{_STATE_ROWS}
        UNION ALL SELECT user_id, NULL, NULL, c_name, NULL FROM hostile WHERE kind = 11""",
    "schema_catalog": _catalog_sql(),
    "cdc_parse_envelope": f"""{_LOG} SELECT topic, CAST(part AS INTEGER) AS partition, pos AS "offset", parse_error, op,
        ts_ms, db AS source_db, tbl AS source_table, deleted FROM log""",
    "cdc_tombstones": f"""WITH {_HOSTILE} SELECT user_id AS "offset", 'd' AS op, 'DELETE' AS operation,
        'true' AS deleted, 'missing_key' AS reason FROM hostile WHERE kind = 2""",
    "cdc_topic_route": f"""{_LOG} SELECT topic, tbl AS source_table, count(*) AS n_events FROM log GROUP BY ALL""",
    "cdc_classify_ops": f"""{_LOG} SELECT tbl AS source_table, op, operation, count(*) AS n_events
        FROM log GROUP BY ALL""",
    "cdc_event_time": f"""WITH {_EV} SELECT pos AS "offset", ts_ms AS event_ms,
        strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS event_time FROM ev""",
    "cdc_meta_strip": f"""WITH {_EV} SELECT pos AS "offset",
        CASE WHEN op IN ('c', 'd') THEN 'last_type,props,user_id,value' ELSE 'last_type,user_id,value' END
          AS column_names,
        CASE WHEN event_type = 'purchase' OR value IS NULL THEN 1 ELSE 0 END
          + CASE WHEN op IN ('c', 'd') AND props IS NULL THEN 1 ELSE 0 END AS n_nulls,
        event_type AS last_type FROM ev""",
    "cdc_exclude_tables": f"""{_LOG} SELECT tbl AS source_table, count(*) AS n_events FROM log
        WHERE tbl <> 'log' GROUP BY tbl""",
    "cdc_reject_reasons": f"""WITH {_HOSTILE} SELECT topic, user_id AS "offset", tbl AS source_table, operation, reason
        FROM hostile WHERE {_REJECTED}""",
    "cdc_datetime_instant": _ORDERS_FIELD.format(f"CASE WHEN k <> 1 THEN {_toronto(_ORDERED)} END AS ordered_ms"),
    "cdc_datetime_target_text": _ORDERS_FIELD.format(
        f"""CASE WHEN k <> 1 THEN strftime(timezone('Asia/Tokyo', timezone('America/Toronto', {_ORDERED})),
        '%Y-%m-%d %H:%M:%S') END AS ordered_text"""
    ),
    "cdc_datetime_iso": _ORDERS_FIELD.format(f"CASE WHEN k <> 1 THEN {_PLACED} END AS ordered_ms"),
    "cdc_date": _ORDERS_FIELD.format(
        "CASE WHEN k <> 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day"
    ),
    "cdc_time": _ORDERS_FIELD.format(f"CASE WHEN k <> 1 THEN {_TIME_TEXT} END AS order_time"),
    "cdc_bool": f"""WITH {_STEPS} SELECT pos AS "offset", k IN (0, 2) AS carried,
        CASE WHEN k IN (0, 2) THEN {_URGENT} END AS urgent FROM steps""",
    "cdc_decimal_binary": f"""WITH {_STEPS} SELECT pos AS "offset",
        {_PRICE.format("(cents + CASE WHEN k = 1 THEN 100 ELSE 0 END)")} AS price,
        CASE WHEN k IN (0, 2) THEN {_NOTE} END AS note_hex FROM steps""",
    "cdc_passthrough_cast": f"""WITH {_EV}, {_HOSTILE}
        SELECT 'mysql_src.shop.user_state' AS topic, pos AS "offset", user_id, sent_value AS value,
               CASE WHEN operation <> 'UPDATE' THEN props END AS props, event_type AS last_type FROM ev
        UNION ALL
        SELECT topic, user_id, CASE WHEN kind IN (0, 1, 2, 7) THEN NULL ELSE user_id END, NULL, NULL,
               CASE WHEN kind IN (0, 1, 2, 8, 9) THEN NULL ELSE c_name END
        FROM hostile WHERE tbl = 'user_state'""",
    "cdc_typed_projection": f"""WITH {_STEPS} SELECT pos AS "offset", operation, CAST(NULL AS VARCHAR) AS reason,
        o_orderkey, CASE WHEN k <> 1 THEN o_custkey END AS o_custkey,
        CASE WHEN k = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
        {_PRICE.format("(cents + CASE WHEN k = 1 THEN 100 ELSE 0 END)")} AS price,
        CASE WHEN k <> 1 THEN {_toronto(_ORDERED)} END AS ordered_ms,
        CASE WHEN k <> 1 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day,
        CASE WHEN k <> 1 THEN {_TIME_TEXT} END AS order_time,
        CASE WHEN k <> 1 THEN {_PLACED} END AS placed_ms,
        CASE WHEN k IN (0, 2) THEN o_orderpriority END AS o_orderpriority,
        CASE WHEN k IN (0, 2) THEN {_URGENT} END AS urgent,
        CASE WHEN k IN (0, 2) THEN {_NOTE} END AS note_hex FROM steps""",
    "cdc_column_resolve": f"""WITH {_STEPS} SELECT pos AS "offset",
        CASE k WHEN 1 THEN 'o_orderkey,o_orderstatus,o_totalprice'
             WHEN 3 THEN 'o_custkey,o_orderdate,o_orderday,o_orderedat,o_orderkey,o_orderstatus,o_ordertime,o_totalprice'
             ELSE 'o_custkey,o_note,o_orderdate,o_orderday,o_orderedat,o_orderkey,o_orderpriority,o_orderstatus,'
                  || 'o_ordertime,o_totalprice,o_urgent' END AS column_names,
        o_orderkey FROM steps""",
    "cdc_upsert": f"""SELECT o_orderkey, o_custkey, {_STATUS} AS o_orderstatus, {_PRICE.format(_CENTS)} AS price,
        {_toronto(_ORDERED)} AS ordered_ms, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
        {_TIME_TEXT} AS order_time, {_PLACED} AS placed_ms, o_orderpriority, {_URGENT} AS urgent, {_NOTE} AS note_hex
        FROM orders""",
    "cdc_undelete": f"{_USER_STATE} SELECT user_id, deleted_ms IS NULL AS is_live, deleted_ms FROM state",
    "cdc_partial_update": f"{_USER_STATE} SELECT user_id, value, props, last_type FROM state",
    "cdc_soft_delete": f"SELECT o_orderkey, {_STATUS} AS o_orderstatus, {_DELETED} AS deleted_ms FROM orders",
    "cdc_fold": f"""WITH {_EV} SELECT user_id, count(*) AS n_events,
        min(pos) FILTER (operation = 'INSERT') AS first_insert,
        arg_max_null(sent_value, pos) FILTER (operation <> 'DELETE') AS value,
        max(pos) FILTER (operation <> 'DELETE') AS value_at,
        arg_max_null(props, pos) FILTER (operation = 'INSERT') AS props,
        max(pos) FILTER (operation = 'INSERT') AS props_at,
        arg_max_null(event_type, pos) FILTER (operation <> 'DELETE') AS last_type,
        arg_max_null(CASE WHEN operation = 'DELETE' THEN ts_ms END, pos) FILTER (operation <> 'UPDATE') AS deleted_ms,
        max(pos) FILTER (operation <> 'UPDATE') AS deleted_at_offset
        FROM ev GROUP BY user_id""",
    "cdc_replica_merge": _STATE_ROWS,
    "cdc_composite_key": """SELECT conv_id, turn, role, text,
        CAST(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS INTEGER) AS n_chars,
        CASE WHEN turn % 3 = 0 THEN 1700000000000 + turn * 1000 + 2 END AS deleted_ms FROM conversations""",
    "cdc_insert_defaults": """SELECT role, CAST(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS INTEGER)
        AS n_chars, count(*) AS n_messages FROM conversations GROUP BY ALL""",
    "cdc_multi_table": f"""{_USER_STATE},
        users AS (SELECT deleted_ms FROM state UNION ALL SELECT NULL FROM hostile WHERE kind = 11)
        SELECT 'user_state' AS table_name, count(*) AS n_rows, count(*) FILTER (deleted_ms IS NULL) AS n_live FROM users
        UNION ALL SELECT 'orders', count(*), count(*) FILTER (({_DELETED}) IS NULL) FROM orders
        UNION ALL SELECT 'messages', count(*), count(*) FILTER (turn % 3 <> 0) FROM conversations""",
    "cdc_dlq_rows": f"""WITH {_HOSTILE} SELECT coalesce(op, '') AS op,
        CASE WHEN kind > 2 THEN 1710000000000 ELSE 0 END AS ts_ms,
        CASE WHEN kind > 2 THEN 'shop' ELSE '' END AS source_db, tbl AS source_table,
        CASE WHEN kind = 2 THEN 'true' WHEN kind > 2 THEN 'false' ELSE '' END AS deleted,
        user_id AS "offset", {_RAW} AS raw,
        CASE WHEN reason IN ('parse_error', 'unknown_table', 'unknown_operation') THEN 'parse' ELSE 'apply' END AS stage,
        reason AS error, 1710000000000 AS rejected_ms, 0 AS retries
        FROM hostile WHERE {_REJECTED}""",
    "cdc_dlq_count": f"WITH {_HOSTILE} SELECT count(*) AS entries FROM hostile WHERE {_REJECTED}",
    "stats_processed": f"""{_LOG}, fine AS (
          SELECT tbl, operation FROM log WHERE pos < 1000000000 OR tbl IN ('orders', 'messages')
          UNION ALL SELECT tbl, operation FROM hostile WHERE kind = 11)
        SELECT tbl AS source_table, operation, count(*) AS events FROM fine GROUP BY ALL""",
    "stats_failed": f"""WITH {_HOSTILE} SELECT tbl AS source_table, operation, reason AS error_type, count(*) AS events
        FROM hostile WHERE {_REJECTED} GROUP BY ALL""",
    "stats_duration_histogram": _histogram_sql(),
    "stats_lag": f"""{_LOG} SELECT topic, CAST(part AS INTEGER) AS partition, max(pos) AS end_offset,
        max(pos) FILTER (operation = 'INSERT') AS applied_offset,
        max(pos) - coalesce(max(pos) FILTER (operation = 'INSERT'), min(pos) - 1) AS lag
        FROM log WHERE topic LIKE 'mysql_src.shop.%' GROUP BY topic, part""",
    "bootstrap_snapshot": f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        {_PRICE.format("CAST(round(o_totalprice * 100) AS BIGINT)")} AS price, {_toronto("o_orderdate")} AS ordered_ms,
        o_orderpriority, CAST(NULL AS BIGINT) AS deleted_ms FROM orders""",
    "bootstrap_table_list": f"""{_LOG},
        spelled AS (SELECT CASE WHEN part = 0 THEN upper(tbl) ELSE tbl END AS name, min(pos) AS pos FROM log GROUP BY 1)
        SELECT lower(name) AS replica_table, arg_min(name, pos) AS source_table
        FROM spelled WHERE lower(name) <> 'log' GROUP BY 1""",
    "reconcile_schema": f"""{_SEEN}
        SELECT table_name, column_name, 'missing_in_target' AS side
        FROM (SELECT * FROM seen WHERE table_name <> 'log' EXCEPT SELECT * FROM target)
        UNION ALL
        SELECT table_name, column_name, 'missing_in_source'
        FROM (SELECT * FROM target WHERE column_name <> 'deleted_at' EXCEPT SELECT * FROM seen)""",
    "reconcile_counts": f"""{_SEEN}
        SELECT *, target_tables = expected_tables AS counts_match, with_deleted_at = target_tables AS all_with_deleted_at
        FROM (SELECT (SELECT count(DISTINCT table_name) FROM seen) AS source_tables,
               (SELECT count(DISTINCT table_name) FROM seen WHERE table_name <> 'log') AS expected_tables,
               (SELECT count(DISTINCT table_name) FROM target) AS target_tables,
               (SELECT count(DISTINCT table_name) FROM target WHERE column_name = 'deleted_at') AS with_deleted_at)""",
    "reconcile_tables": f"""{_SEEN}
        SELECT table_name, 'missing_in_target' AS side
        FROM (SELECT table_name FROM seen WHERE table_name <> 'log' EXCEPT SELECT table_name FROM target)
        UNION ALL
        SELECT table_name, 'missing_in_source' FROM (SELECT table_name FROM target EXCEPT SELECT table_name FROM seen)""",
}
ORACLES["cdc_stream_replica"] = _STATE_ROWS
ORACLES["cdc_stream_resume"] = _STATE_ROWS
ORACLES["cdc_rebuild_then_stream"] = _STATE_ROWS
ORACLES["cdc_stream_tables"] = f"""{ORACLES["cdc_multi_table"]}
    UNION ALL SELECT 'dead_letters', count(*), count(*) FROM hostile WHERE {_REJECTED}"""
ORACLES["cdc_delta_replica"] = f"SELECT * FROM ({_STATE_ROWS}), (VALUES (FALSE), (TRUE)) c(compacted)"
ORACLES["cdc_out_of_order"] = _STATE_ROWS
_AT_ONCE = f"""SELECT '{{0}}' AS moment, count(*) AS n_users, count(*) FILTER (deleted_ms IS NULL) AS n_live,
    (SELECT count(*) FROM ev WHERE {{1}}) AS n_activities, (SELECT max(pos) FROM ev WHERE {{1}}) AS last_event FROM (
      SELECT user_id, arg_max_null(CASE WHEN operation = 'DELETE' THEN ts_ms END, pos) FILTER (operation <> 'UPDATE') AS deleted_ms
      FROM ev WHERE {{1}} GROUP BY user_id HAVING count(*) FILTER (operation = 'INSERT') > 0)"""
ORACLES["cdc_consistent_snapshot"] = (
    f"WITH {_EV} {_AT_ONCE.format('stopped', 'ts_ms < 1704931200000')} UNION ALL {_AT_ONCE.format('resumed', 'TRUE')}"
)
ORACLES["cdc_late_table"] = f"""{ORACLES["cdc_multi_table"]}
    UNION ALL SELECT 'orders_with_note', count(*), count(*) FROM orders
    UNION ALL SELECT 'waiting', count(*), count(*) FROM hostile WHERE kind IN (5, 10)
    UNION ALL SELECT 'dead_letters', count(*), count(*) FROM hostile WHERE {_REJECTED} AND kind NOT IN (5, 10)"""
ORACLES["cdc_rebucket"] = ORACLES["cdc_upsert"].replace("SELECT o_orderkey,", f"SELECT {_DELETED} AS deleted_ms, o_orderkey,", 1)
ORACLES["stats_observed"] = ORACLES["stats_processed"]
ORACLES["cdc_redelivered"] = f"""WITH {_EV} SELECT 'user_state' AS source_table, operation, count(*) AS events
    FROM ev GROUP BY operation"""
