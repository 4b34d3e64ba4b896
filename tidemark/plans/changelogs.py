"""Change logs derived from the given tables, shaped like topic rows.

Every log grows with its table; nothing is sampled or invented beyond the rules below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.sources.changelog import LOG_SCHEMA

PREFIX = "mysql_src.shop."
SOURCE_ZONE = "America/Toronto"
EXCLUDED = ["log"]

USER_STATE = TableSchema(
    "user_state",
    (
        ColumnSpec("user_id", "bigint", 1, nullable=False, pk_pos=1),
        ColumnSpec("value", "double", 2),
        ColumnSpec("props", "json", 3),
        ColumnSpec("last_type", "varchar", 4, precision=16),
    ),
)
ORDERS = TableSchema(
    "orders",
    (
        ColumnSpec("o_orderkey", "bigint", 1, nullable=False, pk_pos=1),
        ColumnSpec("o_custkey", "bigint", 2),
        ColumnSpec("o_orderstatus", "char", 3, precision=1),
        ColumnSpec("o_totalprice", "decimal", 4, precision=15, scale=2),
        ColumnSpec("o_orderdate", "datetime", 5),
        ColumnSpec("o_orderday", "date", 6),
        ColumnSpec("o_ordertime", "time", 7),
        ColumnSpec("o_orderedat", "timestamp", 8),
        ColumnSpec("o_orderpriority", "varchar", 9, precision=15, default="none"),
        ColumnSpec("o_urgent", "bit", 10, default="b'0'"),
        ColumnSpec("o_note", "blob", 11),
    ),
)
MESSAGES = TableSchema(
    "messages",
    (
        ColumnSpec("turn", "bigint", 1, nullable=False, pk_pos=2),
        ColumnSpec("conv_id", "bigint", 2, nullable=False, pk_pos=1),
        ColumnSpec("role", "varchar", 3, precision=16),
        ColumnSpec("text", "longtext", 4),
        ColumnSpec("n_chars", "int", 5, default="0"),
    ),
)
AUDIT = TableSchema("audit", (ColumnSpec("c_name", "varchar", 1, precision=64),))
ACTIVITY = TableSchema(
    "activity",
    (
        ColumnSpec("event_id", "bigint", 1, nullable=False, pk_pos=1),
        ColumnSpec("user_id", "bigint", 2),
        ColumnSpec("kind", "varchar", 3, precision=16),
    ),
)
CATALOG = {t.table: t for t in (USER_STATE, ORDERS, MESSAGES, AUDIT)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table for a log, its rows dealt over tasks by size.

    A compact row becomes a JSON text many times as long, and a file of few row groups is read by as few tasks.
    """
    return table(spark, sf_dir, name).hint("rebalance", *keys)


def epoch_ms(at: Column) -> Column:
    """Milliseconds of a wall clock without zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)


def _json(*fields: Column | str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _meta(op: Column, ts_ms: Column, table_name: str) -> list[Column]:
    return [
        op.alias("__op"),
        ts_ms.alias("__ts_ms"),
        F.lit("shop").alias("__source_db"),
        F.lit(table_name).alias("__source_table"),
        F.when(op == "d", "true").otherwise("false").alias("__deleted"),
    ]


def _log(frame: DataFrame, topic: Column, partition: Column, offset: Column, ts_ms: Column, key: Column, value: Column):
    columns = (topic, partition, offset, F.timestamp_millis(ts_ms), key, value)
    return frame.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, LOG_SCHEMA.fields)])


def user_state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as changes of user_state: many events per key, some before the first insert."""
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    ts_ms = epoch_ms(F.col("ts"))
    meta = _meta(op, ts_ms, "user_state")
    full = _json("user_id", "value", "props", kind.alias("last_type"), *meta)
    short = _json("user_id", "value", kind.alias("last_type"), *meta)
    blank = _json("user_id", F.lit(None).cast("double").alias("value"), kind.alias("last_type"), *meta)
    value = F.when(kind.isin("signup", "error"), full).when(kind == "purchase", blank).otherwise(short)
    return _log(
        _dealt(spark, sf_dir, "events", "event_id"),
        F.lit(PREFIX + "user_state"),
        F.pmod("user_id", F.lit(4)),
        F.col("event_id"),
        ts_ms,
        _json("user_id"),
        value,
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as inserts of activity, a child table of user_state, with the times of its parent's changes."""
    ts_ms = epoch_ms(F.col("ts"))
    meta = _meta(F.lit("c"), ts_ms, "activity")
    return _log(
        _dealt(spark, sf_dir, "events", "event_id"),
        F.lit(PREFIX + "activity"),
        F.pmod("event_id", F.lit(4)),
        F.col("event_id"),
        ts_ms,
        _json("event_id"),
        _json("event_id", "user_id", F.col("event_type").alias("kind"), *meta),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as changes of a mixed-case table: snapshot or insert, then up to three more.

    Every third row gets an update, every fifth a delete, every 35th is inserted again
    without its priority.
    """
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    midnight = epoch_ms(F.col("o_orderdate"))
    base = _dealt(spark, sf_dir, "orders", "o_orderkey").select(
        key,
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        cents.alias("cents"),
        midnight.alias("ms"),
        F.explode(
            F.filter(
                F.array(
                    F.lit("base"),
                    F.when(key % 3 == 0, F.lit("update")),
                    F.when(key % 5 == 0, F.lit("delete")),
                    F.when(key % 35 == 0, F.lit("again")),
                ),
                lambda step: step.isNotNull(),
            )
        ).alias("step"),
    )
    step = F.col("step")
    rank = F.when(step == "base", 0).when(step == "update", 1).when(step == "delete", 2).otherwise(3)
    op = F.when(step == "update", "u").when(step == "delete", "d").when((step == "base") & (key % 2 == 0), "r").otherwise("c")
    ts_ms = F.col("ms") + rank * 1000
    meta = _meta(op, ts_ms, "orders")

    def money(amount: Column) -> Column:
        whole = F.floor(amount / 100).cast("bigint").cast("string")
        return F.concat(whole, F.lit("."), F.lpad((amount % 100).cast("string"), 2, "0"))

    day = F.floor(F.col("ms") / 86400000).cast("bigint")
    date_text = F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).cast("string")
    iso = (
        F.when(key % 4 == 0, F.concat(date_text, F.lit("T06:07:08Z")))
        .when(key % 4 == 1, F.concat(date_text, F.lit("T06:07:08")))
        .when(key % 4 == 2, F.concat(date_text, F.lit(" 06:07:08")))
        .otherwise(F.concat(date_text, F.lit("T06:07:08+02:00")))
    )
    row = [
        key.alias("O_OrderKey"),
        F.col("o_custkey").alias("O_CustKey"),
        F.col("o_orderstatus").alias("O_OrderStatus"),
        money(F.col("cents")).alias("O_TotalPrice"),
        (F.col("ms") + key % 1000).alias("O_OrderDate"),
        day.alias("O_OrderDay"),
        (key * 7919 % 400000000 - 1000).alias("O_OrderTime"),
        iso.alias("O_OrderedAt"),
    ]
    urgent = F.when(key % 2 == 0, F.col("o_orderpriority").startswith("1").cast("int").cast("string"))
    rest = [
        urgent.alias("O_Urgent"),
        F.base64(F.encode("o_orderpriority", "UTF-8")).alias("O_Note"),
    ]
    full = _json(*row, F.col("o_orderpriority").alias("O_OrderPriority"), *rest, *meta)
    again = _json(*row, *meta)
    update = _json(
        key.alias("O_OrderKey"),
        F.lit("U").alias("O_OrderStatus"),
        money(F.col("cents") + 100).alias("O_TotalPrice"),
        *meta,
    )
    value = F.when(step == "update", update).when(step == "again", again).otherwise(full)
    return _log(
        base,
        F.lit(PREFIX + "orders"),
        F.pmod(key, F.lit(8)),
        key * 4 + rank,
        ts_ms,
        _json(key.alias("O_OrderKey")),
        value,
    )


def messages_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as changes of messages, key (conv_id, turn).

    Assistant turns are updated with their length, every third turn is deleted.
    """
    steps = F.array(
        F.lit(0), F.when(F.col("role") == "assistant", F.lit(1)), F.when(F.col("turn") % 3 == 0, F.lit(2))
    )
    base = _dealt(spark, sf_dir, "conversations", "conv_id", "turn").select(
        "*", F.explode(F.filter(steps, lambda s: s.isNotNull())).alias("step")
    )
    step = F.col("step")
    op = F.when(step == 1, "u").when(step == 2, "d").otherwise("c")
    ts_ms = F.lit(1700000000000) + F.col("turn") * 1000 + step
    meta = _meta(op, ts_ms, "messages")
    keys = ["conv_id", "turn"]
    value = (
        F.when(step == 1, _json(*keys, F.length("text").alias("n_chars"), *meta))
        .when(step == 2, _json(*keys, *meta))
        .otherwise(_json(*keys, "role", "text", *meta))
    )
    offset = (F.col("conv_id") * 100000 + F.col("turn")) * 4 + step
    topic = F.lit(PREFIX + "messages")
    return _log(base, topic, F.pmod("conv_id", F.lit(4)), offset, ts_ms, _json(*keys), value)


# What is wrong with the hostile row of a customer, by nation key modulo their number.
HOSTILE_KINDS = (
    "bad_json",
    "array",
    "tombstone",
    "op_x",
    "no_op",
    "table_unknown",
    "table_excluded",
    "no_key",
    "key_only_update",
    "not_a_number",
    "extra_column",
    "two_part_topic",
    "table_without_key",
)
HOSTILE_FIRST_ID = 1_000_000_000


def hostile_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as log rows of which all but one kind cannot be applied."""
    base = _dealt(spark, sf_dir, "customer", "c_custkey").select(
        (F.col("c_custkey") + HOSTILE_FIRST_ID).alias("user_id"),
        "c_name",
        F.get(F.array(*[F.lit(k) for k in HOSTILE_KINDS]), F.col("c_nationkey") % len(HOSTILE_KINDS)).alias("kind"),
    )
    kind = F.col("kind")
    ts_ms = F.lit(1710000000000)
    insert = _meta(F.lit("c"), ts_ms, "user_state")
    who = F.col("user_id")
    name = F.col("c_name").alias("last_type")
    value = (
        F.when(kind == "bad_json", F.lit("{bad"))
        .when(kind == "array", F.lit("[1]"))
        .when(kind == "tombstone", F.lit(None))
        .when(kind == "op_x", _json(who, name, *_meta(F.lit("x"), ts_ms, "user_state")))
        .when(kind == "no_op", _json(who, name, *insert[1:]))
        .when(kind == "no_key", _json(name, *insert))
        .when(kind == "key_only_update", _json(who, *_meta(F.lit("u"), ts_ms, "user_state")))
        .when(kind == "not_a_number", _json(who, F.lit("many").alias("value"), *insert))
        .when(kind == "extra_column", _json(who, name, F.lit(1).alias("color"), *insert))
        .when(kind == "table_without_key", _json("c_name", *insert))
        .otherwise(_json(who, name, *insert))
    )
    topic = (
        F.when(kind == "table_unknown", PREFIX + "nosuch")
        .when(kind == "table_excluded", PREFIX + "log")
        .when(kind == "two_part_topic", "mysql_src.shop")
        .when(kind == "table_without_key", PREFIX + "audit")
        .otherwise(PREFIX + "user_state")
    )
    return _log(base, topic, F.pmod("user_id", F.lit(4)), who, ts_ms, _json(who), value)


def supplier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as inserts on a topic outside the prefix."""
    ts_ms = F.lit(1720000000000)
    value = _json("s_suppkey", "s_name", "s_acctbal", *_meta(F.lit("c"), ts_ms, "supplier"))
    return _log(
        _dealt(spark, sf_dir, "supplier", "s_suppkey"),
        F.lit("mysql_src.crm.supplier"),
        F.pmod("s_suppkey", F.lit(2)),
        F.col("s_suppkey"),
        ts_ms,
        _json("s_suppkey"),
        value,
    )


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics under the prefix, hostile rows included."""
    logs = (user_state_log, orders_log, messages_log, hostile_log)
    result = logs[0](spark, sf_dir)
    for log in logs[1:]:
        result = result.unionByName(log(spark, sf_dir))
    return result
