"""The registered queries: each runs one capability over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import convert, envelope, temporal
from tidemark.functions.convert import Policy
from tidemark.functions.types import DELETED_AT, ColumnSpec, TableSchema, replica_schema
from tidemark.operators import bootstrap, fold, reconcile, rejects, replay, stats
from tidemark.operators.typed import typed_events, typed_rows, validated
from tidemark.plans import changelogs as logs
from tidemark.session import shared_dir
from tidemark.sources import catalog, changelog
from tidemark.streaming.lake import ReplicaTable
from tidemark.streaming.replicate import Replication

Query = Callable[[SparkSession, str], DataFrame]

POLICY = Policy(source_zone=logs.SOURCE_ZONE)
TARGET_ZONE = "Asia/Tokyo"

# The orders table as its source declares it, for loading it whole.
ORDERS_SOURCE = TableSchema(
    "orders",
    (
        ColumnSpec("o_orderkey", "bigint", 1, nullable=False, pk_pos=1),
        ColumnSpec("o_custkey", "bigint", 2),
        ColumnSpec("o_orderstatus", "char", 3, precision=1),
        ColumnSpec("o_totalprice", "decimal", 4, precision=15, scale=2),
        ColumnSpec("o_orderdate", "datetime", 5),
        ColumnSpec("o_orderpriority", "varchar", 6, precision=15),
    ),
)

# Key columns of the given tables; lineitem has none.
KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
TABLES = [*KEYS, "lineitem"]


def _ms(column: str) -> Column:
    return F.unix_millis(F.col(column))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _stamp() -> Column:
    return _ms(DELETED_AT).alias("deleted_ms")


# --- sources -------------------------------------------------------------------------


def _positions(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def cdc_source_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = logs.shop_log(spark, sf_dir).unionByName(logs.supplier_log(spark, sf_dir))
    return _positions(changelog.with_prefix(everything, logs.PREFIX))


def cdc_start_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.user_state_log(spark, sf_dir)
    inserts = envelope.parse(log).groupBy("topic", "partition").agg(
        F.max(F.when(F.col("operation") == envelope.INSERT, F.col("offset"))).alias("offset")
    )
    starts = {
        "earliest": changelog.start_at(log, changelog.EARLIEST),
        "latest": changelog.start_at(log, changelog.LATEST),
        "after_last_insert": changelog.after_positions(log, inserts.filter(F.col("offset").isNotNull())),
    }
    parts = [_positions(rows).withColumn("start", F.lit(name)) for name, rows in starts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def cdc_snapshot_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Policy(source_zone=logs.SOURCE_ZONE, unknown_columns="ignore")
    loaded = bootstrap.bootstrap(logs.table(spark, sf_dir, "orders"), ORDERS_SOURCE, policy)
    replica = replay.advance(loaded, logs.orders_log(spark, sf_dir), ORDERS_SOURCE, policy)
    return replica.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        _text("o_totalprice").alias("price"),
        _ms("o_orderdate").alias("ordered_ms"),
        "o_orderpriority",
        _stamp(),
    )


def cdc_replay_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = replay.rebuild(logs.shop_log(spark, sf_dir), logs.USER_STATE, POLICY, logs.EXCLUDED)
    return _user_state(replica)


def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = None
    for name in TABLES:
        mine = catalog.observed_columns(logs.table(spark, sf_dir, name), name)
        columns = mine if columns is None else columns.unionByName(mine)
    keys = spark.createDataFrame(list(KEYS.items()), "table_name string, key_columns array<string>")
    return catalog.build_catalog(columns, keys).select(
        "table_name", "column_name", "ordinal", "data_type", "nullable", "pk_pos"
    )


# --- envelope ------------------------------------------------------------------------


def cdc_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse(logs.shop_log(spark, sf_dir)).select(
        "topic", "partition", "offset", "parse_error", "op", "ts_ms", "source_db", "source_table", "deleted"
    )


def cdc_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.shop_log(spark, sf_dir)
    events = envelope.parse(log.filter(F.col("value").isNull()))
    return typed_events(events, logs.USER_STATE, POLICY).select("offset", "op", "operation", "deleted", "reason")


def cdc_topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.shop_log(spark, sf_dir))
    return events.groupBy("topic", "source_table").agg(F.count(F.lit(1)).alias("n_events"))


def cdc_classify_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.shop_log(spark, sf_dir))
    return events.groupBy("source_table", "op", "operation").agg(F.count(F.lit(1)).alias("n_events"))


def cdc_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.user_state_log(spark, sf_dir))
    at = envelope.event_time(F.col("ts_ms"))
    return events.select(
        "offset", F.unix_millis(at).alias("event_ms"), temporal.target_text(at, "UTC").alias("event_time")
    )


def cdc_meta_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.user_state_log(spark, sf_dir))
    row = events.select("offset", envelope.payload_map(F.col("names"), F.col("texts")).alias("row"))
    return row.select(
        "offset",
        F.array_join(F.array_sort(F.map_keys("row")), ",").alias("column_names"),
        F.size(F.filter(F.map_values("row"), lambda v: v.isNull())).alias("n_nulls"),
        F.element_at("row", F.lit("last_type")).alias("last_type"),
    )


def cdc_exclude_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = replay.parsed(logs.shop_log(spark, sf_dir), logs.EXCLUDED)
    return events.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_events"))


def cdc_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(spark, sf_dir).select("topic", "offset", "source_table", "operation", "reason")


# --- conversion ----------------------------------------------------------------------


def _orders_field(spark: SparkSession, sf_dir: str, name: str, policy: Policy = POLICY) -> DataFrame:
    """One converted column of every orders event that carries it."""
    events = envelope.parse(logs.orders_log(spark, sf_dir))
    names, texts = F.col("names"), F.col("texts")
    spec = next(c for c in logs.ORDERS.columns if c.name == name)
    raw = events.select(
        "offset", envelope.has(names, name).alias("carried"), envelope.text_of(names, texts, name).alias("raw")
    )
    return raw.select("offset", "carried", convert.convert(F.col("raw"), spec, policy).alias("typed"))


def cdc_datetime_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_field(spark, sf_dir, "o_orderdate").select("offset", "carried", _ms("typed").alias("ordered_ms"))


def cdc_datetime_target_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Policy(source_zone=logs.SOURCE_ZONE, target_zone=TARGET_ZONE, dialect="mysql")
    return _orders_field(spark, sf_dir, "o_orderdate", policy).select(
        "offset", "carried", F.col("typed").alias("ordered_text")
    )


def cdc_datetime_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_field(spark, sf_dir, "o_orderedat").select("offset", "carried", _ms("typed").alias("ordered_ms"))


def cdc_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_field(spark, sf_dir, "o_orderday").select("offset", "carried", _text("typed").alias("order_day"))


def cdc_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_field(spark, sf_dir, "o_ordertime").select("offset", "carried", F.col("typed").alias("order_time"))


def cdc_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_field(spark, sf_dir, "o_urgent").select("offset", "carried", F.col("typed").alias("urgent"))


def cdc_decimal_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.orders_log(spark, sf_dir))
    rows = typed_rows(typed_events(events, logs.ORDERS, POLICY), logs.ORDERS, POLICY)
    return rows.select("offset", _text("o_totalprice").alias("price"), F.hex("o_note").alias("note_hex"))


def cdc_passthrough_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.user_state_log(spark, sf_dir).unionByName(logs.hostile_log(spark, sf_dir))
    rows = typed_rows(typed_events(envelope.parse(log), logs.USER_STATE, POLICY), logs.USER_STATE, POLICY)
    return rows.select("topic", "offset", "user_id", "value", "props", "last_type")


def cdc_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.orders_log(spark, sf_dir))
    rows = typed_rows(typed_events(events, logs.ORDERS, POLICY), logs.ORDERS, POLICY)
    return rows.select("offset", "operation", "reason", *_order_columns())


def cdc_column_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.orders_log(spark, sf_dir))
    names, texts = F.col("names"), F.col("texts")
    return events.select(
        "offset",
        F.array_join(F.array_sort(F.filter(names, lambda n: ~n.startswith(envelope.META_PREFIX))), ",").alias(
            "column_names"
        ),
        envelope.text_of(names, texts, "o_orderkey").try_cast("bigint").alias("o_orderkey"),
    )


# --- fold and merge ------------------------------------------------------------------


def _order_columns() -> list[Column]:
    return [
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        _text("o_totalprice").alias("price"),
        _ms("o_orderdate").alias("ordered_ms"),
        _text("o_orderday").alias("order_day"),
        F.col("o_ordertime").alias("order_time"),
        _ms("o_orderedat").alias("placed_ms"),
        F.col("o_orderpriority"),
        F.col("o_urgent").alias("urgent"),
        F.hex("o_note").alias("note_hex"),
    ]


def _user_state(replica: DataFrame) -> DataFrame:
    return replica.select("user_id", "value", "props", "last_type", _stamp())


def _orders_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.rebuild(logs.orders_log(spark, sf_dir), logs.ORDERS, POLICY)


def cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_replica(spark, sf_dir).select(*_order_columns())


def cdc_undelete(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = replay.rebuild(logs.user_state_log(spark, sf_dir), logs.USER_STATE, POLICY)
    return replica.select("user_id", F.col(DELETED_AT).isNull().alias("is_live"), _stamp())


def cdc_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = replay.rebuild(logs.user_state_log(spark, sf_dir), logs.USER_STATE, POLICY)
    return replica.select("user_id", "value", "props", "last_type")


def cdc_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_replica(spark, sf_dir).select("o_orderkey", "o_orderstatus", _stamp())


def cdc_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = replay.changes(logs.user_state_log(spark, sf_dir), logs.USER_STATE, POLICY)
    return changes.select(
        "user_id",
        F.col(fold.EVENTS).alias("n_events"),
        F.col(f"{fold.FIRST_INSERT}.offset").alias("first_insert"),
        F.col("value.v").alias("value"),
        F.col("value.offset").alias("value_at"),
        F.col("props.v").alias("props"),
        F.col("props.offset").alias("props_at"),
        F.col("last_type.v").alias("last_type"),
        F.unix_millis(F.col(f"{DELETED_AT}.v")).alias("deleted_ms"),
        F.col(f"{DELETED_AT}.offset").alias("deleted_at_offset"),
    )


def cdc_replica_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.user_state_log(spark, sf_dir)
    noon = F.lit(1705363200000)
    before = log.filter(F.unix_millis("timestamp") < noon)
    since = log.filter(F.unix_millis("timestamp") >= noon)
    replica = replay.rebuild(before, logs.USER_STATE, POLICY)
    return _user_state(replay.advance(replica, since, logs.USER_STATE, POLICY))


def cdc_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    replica = replay.rebuild(logs.messages_log(spark, sf_dir), logs.MESSAGES, POLICY)
    return replica.select("conv_id", "turn", "role", "text", "n_chars", _stamp())


def cdc_insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = replay.rebuild(logs.messages_log(spark, sf_dir), logs.MESSAGES, POLICY)
    return messages.groupBy("role", "n_chars").agg(F.count(F.lit(1)).alias("n_messages"))


def cdc_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.shop_log(spark, sf_dir)
    result = None
    for schema in (logs.USER_STATE, logs.ORDERS, logs.MESSAGES):
        replica = replay.rebuild(log, schema, POLICY, logs.EXCLUDED)
        counts = replica.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(DELETED_AT).isNull()).alias("n_live")
        ).withColumn("table_name", F.lit(schema.table))
        result = counts if result is None else result.unionByName(counts)
    return result


# --- rejects and statistics ----------------------------------------------------------


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = replay.parsed(logs.shop_log(spark, sf_dir), logs.EXCLUDED)
    return rejects.rejected(events, logs.CATALOG, POLICY)


def cdc_dlq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rejects.dead_letters(_rejected(spark, sf_dir), at=F.col("timestamp"))
    return entries.select(
        F.col("event.__op").alias("op"),
        F.col("event.__ts_ms").alias("ts_ms"),
        F.col("event.__source_db").alias("source_db"),
        F.col("event.__source_table").alias("source_table"),
        F.col("event.__deleted").alias("deleted"),
        "offset",
        "raw",
        "stage",
        "error",
        F.unix_millis("timestamp").alias("rejected_ms"),
        "retries",
    )


def cdc_dlq_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.dead_letter_count(rejects.dead_letters(_rejected(spark, sf_dir)))


def processed_in(log: DataFrame) -> DataFrame:
    """Applied events of every catalog table."""
    events = replay.parsed(log, logs.EXCLUDED)
    outcome = validated(events, logs.CATALOG, POLICY)
    return stats.processed(outcome.filter(F.col("table_name").isNotNull()))


def stats_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_in(logs.shop_log(spark, sf_dir))


def stats_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.failed(_rejected(spark, sf_dir))


def stats_duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.user_state_log(spark, sf_dir))
    # Batches of 100 events; a batch's seconds come from the span of its event times.
    groups = events.groupBy(
        F.floor(F.col("offset") / 100).alias("batch_id"), "source_table", "operation"
    ).agg(F.count(F.lit(1)).alias("events"), F.min("ts_ms").alias("lo"), F.max("ts_ms").alias("hi"))
    of_batch = Window.partitionBy("batch_id")
    seconds = (F.max("hi").over(of_batch) - F.min("lo").over(of_batch)) / 100000
    batches = groups.select("batch_id", "source_table", "operation", "events", seconds.alias("seconds"))
    return stats.duration_histogram(stats.statement_durations(batches)).withColumn(
        "total_seconds", F.round("total_seconds", 3)
    )


def lag_in(log: DataFrame) -> DataFrame:
    """Lag if the last insert of each log partition is the last event applied."""
    log = changelog.with_prefix(log, logs.PREFIX)
    applied = envelope.parse(log).select(
        "topic", "partition", F.when(F.col("operation") == envelope.INSERT, F.col("offset")).alias("offset")
    )
    return stats.lag(log, applied)


def stats_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_in(logs.shop_log(spark, sf_dir))


# --- bootstrap and reconcile ---------------------------------------------------------


def bootstrap_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = logs.table(spark, sf_dir, "orders")
    named = orders.toDF(*[c.upper() for c in orders.columns])
    rows = bootstrap.bootstrap(named, ORDERS_SOURCE, POLICY)
    return rows.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        _text("o_totalprice").alias("price"),
        _ms("o_orderdate").alias("ordered_ms"),
        "o_orderpriority",
        _stamp(),
    )


def bootstrap_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = envelope.parse(logs.shop_log(spark, sf_dir))
    # The first log partition spells its tables in capitals.
    spelled = F.when(F.col("partition") == 0, F.upper("source_table")).otherwise(F.col("source_table"))
    tables = events.groupBy(spelled.alias("table_name")).agg(F.min("offset").alias("position"))
    return bootstrap.table_list(tables, logs.EXCLUDED)


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Columns seen in the log, and columns of the replicas."""
    events = envelope.parse(logs.shop_log(spark, sf_dir))
    seen = events.select(F.col("source_table").alias("table_name"), F.explode("names").alias("column_name"))
    source = seen.filter(~F.col("column_name").startswith(envelope.META_PREFIX)).distinct()
    rows = [(t.table, name) for t in logs.CATALOG.values() for name in replica_schema(t).fieldNames()]
    return source, spark.createDataFrame(rows, "table_name string, column_name string")


def reconcile_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _sides(spark, sf_dir)
    return reconcile.columns_apart(source, target, logs.EXCLUDED)


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _sides(spark, sf_dir)
    return reconcile.summary(source, target, logs.EXCLUDED)


def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _sides(spark, sf_dir)
    return reconcile.tables_apart(source, target, logs.EXCLUDED)


# --- streaming -----------------------------------------------------------------------

# Ends of the slices the log arrives in: 11 and 21 January 2024, then the rest.
_SLICE_ENDS = (1704931200000, 1705795200000, None)


def _arrive(log: DataFrame, path: str, i: int) -> None:
    """Append one slice of a log to a folder."""
    at = F.unix_millis("timestamp")
    start, end = (_SLICE_ENDS[i - 1] if i else None), _SLICE_ENDS[i]
    mine = log if start is None else log.filter(at >= start)
    # Rows without a time arrive last.
    mine = mine if end is None else mine.filter(at < end)
    mine = mine if end is not None else mine.unionByName(log.filter(at.isNull()))
    mine.write.mode("append").parquet(path)


def _drain(spark: SparkSession, job: Replication, root: str) -> None:
    """Apply what has arrived since the last run, and stop."""
    job.start(changelog.stream_files(spark, f"{root}/log"), f"{root}/checkpoint").awaitTermination()


def _job(root: str) -> Replication:
    return Replication(f"{root}/target", logs.CATALOG, POLICY, tuple(logs.EXCLUDED), buckets=8)


def cdc_stream_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives in three slices, each drained as it comes."""
    root = shared_dir(spark, "stream")
    job = _job(root)
    for i in range(len(_SLICE_ENDS)):
        _arrive(logs.user_state_log(spark, sf_dir), f"{root}/log", i)
        _drain(spark, job, root)
    return _user_state(job.read(spark, "user_state"))


def cdc_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after the first slice, resumed with the rest, last batch delivered twice."""
    root = shared_dir(spark, "resume")
    log = logs.user_state_log(spark, sf_dir)
    _arrive(log, f"{root}/log", 0)
    _drain(spark, _job(root), root)
    _arrive(log, f"{root}/log", 1)
    _arrive(log, f"{root}/log", 2)
    job = _job(root)
    _drain(spark, job, root)
    for source, last in job.epoch(spark).applied.items():
        job.apply_batch(changelog.read_files(spark, f"{root}/log"), last, source)
    return _user_state(job.read(spark, "user_state"))


def cdc_rebuild_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drained once, rebuilt from the log, and then the rest on the same checkpoint: no batch is lost."""
    root = shared_dir(spark, "rebuilt")
    job = _job(root)
    for i in range(len(_SLICE_ENDS)):
        _arrive(logs.user_state_log(spark, sf_dir), f"{root}/log", i)
        _drain(spark, job, root)
        if not i:
            job.rebuild(changelog.read_files(spark, f"{root}/log"))
    return _user_state(job.read(spark, "user_state"))


def cdc_stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics in one stream, hostile rows included: rows per replica, and dead letters."""
    root = shared_dir(spark, "tables")
    job = _job(root)
    for i in range(len(_SLICE_ENDS)):
        _arrive(logs.shop_log(spark, sf_dir), f"{root}/log", i)
        _drain(spark, job, root)
    keyed = [name for name, table in logs.CATALOG.items() if table.keys]
    counts = [job.read(spark, name).select(F.lit(name).alias("table_name"), DELETED_AT) for name in keyed]
    refused = spark.read.json(job.dead_letter_path).select(
        F.lit("dead_letters").alias("table_name"), F.lit(None).cast("timestamp").alias(DELETED_AT)
    )
    every = refused
    for rows in counts:
        every = every.unionByName(rows)
    return every.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(DELETED_AT).isNull()).alias("n_live")
    )


def _slice(log: DataFrame, i: int) -> DataFrame:
    """Slice i of a log whose rows all have a time."""
    at = F.unix_millis("timestamp")
    start, end = (_SLICE_ENDS[i - 1] if i else None), _SLICE_ENDS[i]
    mine = log if start is None else log.filter(at >= start)
    return mine if end is None else mine.filter(at < end)


def _user_state_replica(spark: SparkSession, purpose: str, **settings) -> ReplicaTable:
    return ReplicaTable(shared_dir(spark, purpose), logs.USER_STATE, POLICY, **settings)


def cdc_delta_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended to a replica as deltas: its rows merged on read, and after compaction."""
    replica = _user_state_replica(spark, "deltas", buckets=8, compact_share=None)
    log = logs.user_state_log(spark, sf_dir)
    replica.replace(replay.changes(_slice(log, 0), logs.USER_STATE, POLICY))
    for i in (1, 2):
        replica.append(replay.changes(_slice(log, i), logs.USER_STATE, POLICY), i)
    merged = replica.read(spark, replica.version(spark)).withColumn("compacted", F.lit(False))
    replica.compact(spark)
    whole = replica.read(spark).withColumn("compacted", F.lit(True))
    rows = merged.unionByName(whole)
    return rows.select("compacted", "user_id", "value", "props", "last_type", _stamp())


def cdc_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices delivered last to first, each with every tenth event of all others: the rows are those of the log in order."""
    replica = _user_state_replica(spark, "unordered", compact_share=None)
    log = logs.user_state_log(spark, sf_dir)
    again = log.filter(F.col("offset") % 10 == 0)
    for batch, i in enumerate((2, 0, 1)):
        replica.append(replay.changes(_slice(log, i).unionByName(again), logs.USER_STATE, POLICY), batch)
        if batch == 1:
            replica.compact(spark)
    return _user_state(replica.read(spark))


def cdc_consistent_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parent and a child table; the job stops between the two, is read, and resumed."""
    root = shared_dir(spark, "epochs")
    tables = {t.table: t for t in (logs.USER_STATE, logs.ACTIVITY)}
    job = Replication(f"{root}/target", tables, POLICY)
    log = logs.user_state_log(spark, sf_dir).unionByName(logs.activity_log(spark, sf_dir))
    early, late = log.filter(F.unix_millis("timestamp") < _SLICE_ENDS[0]), log.filter(F.unix_millis("timestamp") >= _SLICE_ENDS[0])
    job.apply_batch(early, 0)
    # What is left when a driver ends after the first of two tables: its files and its own version.
    job.replica("activity", logs.ACTIVITY).append(replay.changes(late, logs.ACTIVITY, POLICY), 1)

    def seen(moment: str) -> DataFrame:
        epoch = job.epoch(spark)
        parents = job.read(spark, "user_state", epoch).agg(
            F.count(F.lit(1)).alias("n_users"), F.count_if(F.col(DELETED_AT).isNull()).alias("n_live")
        )
        children = job.read(spark, "activity", epoch).agg(F.count(F.lit(1)).alias("n_activities"), F.max("event_id").alias("last_event"))
        both = parents.unionByName(children, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("moment", F.lit(moment))

    stopped = seen("stopped")
    job.apply_batch(late, 1)
    return stopped.unionByName(seen("resumed"))


def cdc_late_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog gets a table and a column after their events have come: rows per replica, and what still waits or is rejected."""
    root = shared_dir(spark, "late")
    known = dict(logs.CATALOG)
    early = [t for t in known.values() if t.table != "messages"]
    early = [TableSchema(t.table, tuple(c for c in t.columns if c.name != "o_note")) for t in early]
    current = [f"{root}/catalog-1"]
    catalog.catalog_of(spark, early).write.parquet(current[0])

    def read(session: SparkSession) -> dict[str, TableSchema]:
        return catalog.compile_catalog(session.read.parquet(current[0]))

    job = Replication(f"{root}/target", read, POLICY, tuple(logs.EXCLUDED))
    for i in range(len(_SLICE_ENDS)):
        _arrive(logs.shop_log(spark, sf_dir), f"{root}/log", i)
        _drain(spark, job, root)
        if not i:
            current[0] = f"{root}/catalog-2"
            catalog.catalog_of(spark, list(known.values())).write.parquet(current[0])

    def counted(rows: DataFrame, name: str, live: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("table_name"), live.alias("live"))

    every = counted(job.parked(spark), "waiting", F.lit(True))
    every = every.unionByName(counted(spark.read.json(job.dead_letter_path), "dead_letters", F.lit(True)))
    for name in ("user_state", "orders", "messages"):
        every = every.unionByName(counted(job.read(spark, name), name, F.col(DELETED_AT).isNull()))
    every = every.unionByName(counted(job.read(spark, "orders").filter("o_note IS NOT NULL"), "orders_with_note", F.lit(True)))
    return every.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("live").alias("n_live"))


def cdc_rebucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that outgrows its two buckets: rows after its buckets were split."""
    replica = ReplicaTable(shared_dir(spark, "rebucket"), logs.ORDERS, POLICY, buckets=2, compact_share=None)
    log = logs.orders_log(spark, sf_dir)
    first = F.col("offset") % 4 == 0
    replica.replace(replay.changes(log.filter(first), logs.ORDERS, POLICY))
    replica.append(replay.changes(log.filter(~first), logs.ORDERS, POLICY), 0)
    replica.bucket_bytes = replica.manifest(spark).base_bytes // 8
    replica.compact(spark)
    if replica.manifest(spark).depth < 2:
        raise RuntimeError("no bucket was split")
    return replica.read(spark).select(*_order_columns(), _stamp())


def stats_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied events by table and operation, as counted while the replicas were written."""
    job = _job(shared_dir(spark, "observed"))
    log = logs.shop_log(spark, sf_dir)
    at = F.unix_millis("timestamp")
    job.apply_batch(log.filter(at < _SLICE_ENDS[0]), 0)
    job.apply_batch(log.filter(at.isNull() | (at >= _SLICE_ENDS[0])), 1)
    recorded = spark.read.parquet(job.statistics_path)
    return recorded.groupBy("source_table", "operation").agg(F.sum("events").alias("events"))


def cdc_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log whose slices bring every tenth row twice, and again with the next slice: events counted by the job."""
    root = shared_dir(spark, "redelivered")
    job = _job(root)
    log = logs.user_state_log(spark, sf_dir)
    tenth = F.col("offset") % 10 == 0
    for i in range(len(_SLICE_ENDS)):
        mine = _slice(log, i)
        sent = mine.unionByName(mine.filter(tenth))
        sent = sent if not i else sent.unionByName(_slice(log, i - 1).filter(tenth))
        sent.write.mode("append").parquet(f"{root}/log")
        # The log spans a month; nothing in it is later than two.
        stream = changelog.delivered_once(changelog.stream_files(spark, f"{root}/log"), "60 days")
        job.start(stream, f"{root}/checkpoint").awaitTermination()
    recorded = spark.read.parquet(job.statistics_path)
    return recorded.groupBy("source_table", "operation").agg(F.sum("events").alias("events"))


STREAM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        cdc_stream_replica,
        cdc_stream_resume,
        cdc_rebuild_then_stream,
        cdc_stream_tables,
        cdc_delta_replica,
        cdc_out_of_order,
        cdc_consistent_snapshot,
        cdc_late_table,
        cdc_rebucket,
        stats_observed,
        cdc_redelivered,
    )
}

BATCH_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        cdc_source_prefix,
        cdc_start_offset,
        cdc_snapshot_bootstrap,
        cdc_replay_rebuild,
        schema_catalog,
        cdc_parse_envelope,
        cdc_tombstones,
        cdc_topic_route,
        cdc_classify_ops,
        cdc_event_time,
        cdc_meta_strip,
        cdc_exclude_tables,
        cdc_reject_reasons,
        cdc_datetime_instant,
        cdc_datetime_target_text,
        cdc_datetime_iso,
        cdc_date,
        cdc_time,
        cdc_bool,
        cdc_decimal_binary,
        cdc_passthrough_cast,
        cdc_typed_projection,
        cdc_column_resolve,
        cdc_upsert,
        cdc_undelete,
        cdc_partial_update,
        cdc_soft_delete,
        cdc_fold,
        cdc_replica_merge,
        cdc_composite_key,
        cdc_insert_defaults,
        cdc_multi_table,
        cdc_dlq_rows,
        cdc_dlq_count,
        stats_processed,
        stats_failed,
        stats_duration_histogram,
        stats_lag,
        bootstrap_snapshot,
        bootstrap_table_list,
        reconcile_schema,
        reconcile_counts,
        reconcile_tables,
    )
}
