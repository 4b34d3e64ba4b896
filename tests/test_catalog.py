"""Catalogs, topic options, bootstrap and reconcile."""

import pytest
from helpers import event, log_frame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy
from tidemark.operators import bootstrap, reconcile, replay, stats
from tidemark.plans import changelogs as logs
from tidemark.sources import catalog, changelog

COLUMNS = "table_name string, column_name string, ordinal int, data_type string, precision int, scale int, unsigned boolean, nullable boolean, default_value string"


@pytest.fixture(scope="module")
def built(spark):
    columns = spark.createDataFrame(
        [
            ("Roles", "User_ID", 2, "bigint", None, None, False, False, None),
            ("Roles", "role_id", 1, "bigint", None, None, True, False, None),
            ("Roles", "granted", 3, "datetime", None, None, False, True, None),
            ("notes", "data", 1, "varchar", 20, None, False, True, "'x'"),
        ],
        COLUMNS,
    )
    keys = spark.createDataFrame([("roles", ["user_id", "ROLE_ID"])], "table_name string, key_columns array<string>")
    return catalog.build_catalog(columns, keys)


def test_catalog_joins_keys_in_key_order(built):
    tables = catalog.compile_catalog(built)
    assert tables["roles"].names == ["role_id", "user_id", "granted"]
    assert tables["roles"].keys == ["user_id", "role_id"]
    assert tables["notes"].keys == []
    assert [(r.column_name, r.pk_pos) for r in catalog.primary_keys(built, "roles").collect()] == [
        ("user_id", 1),
        ("role_id", 2),
    ]


def test_catalog_lookups(built):
    assert catalog.column_type(built, "roles", "Granted") == "datetime"
    assert catalog.column_type(built, "roles", "nothing") is None
    assert catalog.is_primary_key(built, "roles", "user_id")
    assert not catalog.is_primary_key(built, "roles", "granted")
    assert catalog.column_info(built, "notes", "data").first().precision == 20
    assert catalog.table_schema(built, "notes").columns[0].default == "'x'"
    with pytest.raises(LookupError):
        catalog.table_schema(built, "nosuch")


def test_catalog_round_trip(spark):
    frame = catalog.catalog_of(spark, list(logs.CATALOG.values()))
    assert catalog.compile_catalog(frame) == logs.CATALOG


def test_topic_options():
    options = changelog.topic_options("broker:9092", "my_src.shop.", changelog.LATEST, per_trigger=100)
    assert options["subscribePattern"] == r"my_src\.shop\..*"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        changelog.topic_options("b", "p", "yesterday")


def test_bootstrap_names_types_and_stamp(spark):
    rows = spark.sql("SELECT 1L AS O_ORDERKEY, timestamp_ntz'2024-07-01 12:00:00' AS `O_OrderDate`")
    table = logs.ORDERS
    some = type(table)(table.table, tuple(c for c in table.columns if c.name in ("o_orderkey", "o_orderdate")))
    out = bootstrap.bootstrap(rows, some, Policy(source_zone="America/Toronto"))
    assert out.columns == ["o_orderkey", "o_orderdate", "deleted_at"]
    got = out.select(F.unix_millis("o_orderdate").alias("ms"), "deleted_at").first()
    assert (got.ms, got.deleted_at) == (1719849600000, None)
    with pytest.raises(ValueError):
        bootstrap.lower_names(spark.sql("SELECT 1 AS a, 2 AS b").toDF("Id", "x").withColumnRenamed("x", "ID"))


def test_table_list(spark):
    names = [("Orders", 2), ("orders", 5), ("lock", 1), ("LOG", 3), ("users", 4)]
    frame = spark.createDataFrame(names, "table_name string, position long")
    got = {(r.replica_table, r.source_table) for r in bootstrap.table_list(frame, ["lock", "log"]).collect()}
    assert got == {("orders", "Orders"), ("users", "users")}


def test_reconcile(spark):
    source = spark.createDataFrame([("A", "id"), ("A", "x"), ("b", "id"), ("log", "id")], "table_name string, column_name string")
    target = spark.createDataFrame([("a", "ID"), ("a", "deleted_at"), ("c", "id")], "table_name string, column_name string")
    apart = {tuple(r) for r in reconcile.columns_apart(source, target, ["log"]).collect()}
    assert apart == {("a", "x", "missing_in_target"), ("b", "id", "missing_in_target"), ("c", "id", "missing_in_source")}
    tables = {tuple(r) for r in reconcile.tables_apart(source, target, ["log"]).collect()}
    assert tables == {("b", "missing_in_target"), ("c", "missing_in_source")}
    row = reconcile.summary(source, target, ["log"]).first()
    assert tuple(row) == (3, 2, 2, 1, True, False)


def test_duration_histogram(spark):
    batches = spark.createDataFrame(
        [(1, "t", "INSERT", 9, 1.0), (1, "t", "DELETE", 1, 1.0), (2, "t", "INSERT", 1, 20.0)],
        "batch_id long, source_table string, operation string, events long, seconds double",
    )
    rows = stats.duration_histogram(stats.statement_durations(batches)).collect()
    inserts = {r.le: r.cumulative for r in rows if r.operation == "INSERT"}
    assert inserts["0.05"] == 0 and inserts["0.1"] == 9 and inserts["10"] == 9 and inserts["+Inf"] == 10
    assert [r.observations for r in rows if r.operation == "DELETE"][0] == 1


def test_an_archived_log_is_read_by_topic(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("orders", 0, 0, event("c", 1, o_orderkey=1)), ("messages", 0, 0, event("c", 1, conv_id=1, turn=2))]
    changelog.archive(log_frame(spark, rows), path)
    log = changelog.read_files(spark, path)
    assert log.columns == changelog.LOG_SCHEMA.fieldNames()
    replica = replay.rebuild(log, logs.MESSAGES)
    assert [(r.conv_id, r.turn) for r in replica.collect()] == [(1, 2)]
    plan = replica._jdf.queryExecution().executedPlan().toString()
    assert "topic" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_defaults_of_both_dialects(spark):
    cases = {
        "'none'::character varying": "none",
        "'it''s'::text": "it's",
        "'0.00'::numeric": "0.00",
        "'0.00'::numeric(8,2)": "0.00",
        "'a::b'::character varying(20)": "a::b",
        "5": "5",
        "(-1)": "-1",
        "'-1'::integer": "-1",
        "true": "true",
        "NULL::character varying": None,
        "now()": "CURRENT_TIMESTAMP",
        "CURRENT_TIMESTAMP": "CURRENT_TIMESTAMP",
        "nextval('t_id_seq'::regclass)": catalog.UNREADABLE + "nextval('t_id_seq'::regclass)",
    }
    frame = spark.createDataFrame([(c,) for c in cases], "d string")
    rows = frame.select("d", catalog.plain_default(F.col("d"), "postgres").alias("v"), catalog.plain_default(F.col("d"), "mysql").alias("m"))
    assert {r.d: r.v for r in rows.collect()} == cases
    assert all(r.m == r.d for r in rows.collect())


def test_lookups_take_names_in_any_case_and_unreadable_defaults_are_errors(spark):
    rows = [("t", "id", 1, "int", None, None, False, False, catalog.UNREADABLE + "nextval('s')"), ("t", "v", 2, "int", None, None, False, True, "1")]
    keys = spark.createDataFrame([("t", ["id"])], "table_name string, key_columns array<string>")
    built = catalog.build_catalog(spark.createDataFrame(rows, COLUMNS), keys)
    assert catalog.table_schema(built, "T").keys == ["id"] or catalog.table_schema(built, "T").keys == ("id",)
    assert catalog.is_primary_key(built, "T", "ID")
    bad = catalog.build_catalog(spark.createDataFrame([*rows[:1], (*rows[1][:8], catalog.UNREADABLE + "f()")], COLUMNS), keys)
    with pytest.raises(ValueError, match="t.v"):
        catalog.table_schema(bad, "t")


def test_a_value_that_does_not_fit_does_not_end_the_load(spark):
    from tidemark.functions.types import ColumnSpec, TableSchema

    table = TableSchema("t", (ColumnSpec("id", "int", 1, pk_pos=1), ColumnSpec("n", "int", 2), ColumnSpec("d", "decimal", 3, precision=4, scale=2)))
    rows = spark.createDataFrame([(1, "7", 1.5), (2, "many", 99999.0), (3, None, None)], "ID int, n string, d double")
    out = {r.id: (r.n, r.d and float(r.d)) for r in bootstrap.bootstrap(rows, table).collect()}
    assert out == {1: (7, 1.5), 2: (None, None), 3: (None, None)}
    found = {tuple(r) for r in bootstrap.misfits(rows, table).collect()}
    assert found == {("2", "n", "many"), ("2", "d", "99999.0")}
