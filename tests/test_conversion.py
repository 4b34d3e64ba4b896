"""Conversion cases, one table of inputs and expected values per type."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import envelope, temporal
from tidemark.functions.convert import Policy, convert, default_value
from tidemark.functions.types import ColumnSpec, TableSchema, replica_schema, spark_type

TORONTO = "America/Toronto"


def run(spark, inputs, column, policy=Policy()):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    rows = frame.select("i", convert(F.col("v"), column, policy).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def instants(spark, inputs, zone):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    at = temporal.target_text(temporal.instant(F.col("v"), zone), "UTC")
    return [row.r for row in frame.select("i", at.alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "zone, text, want",
    [
        ("UTC", "2025-01-01T12:30:45Z", "2025-01-01 12:30:45"),
        ("UTC", "2025-01-01T12:30:45", "2025-01-01 12:30:45"),
        ("UTC", "2025-01-01 12:30:45", "2025-01-01 12:30:45"),
        ("UTC", "2025-01-01T12:30:45+00:00", "2025-01-01 12:30:45"),
        ("UTC", "2025-01-01T12:30:45.5-02:00", "2025-01-01 14:30:45"),
        ("UTC", "not a date", None),
        ("UTC", "2025-02-30 00:00:00", None),
        ("UTC", "2025-01-01", None),
        ("-07:00", "2025-01-01T12:00:00", "2025-01-01 19:00:00"),
        (TORONTO, "2025-01-01T12:30:45", "2025-01-01 17:30:45"),
        (TORONTO, "1735689600123", "2025-01-01 05:00:00"),
        (TORONTO, "2025-03-09 02:30:00", "2025-03-09 07:30:00"),
        (TORONTO, "2025-11-02 01:30:00", "2025-11-02 05:30:00"),
        ("UTC", "-1500", "1969-12-31 23:59:58"),
        ("UTC", "99999999999999999999", None),
        ("UTC", "9223372036854775807", None),
        ("UTC", "1735689600000.0", "2025-01-01 00:00:00"),
        ("UTC", "1.735689600999E12", "2025-01-01 00:00:00"),
        ("UTC", "1e300", None),
    ],
)
def test_datetime(spark, zone, text, want):
    assert instants(spark, [text], zone) == [want]


def test_datetime_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        texts = ["1735689600123", "2025-01-01 00:00:00", "2025-01-01T00:00:00Z"]
        assert instants(spark, texts, TORONTO) == ["2025-01-01 05:00:00"] * 2 + ["2025-01-01 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_datetime_as_text_in_target_zone(spark):
    policy = Policy(source_zone=TORONTO, target_zone=TORONTO, dialect="mysql")
    column = ColumnSpec("c", "datetime")
    assert run(spark, ["2025-01-01T12:30:45", "1735689600123", "soon"], column, policy) == [
        "2025-01-01 12:30:45",
        "2025-01-01 00:00:00",
        None,
    ]


def test_date(spark):
    got = run(spark, ["19358", "0", "2023-06-15", "99999999", "later", None, "19358.0"], ColumnSpec("c", "date"))
    assert got == [dt.date(2023, 1, 1), dt.date(1970, 1, 1), dt.date(2023, 6, 15), None, None, None, dt.date(2023, 1, 1)]


def test_time(spark):
    cases = {
        "0": "00:00:00",
        "1000": "00:00:01",
        "60000": "00:01:00",
        "3600000": "01:00:00",
        "45296000": "12:34:56",
        "86399000": "23:59:59",
        "-1000": "00:00:00",
        "360000000": "100:00:00",
        "12:34:56": "12:34:56",
        "1000.0": "00:00:01",
    }
    assert run(spark, list(cases), ColumnSpec("c", "time")) == list(cases.values())


def test_bool(spark):
    yes = ["true", "1", "TRUE", "2", "-1", "0.5"]
    no = ["false", "0", "True", "yes", "NaN", "0.0", ""]
    assert run(spark, yes + no + [None], ColumnSpec("c", "bit")) == [True] * len(yes) + [False] * len(no) + [None]


def test_numbers_and_text(spark):
    assert run(spark, ["9223372036854775807", "1.5", "x"], ColumnSpec("c", "bigint")) == [2**63 - 1, None, None]
    assert run(spark, ["5.0", "1e3", "1e30", "-0.0", "5.5", "9007199254740993.0"], ColumnSpec("c", "bigint")) == [5, 1000, None, 0, None, 2**53]
    assert run(spark, ["70000.0", "7.0"], ColumnSpec("c", "smallint")) == [None, 7]
    assert run(spark, ["18446744073709551615"], ColumnSpec("c", "bigint", unsigned=True)) == [Decimal(2**64 - 1)]
    assert run(spark, ["4294967295"], ColumnSpec("c", "int", unsigned=True)) == [2**32 - 1]
    assert run(spark, ["123.45", "1e2"], ColumnSpec("c", "decimal", precision=10, scale=2)) == [
        Decimal("123.45"),
        Decimal("100.00"),
    ]
    assert run(spark, ["99999"], ColumnSpec("c", "decimal", precision=4, scale=2)) == [None]
    for kind in ("varchar", "char", "longtext", "json", "enum", "geometry"):
        assert run(spark, ["as it is"], ColumnSpec("c", kind)) == ["as it is"]


def test_binary(spark):
    got = run(spark, ["aGVsbG8=", "!!"], ColumnSpec("c", "blob"))
    assert [bytes(v) if v is not None else None for v in got] == [b"hello", None]


def test_defaults(spark):
    def value(kind, default, **more):
        column = ColumnSpec("c", kind, default=default, **more)
        return spark.range(1).select(default_value(column, Policy()).alias("v")).first().v

    assert value("bit", "b'1'") is True
    assert value("bit", "b'0'") is False
    assert value("int", "5") == 5
    assert value("varchar", "none") == "none"
    assert value("decimal", "0.00", precision=8, scale=2) == Decimal("0.00")
    assert value("int", None) is None
    assert value("timestamp", "CURRENT_TIMESTAMP") is not None


def test_replica_types():
    kinds = {
        "tinyint": "smallint",
        "mediumint": "int",
        "bigint": "bigint",
        "float": "float",
        "double": "double",
        "datetime": "timestamp",
        "date": "date",
        "time": "string",
        "bit": "boolean",
        "json": "string",
        "longblob": "binary",
        "decimal": "decimal(10,0)",
    }
    for kind, want in kinds.items():
        assert spark_type(ColumnSpec("c", kind)).simpleString() == want
    own_stamp = TableSchema("t", (ColumnSpec("id", "int", pk_pos=1), ColumnSpec("deleted_at", "datetime")))
    assert replica_schema(own_stamp).fieldNames() == ["id", "deleted_at"]


def test_operation_and_event_time(spark):
    cases = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE", "x": "UNKNOWN", "": "UNKNOWN", None: "UNKNOWN"}
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    got = frame.select("i", envelope.operation(F.col("c")).alias("o")).orderBy("i").collect()
    assert [row.o for row in got] == list(cases.values())
    times = spark.createDataFrame([(1735689600000,), (1686832200000,), (0,)], "ms long")
    at = times.select(temporal.target_text(envelope.event_time(F.col("ms")), "UTC").alias("t")).collect()
    assert [row.t[:10] for row in at] == ["2025-01-01", "2023-06-15", "1970-01-01"]


def test_policy_rejects_unknown_settings():
    with pytest.raises(ValueError, match="dialect"):
        Policy(dialect="oracle")
    with pytest.raises(ValueError, match="delete_time"):
        Policy(delete_time="never")


def test_numbers_in_quotes_are_texts_to_a_bool(spark):
    from helpers import log_frame

    from tidemark.operators.typed import typed_events, typed_rows

    table = TableSchema("t", (ColumnSpec("id", "int", 1, pk_pos=1), ColumnSpec("flag", "bit", 2)))
    values = ['"2"', "2", '"1"', "1", '"0"', "0", "0.5", '"0.5"', "true", '"true"', '"TRUE"', '"True"', "null", '"-1"', "-1"]
    rows = [("t", 0, i, f'{{"ID":{i},"Flag":{v},"note":"Flag\\": 7","__op":"c"}}') for i, v in enumerate(values)]
    events = typed_events(envelope.parse(log_frame(spark, rows)), table)
    got = {r.offset: r.flag for r in typed_rows(events, table).collect()}
    assert [got[i] for i in range(len(values))] == [
        False, True, True, True, False, False, True, False, True, True, True, False, None, False, True]
