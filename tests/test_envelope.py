"""Parsing, routing and rejecting single log rows."""

import pytest
from helpers import PAIRS, TOPIC, event, log_frame
from pyspark.sql import functions as F

from tidemark.functions import envelope
from tidemark.functions.convert import Policy
from tidemark.functions.types import ColumnSpec, TableSchema
from tidemark.operators import rejects, replay
from tidemark.operators.typed import typed_events, typed_rows
from tidemark.sources.changelog import LOG_SCHEMA

GOOD = ['{"a":1}', '  {"a":1}  ', "{}", '{"a":1,"a":2}', '{"a":{"b":[1,2]}}', "null", " null "]
BAD = [
    "{bad",
    "[1]",
    "5",
    '"x"',
    "",
    '{"a":1,',
    '{"a":1} xyz',
    '{"a":1}{"b":2}',
    '{"a":1},{"b":2}',
    '{"a":1}]',
    "{'a':1}",
    '{"a":NaN}',
    '{"a":01}',
]


def test_only_one_json_object_is_an_event(spark):
    log = log_frame(spark, [("t", 0, i, v) for i, v in enumerate(GOOD + BAD)])
    rows = envelope.parse(log).orderBy("offset").collect()
    assert [row.parse_error for row in rows] == [False] * len(GOOD) + [True] * len(BAD)
    assert {row.operation for row in rows} == {"UNKNOWN"}


def test_payload_keeps_nulls_last_values_and_big_numbers(spark):
    text = '{"ID":9223372036854775807,"x":null,"X":1,"y":"a","Y":null,"n":1.5,"__op":"u","__extra":1}'
    row = envelope.parse(log_frame(spark, [("t", 0, 0, text)])).select(
        envelope.payload_map(F.col("names"), F.col("texts")).alias("p"),
        envelope.has(F.col("names"), "y").alias("has_y"),
        envelope.has(F.col("names"), "z").alias("has_z"),
    ).first()
    assert row.p == {"id": "9223372036854775807", "x": "1", "y": None, "n": "1.5"}
    assert row.has_y and not row.has_z


def test_meta_fields(spark):
    text = '{"__op":"c","__ts_ms":1.7e12,"__source_db":"shop","__source_table":"t","__deleted":"false"}'
    rows = envelope.parse(
        log_frame(spark, [("a.b", 0, 0, text), ("a.b.c", 0, 1, text), ("a.b.c.d", 0, 2, text), ("a.b.c", 0, 3, None)])
    ).orderBy("offset").collect()
    assert [row.source_table for row in rows] == ["t", "c", "c", "c"]
    assert rows[0].ts_ms == 1700000000000 and rows[0].source_db == "shop" and rows[0].deleted == "false"
    assert (rows[3].op, rows[3].operation, rows[3].deleted) == ("d", "DELETE", "true")
    wrong = envelope.parse(log_frame(spark, [("t", 0, 0, '{"__op":"c","__ts_ms":"soon"}')])).first()
    assert wrong.ts_ms is None and wrong.op == "c"


@pytest.mark.parametrize(
    "text, want",
    [(None, []), ("", []), ("a,b", ["a", "b"]), (" a , b ,, ", ["a", "b"]), (",", []), ("one", ["one"])],
)
def test_parse_list(text, want):
    assert envelope.parse_list(text) == want


def test_exclusion_is_exact(spark):
    log = log_frame(spark, [(t, 0, i, "{}") for i, t in enumerate(["log", "Log", "logs", "orders"])])
    kept = envelope.exclude_tables(envelope.parse(log), ["log", "lock"])
    assert {row.source_table for row in kept.collect()} == {"Log", "logs", "orders"}
    assert envelope.exclude_topics(log, ["log"]).count() == 3
    assert envelope.exclude_tables(envelope.parse(log), []).count() == 4


def test_the_table_of_a_topic_needs_no_split(spark):
    topics = ["a.b.c", "a.b.c.d", "a.b", "a.b.", "a..c", "..c", "a", "", ".", "..", "...", "é.ü.ß", "a.b. ", None]
    rows = spark.createDataFrame([(t, 0, i, None, None, "{}") for i, t in enumerate(topics)], LOG_SCHEMA)
    want = {t: (t.split(".") + ["", ""])[2] or None if t is not None else None for t in topics}
    want.update({t: None for t in topics if t is not None and t.count(".") < 2})
    assert {r.topic: r.named for r in rows.select("topic", envelope.topic_table(F.col("topic")).alias("named")).collect()} == want
    # A split compiles a pattern for every row, and a generator's own expressions are interpreted.
    plan = envelope.parse(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "split" not in plan and "Generate inline(array(__found" in plan


REASONS = [
    ("pairs", "{bad", "parse_error"),
    ("pairs", None, "missing_key"),
    ("pairs", event("x", 1, a=1, b=1), "unknown_operation"),
    ("pairs", '{"a":1,"b":1}', "unknown_operation"),
    ("pairs", "null", "unknown_operation"),
    ("nosuch", event("c", 1, a=1, b=1), "unknown_table"),
    ("pairs", event("c", 1, a=1, x=1), "missing_key"),
    ("pairs", event("c", 1, a=1, b=None, x=1), "missing_key"),
    ("pairs", event("u", 1, a=1, b=1), "no_columns_to_update"),
    ("pairs", event("u", 1, a=1, b=1, z=1), "unknown_column"),
    ("pairs", event("c", 1, a=1, b=1, x="many"), "cast_error"),
    ("pairs", event("d", 1, a="one", b=1), "cast_error"),
    ("keyless", event("c", 1, v=1), "no_primary_key"),
]
FINE = [
    ("pairs", event("c", 1, a=1, b=1)),
    ("pairs", event("u", 1, a=1, b=1, x=None)),
    ("pairs", event("d", 1, a=1, b=1, x="many", z=1)),
    ("PAIRS", event("c", 1, A=1, B=1, X=2)),
]
KEYLESS = TableSchema("keyless", (ColumnSpec("v", "int"),))


def test_every_reject_has_its_reason(spark):
    rows = [(t, 0, i, v) for i, (t, v, *_) in enumerate(REASONS + FINE)]
    events = envelope.parse(log_frame(spark, rows))
    refused = rejects.rejected(events, {"pairs": PAIRS, "keyless": KEYLESS})
    got = {row.offset: row.reason for row in refused.collect()}
    assert got == {i: reason for i, (_, _, reason) in enumerate(REASONS)}


def test_key_columns_can_be_supplied(spark):
    events = envelope.parse(log_frame(spark, [("keyless", 0, 0, event("c", 1, v=1))]))
    assert typed_events(events, KEYLESS.with_keys(["V"])).first().reason is None
    with pytest.raises(KeyError):
        KEYLESS.with_keys(["w"])


def test_unknown_columns_can_be_ignored(spark):
    events = envelope.parse(log_frame(spark, [("pairs", 0, 0, event("c", 1, a=1, b=2, z=3))]))
    policy = Policy(unknown_columns="ignore")
    row = typed_rows(typed_events(events, PAIRS, policy), PAIRS, policy).first()
    assert (row.reason, row.a, row.b, row.x) == (None, 1, 2, None)


def test_dead_letters_keep_what_is_needed_to_replay(spark, tmp_path):
    rows = [(t, 0, i, v) for i, (t, v, _) in enumerate(REASONS)]
    log = log_frame(spark, rows)
    refused = rejects.rejected(envelope.parse(log), {"pairs": PAIRS, "keyless": KEYLESS})
    path = str(tmp_path / "dead")
    for _ in range(2):
        rejects.append_dead_letters(refused, path, 0)
    entries = spark.read.schema(rejects.dead_letters(refused).schema).json(path)
    assert rejects.dead_letter_count(entries).first().entries == len(REASONS)
    again = {(r.topic, r.offset, r.value) for r in rejects.replayable(entries).collect()}
    assert again == {(TOPIC + t, i, v) for t, _, i, v in rows}
    first = entries.filter("error = 'unknown_table'").select("event.*", "stage", "retries").first()
    assert (first["__op"], first["__ts_ms"], first["__source_db"], first["__source_table"]) == ("c", 1, "", "nosuch")
    assert (first.stage, first.retries) == ("parse", 0)


def test_rejects_of_many_tables_read_and_parse_the_log_once(spark):
    catalog = {f"t{i}": TableSchema(f"t{i}", PAIRS.columns) for i in range(20)}
    rows = [(f"t{i}", 0, i, event("c", 1, a=i, b="x" if i % 2 else 1)) for i in range(20)] + [("other", 0, 99, "{bad")]
    found = rejects.rejected(replay.parsed(log_frame(spark, rows)), catalog)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "Union" not in plan
    # Only the catalog moves, one row per table.
    assert plan.count("Exchange") == plan.count("BroadcastExchange")
    want = {(i, "cast_error") for i in range(1, 20, 2)} | {(99, "parse_error")}
    assert {(r.offset, r.reason) for r in found.collect()} == want


def test_dead_letters_are_the_log_rows_they_were(spark, tmp_path):
    import datetime as dt

    from tidemark.sources.changelog import LOG_SCHEMA

    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    rows = [(TOPIC + "pairs", 1, 7, at, '{"a":1}', "{bad"), (TOPIC + "pairs", 1, 8, None, None, None)]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    rejects.append_dead_letters(rejects.rejected(envelope.parse(log), {"pairs": PAIRS}), str(tmp_path / "letters"), 0)
    again = rejects.replayable(spark.read.json(str(tmp_path / "letters")))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(rows, key=str)
