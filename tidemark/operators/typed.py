"""Typed events of one table, each with the reason it cannot be applied, if any.

Rejected events are marked, not filtered out: a filter on the outcome would be pushed
below the projection and parse every event a second time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy, always_fits, convert, fits
from tidemark.functions.envelope import (
    DELETE,
    INSERT,
    META_PREFIX,
    UNKNOWN,
    UPDATE,
    event_time,
    has,
    text_of,
    topic_table,
)
from tidemark.functions.types import DELETED_AT, FAMILIES, ColumnSpec, TableSchema, quoted, spark_type

# Reject reasons, in the order they are tested.
PARSE_ERROR = "parse_error"
UNKNOWN_TABLE = "unknown_table"
UNKNOWN_OPERATION = "unknown_operation"
NO_PRIMARY_KEY = "no_primary_key"
MISSING_KEY = "missing_key"
NO_COLUMNS_TO_UPDATE = "no_columns_to_update"
UNKNOWN_COLUMN = "unknown_column"
CAST_ERROR = "cast_error"

EVENT_COLUMNS = (
    "topic",
    "partition",
    "offset",
    "timestamp",
    "key",
    "raw",
    "op",
    "operation",
    "ts_ms",
    "source_db",
    "source_table",
    "deleted",
)


def belongs_to(table: str) -> Column:
    """Whether a parsed event is routed to a table; names match without regard to case.

    The test on the topic is implied by the other, but it can run before the parse, so
    that the events of other tables are not parsed at all.
    """
    named = topic_table(F.col("topic"))
    return (named.isNull() | (F.lower(named) == table.lower())) & (F.lower("source_table") == table.lower())


def table_events(events: DataFrame, table: TableSchema) -> DataFrame:
    """Parsed events routed to a table."""
    return events.filter(belongs_to(table.table))


def cell_of(name: str) -> str:
    """Name of the cell of a column in typed events; source columns may be named like an event's own fields."""
    return f"__cell_{name}"


def payload_columns(table: TableSchema) -> list[ColumnSpec]:
    """Columns events may set. The delete stamp belongs to the replica, not to the source."""
    return [c for c in table.columns if c.name != DELETED_AT]


def _stray(table: TableSchema, policy: Policy) -> Column:
    """Whether a write mentions a column that the table does not have."""
    known = [c.name for c in payload_columns(table)] + [DELETED_AT]
    stray = F.exists("names", lambda n: ~n.isin(known) & ~n.startswith(META_PREFIX))
    return F.lit(False) if policy.unknown_columns == "ignore" else F.col("operation").isin(INSERT, UPDATE) & stray


def _touched(table: TableSchema) -> Column:
    """Whether an event mentions a column outside the key."""
    if not table.keys:
        return F.lit(True)
    return F.exists("names", lambda n: ~n.isin(sorted(table.keys)) & ~n.startswith(META_PREFIX))


def _reason(table: TableSchema, stray: Column, touched: Column, text: dict[str, Column], typed: dict[str, Column]) -> Column:
    """Why an event cannot be applied, NULL if it can."""
    writes = F.col("operation").isin(INSERT, UPDATE)
    keys = set(table.keys)

    def misfit(name: str) -> Column:
        bad = text[name].isNotNull() & typed[name].isNull()
        # A delete uses its key only, so its other columns need not fit.
        return bad if name in keys else bad & writes

    def any_of(tests: list[Column]) -> Column:
        result = F.lit(False)
        for test in tests:
            result = result | test
        return result

    return (
        F.when(F.col("parse_error"), F.lit(PARSE_ERROR))
        .when(F.col("operation") == UNKNOWN, F.lit(UNKNOWN_OPERATION))
        .when(F.lit(not keys), F.lit(NO_PRIMARY_KEY))
        .when(any_of([text[k].isNull() for k in table.keys]), F.lit(MISSING_KEY))
        .when((F.col("operation") == UPDATE) & ~touched, F.lit(NO_COLUMNS_TO_UPDATE))
        .when(stray, F.lit(UNKNOWN_COLUMN))
        .when(any_of([misfit(name) for name in text]), F.lit(CAST_ERROR))
    )


def _catalog_rows(spark: SparkSession, catalog: dict[str, TableSchema], policy: Policy) -> tuple[DataFrame, list[ColumnSpec]]:
    """One row per table with its columns, the kind of each, and its keys; and one column of each kind.

    Columns are of one kind if they are converted alike, so there are as many kinds as there are types, however
    many tables and columns. Columns that any text fits have no kind.
    """
    kinds: dict[tuple[str, str], int] = {}
    samples: list[ColumnSpec] = []

    def kind(column: ColumnSpec) -> int | None:
        if always_fits(column, policy):
            return None
        family = next((f for f in FAMILIES if column.data_type in f), None)
        of = (family[0] if family else "", spark_type(column, policy.dialect).simpleString())
        if of not in kinds:
            kinds[of] = len(samples)
            samples.append(column)
        return kinds[of]

    # Names match without regard to case; of two tables that differ in case only, the later one counts.
    tables = {t.table.lower(): (name, t) for name, t in catalog.items()}
    rows = [
        (key, name, [c.name for c in payload_columns(t)], [kind(c) for c in payload_columns(t)], t.keys)
        for key, (name, t) in tables.items()
    ]
    types = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string())]
    names = ["__table", "table_name", "__columns", "__kinds", "__keys"]
    columns = list(zip(*rows)) or [()] * len(names)
    found = pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})
    return spark.createDataFrame(found), samples


def validated(events: DataFrame, catalog: dict[str, TableSchema], policy: Policy = Policy()) -> DataFrame:
    """Every parsed event once, with the catalog table it belongs to (or NULL) and the reason it cannot be applied there.

    The catalog is data here, not code: an event meets its table's columns by a join with one row per table, and
    each value it carries is tested by the kind of its column. So the plan has one branch per type, and an event
    costs what it carries, however many tables there are.
    """
    specs, samples = _catalog_rows(events.sparkSession, catalog, policy)
    # One row per table of the catalog.
    found = events.join(F.broadcast(specs), F.lower("source_table") == F.col("__table"), "left")
    names, texts, known, keys = (F.col(c) for c in ("names", "texts", "__columns", "__keys"))
    writes = F.col("operation").isin(INSERT, UPDATE)
    # Made once per event, as columns: inside a lambda they would be made once per value.
    kinds = F.transform(names, lambda n: F.get(F.col("__kinds"), F.array_position(known, n).cast("int") - 1))
    repeats = F.size(F.array_distinct(names)) < F.size(names)
    found = found.select(
        *EVENT_COLUMNS, "parse_error", "names", "texts", "table_name", "__table", "__columns", "__keys",
        F.inline(F.array(F.struct(kinds.alias("__kinds_of_names"), repeats.alias("__repeats")))),
    )

    def own(name: Column) -> Column:
        return ~name.startswith(META_PREFIX)

    def misfit(name: Column, i: Column) -> Column:
        text, kind = F.get(texts, i), F.get(F.col("__kinds_of_names"), i)
        bad = F.lit(False)
        for number, sample in reversed(list(enumerate(samples))):
            bad = F.when(kind == number, ~fits(text, sample, policy)).otherwise(bad)
        # Of a repeated name the last value counts, which comes first; a delete uses its key only.
        counts = kind.isNotNull() & text.isNotNull() & (writes | F.array_contains(keys, name))
        return F.when(counts & (~F.col("__repeats") | (F.array_position(names, name) == i + 1)), bad).otherwise(F.lit(False))

    stray = F.exists(names, lambda n: ~F.array_contains(known, n) & (n != DELETED_AT) & own(n))
    stray = F.lit(False) if policy.unknown_columns == "ignore" else writes & stray
    missing = F.exists(keys, lambda k: F.get(texts, F.array_position(names, k).cast("int") - 1).isNull())
    touched = F.exists(names, lambda n: ~F.array_contains(keys, n) & own(n))
    reason = (
        F.when(F.col("__table").isNull(), F.lit(None).cast("string"))
        .when(F.col("parse_error"), F.lit(PARSE_ERROR))
        .when(F.col("operation") == UNKNOWN, F.lit(UNKNOWN_OPERATION))
        .when(F.size(keys) == 0, F.lit(NO_PRIMARY_KEY))
        .when(missing, F.lit(MISSING_KEY))
        .when((F.col("operation") == UPDATE) & ~touched, F.lit(NO_COLUMNS_TO_UPDATE))
        .when(stray, F.lit(UNKNOWN_COLUMN))
        .when(F.array_contains(F.transform(names, misfit), F.lit(True)), F.lit(CAST_ERROR))
    )
    # The outcome goes through a generated row, so that a filter on it does not make every event be converted twice.
    outcome = F.struct(F.col("table_name"), reason.alias("reason"))
    return found.select(*EVENT_COLUMNS, "parse_error", F.inline(F.array(outcome)))


def typed_events(events: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """Convert the events of one table.

    Every column of the table becomes a cell ``STRUCT<v>``, named by :func:`cell_of`: a NULL cell is a column the
    event does not mention, a cell with a NULL ``v`` an explicit null. ``reason`` is NULL
    for events that can be applied.
    """
    columns = payload_columns(table)
    mine = table_events(events, table)
    names, texts = F.col("names"), F.col("texts")
    keys = set(table.keys)
    mentioned = mine.select(
        *EVENT_COLUMNS,
        "parse_error",
        _stray(table, policy).alias("__stray"),
        _touched(table).alias("__touched"),
        *[text_of(names, texts, c.name).alias(f"__text_{c.name}") for c in columns],
        *[has(names, c.name).alias(f"__has_{c.name}") for c in columns if c.name not in keys],
    )
    converted = mentioned.select(
        "*", *[convert(F.col(quoted(f"__text_{c.name}")), c, policy, F.col("raw")).alias(f"__typed_{c.name}") for c in columns]
    )
    reason = _reason(
        table,
        F.col("__stray"),
        F.col("__touched"),
        {c.name: F.col(quoted(f"__text_{c.name}")) for c in columns},
        {c.name: F.col(quoted(f"__typed_{c.name}")) for c in columns},
    )

    def cell(column: ColumnSpec) -> Column:
        value = F.struct(F.col(quoted(f"__typed_{column.name}")).alias("v"))
        text, carried = quoted(f"__text_{column.name}"), quoted(f"__has_{column.name}")
        present = F.col(text).isNotNull() if column.name in keys else F.col(carried)
        return F.when(present, value).alias(cell_of(column.name))

    stamp = F.current_timestamp()
    if policy.delete_time == "event_time":
        stamp = F.coalesce(event_time(F.col("ts_ms")), F.col("timestamp"), stamp)
    return converted.select(
        *EVENT_COLUMNS,
        F.when(F.col("operation") == DELETE, stamp).alias("delete_time"),
        reason.alias("reason"),
        *[cell(c) for c in columns],
    )


def applicable(typed: DataFrame) -> DataFrame:
    """Only the events that can be applied."""
    return typed.filter(F.col("reason").isNull())


def typed_rows(typed: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """Typed events with plain values instead of cells."""
    values = [F.col(f"{quoted(cell_of(c.name))}.v").cast(spark_type(c, policy.dialect)).alias(c.name) for c in payload_columns(table)]
    return typed.select("topic", "partition", "offset", "operation", "reason", *values)
