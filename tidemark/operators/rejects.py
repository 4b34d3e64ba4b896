"""Rejected events: every one is kept, with its raw message and a reason."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy
from tidemark.functions.envelope import topic_table
from tidemark.functions.types import TableSchema, quoted
from tidemark.operators.fold import keys_in_two_places
from tidemark.operators.typed import (
    EVENT_COLUMNS,
    PARSE_ERROR,
    UNKNOWN_OPERATION,
    UNKNOWN_TABLE,
    cell_of,
    validated,
)
from tidemark.sources.changelog import LOG_SCHEMA

# Stages an event can be rejected in.
STAGE_PARSE = "parse"
STAGE_APPLY = "apply"
STAGE_SINK = "sink"
SINK_ERROR = "sink_error"
DEADLOCK_EXHAUSTED = "deadlock_exhausted"
SPLIT_KEY = "split_key"


def _lost(tables: Iterable[str]) -> Column:
    """Whether neither the topic nor the event names a known table."""
    known = [t.lower() for t in tables]
    named = topic_table(F.col("topic"))
    return (named.isNull() | ~F.lower(named).isin(known)) & (
        F.col("source_table").isNull() | ~F.lower("source_table").isin(known)
    )


def _lost_reason() -> Column:
    return F.when(F.col("parse_error"), F.lit(PARSE_ERROR)).otherwise(F.lit(UNKNOWN_TABLE))


def unroutable(events: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Events that reach no table: malformed, or of a table the catalog does not have."""
    return events.filter(_lost(tables)).select(*EVENT_COLUMNS, _lost_reason().alias("reason"))


def rejected(events: DataFrame, catalog: dict[str, TableSchema], policy: Policy = Policy()) -> DataFrame:
    """All events of a parsed log that cannot be applied, with their reason, in one pass."""
    outcome = validated(events, catalog, policy)
    reason = F.when(F.col("table_name").isNull() & _lost(catalog), _lost_reason()).otherwise(F.col("reason"))
    return outcome.select(*EVENT_COLUMNS, reason.alias("reason")).filter(F.col("reason").isNotNull())


def rejected_of(typed: DataFrame) -> DataFrame:
    """The rejected ones among the typed events of a table."""
    # The outcome goes through a generated column, so that the filter on it does not make
    # every event be converted twice.
    settled = typed.select(*EVENT_COLUMNS, F.explode(F.array("reason")).alias("reason"))
    return settled.filter(F.col("reason").isNotNull())


def split_keys(typed: DataFrame, changes: DataFrame, table: TableSchema) -> DataFrame:
    """The applicable events of keys that came from several log partitions, so that their order is undefined."""
    keys = keys_in_two_places(changes).select(*[F.col(quoted(k)).alias(f"__split_{i}") for i, k in enumerate(table.keys)])
    same = [F.col(f"{quoted(cell_of(k))}.v") == F.col(f"__split_{i}") for i, k in enumerate(table.keys)]
    found = typed.filter(F.col("reason").isNull()).join(keys, same, "left_semi")
    return found.select(*EVENT_COLUMNS, F.lit(SPLIT_KEY).alias("reason"))


def sink_failure(events: DataFrame, error: str) -> DataFrame:
    """A whole batch whose sink failed, as rejects."""
    return events.select(*EVENT_COLUMNS, F.lit(error).alias("reason"))


def _stage() -> Column:
    reason = F.col("reason")
    return (
        F.when(reason.isin(PARSE_ERROR, UNKNOWN_TABLE, UNKNOWN_OPERATION), F.lit(STAGE_PARSE))
        .when(reason.isin(SINK_ERROR, DEADLOCK_EXHAUSTED), F.lit(STAGE_SINK))
        .otherwise(F.lit(STAGE_APPLY))
    )


def dead_letters(rejects: DataFrame, at: Column | None = None, retries: int = 0) -> DataFrame:
    """Dead-letter entries. The raw message is kept, so an entry can be replayed."""
    # The field names of an entry's event; missing ones are empty or zero.
    event = F.struct(
        F.coalesce("op", F.lit("")).alias("__op"),
        F.coalesce("ts_ms", F.lit(0)).alias("__ts_ms"),
        F.coalesce("source_db", F.lit("")).alias("__source_db"),
        F.coalesce("source_table", F.lit("")).alias("__source_table"),
        F.coalesce("deleted", F.lit("")).alias("__deleted"),
    )
    return rejects.select(
        event.alias("event"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("logged"),
        "key",
        "raw",
        _stage().alias("stage"),
        F.col("reason").alias("error"),
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit(retries).alias("retries"),
    )


def append_dead_letters(rejects: DataFrame, path: str, batch: int | str) -> None:
    """Write a batch's entries as JSON lines. Writing a batch again replaces it."""
    dead_letters(rejects).write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch}")


def dead_letter_count(entries: DataFrame) -> DataFrame:
    """Number of entries."""
    return entries.agg(F.count(F.lit(1)).alias("entries"))


def replayable(entries: DataFrame) -> DataFrame:
    """Dead-letter entries, also ones read back from JSON lines, as the log rows they were."""
    values = {"timestamp": F.col("logged"), "value": F.col("raw")}
    return entries.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])


