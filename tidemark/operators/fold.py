"""Ordered fold: all events of a key become one change row.

Applying events one after another keeps, per column, the last value written. That is a
maximum over (position, value), so it needs no window and no per-row state: each task
reduces its own events to one partial row per key before anything is shuffled, and a
key with a third of all events costs no more than any other in the exchange.

A change row has the key columns, one cell ``STRUCT<partition, offset, v>`` per other
column (NULL if never written) and the cell of the delete stamp. Folding is associative:
change rows of several batches combine into the change row of all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import DELETE, INSERT, UPDATE
from tidemark.functions.types import DELETED_AT, TableSchema, quoted
from tidemark.operators.typed import cell_of, payload_columns

FIRST_INSERT = "__first_insert"
EVENTS = "__events"
INSERTS = "__inserts"
UPDATES = "__updates"
FIRST_SLOT = "__first_slot"
LAST_SLOT = "__last_slot"

# Position of an event in its log. A key stays in one log partition.
LOG_ORDER = ("partition", "offset")
# For logs whose partition count was changed, so that keys moved between partitions.
TIME_ORDER = ("ts_ms", "partition", "offset")


def fold(typed: DataFrame, table: TableSchema, order: tuple[str, ...] = LOG_ORDER) -> DataFrame:
    """One change row per key that has at least one applicable event."""
    keys = table.keys
    fine = F.col("reason").isNull()
    position = [F.col(name) for name in order]
    inserts = fine & (F.col("operation") == INSERT)
    writes = fine & F.col("operation").isin(INSERT, UPDATE)
    stamps = fine & F.col("operation").isin(INSERT, DELETE)

    def last(when: Column, value: Column) -> Column:
        return F.max(F.when(when, F.struct(*position, value.alias("v"))))

    slot = F.when(fine, F.xxhash64("topic", "partition"))
    grouped = typed.select("*", *[F.col(f"{quoted(cell_of(k))}.v").alias(f"__key_{k}") for k in keys]).groupBy(
        *[F.col(quoted(f"__key_{k}")).alias(k) for k in keys]
    )
    values = [c.name for c in payload_columns(table) if c.name not in set(keys)]
    cells = [(c, quoted(cell_of(c))) for c in values]
    folded = grouped.agg(
        F.count_if(fine).alias(EVENTS),
        F.count_if(inserts).alias(INSERTS),
        F.count_if(fine & (F.col("operation") == UPDATE)).alias(UPDATES),
        F.min(slot).alias(FIRST_SLOT),
        F.max(slot).alias(LAST_SLOT),
        F.min(F.when(inserts, F.struct(*position))).alias(FIRST_INSERT),
        *[last(writes & F.col(cell).isNotNull(), F.col(f"{cell}.v")).alias(c) for c, cell in cells],
        last(stamps, F.col("delete_time")).alias(DELETED_AT),
    )
    return folded.filter(F.col(EVENTS) > 0)


def combine(changes: DataFrame, table: TableSchema) -> DataFrame:
    """Change rows of several batches, as the change rows of all their events."""
    values = [c.name for c in payload_columns(table) if c.name not in set(table.keys)]
    return changes.groupBy(*map(quoted, table.keys)).agg(
        *[F.sum(name).alias(name) for name in (EVENTS, INSERTS, UPDATES)],
        F.min(FIRST_SLOT).alias(FIRST_SLOT),
        F.max(LAST_SLOT).alias(LAST_SLOT),
        F.min(FIRST_INSERT).alias(FIRST_INSERT),
        *[F.max(quoted(c)).alias(c) for c in [*values, DELETED_AT]],
    )


def operation_counts(changes: DataFrame) -> DataFrame:
    """Number of folded events by operation."""
    counted = changes.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (EVENTS, INSERTS, UPDATES)])
    deletes = F.col(EVENTS) - F.col(INSERTS) - F.col(UPDATES)
    pairs = ((INSERT, F.col(INSERTS)), (UPDATE, F.col(UPDATES)), (DELETE, deletes))
    rows = F.array(*[F.struct(F.lit(op).alias("operation"), n.alias("events")) for op, n in pairs])
    return counted.select(F.inline(rows)).filter(F.col("events") > 0)


def keys_in_one_place(changes: DataFrame) -> DataFrame:
    """Change rows whose events all came from one log partition."""
    return changes.filter(F.col(FIRST_SLOT) == F.col(LAST_SLOT))


def keys_in_two_places(changes: DataFrame) -> DataFrame:
    """Change rows whose events came from more than one log partition.

    Their log order is undefined; fold such a log with ``TIME_ORDER`` instead.
    """
    return changes.filter(F.col(FIRST_SLOT) != F.col(LAST_SLOT))
