"""Merge of folded changes into a replica.

Row absent: an insert creates it, and only events from the first insert on count.
Row present: every write counts. Updates and deletes never create a row, and a delete
only stamps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy, default_value
from tidemark.functions.types import DELETED_AT, TableSchema, quoted, replica_schema
from tidemark.operators.fold import FIRST_INSERT
from tidemark.operators.typed import payload_columns

_PRESENT = "__present"


def rows_created(changes: DataFrame, table: TableSchema, policy: Policy = Policy(), now: Column | None = None) -> DataFrame:
    """Replica rows of keys that have no row yet; keys without an insert give none.

    ``now`` is what a default of the current time means, if not the time of this run.
    """
    created = changes.filter(F.col(FIRST_INSERT).isNotNull())
    order = changes.schema[FIRST_INSERT].dataType.fieldNames()

    def counts(column: str) -> Column:
        position = F.struct(*[F.col(f"`{column}`.`{name}`").alias(name) for name in order])
        return F.col(quoted(column)).isNotNull() & (position >= F.col(FIRST_INSERT))

    keys = set(table.keys)
    values = [
        F.col(quoted(c.name))
        if c.name in keys
        else F.when(counts(c.name), F.col(f"`{c.name}`.v")).otherwise(default_value(c, policy, now)).alias(c.name)
        for c in payload_columns(table)
    ]
    stamp = F.when(counts(DELETED_AT), F.col(f"{DELETED_AT}.v")).alias(DELETED_AT)
    return _as_replica(created.select(*values, stamp), table, policy)


def merge(replica: DataFrame, changes: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """The replica after the changes, by one full outer join on the key.

    Both sides have one row per key, so no key is hot here.
    """
    keys = table.keys
    old = replica.withColumn(_PRESENT, F.lit(True)).alias("old")
    new = changes.alias("new")
    same = [F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys]
    joined = old.join(new, same, "full_outer")
    present = F.coalesce(F.col(_PRESENT), F.lit(False))
    order = changes.schema[FIRST_INSERT].dataType.fieldNames()
    first = F.col(f"new.{FIRST_INSERT}")

    def counts(column: str) -> Column:
        position = F.struct(*[F.col(f"new.`{column}`.`{name}`").alias(name) for name in order])
        return F.col(f"new.`{column}`").isNotNull() & (present | (position >= first))

    def value(column: str, fallback: Column) -> Column:
        return (
            F.when(counts(column), F.col(f"new.`{column}`.v"))
            .when(present, F.col(f"old.`{column}`"))
            .otherwise(fallback)
            .alias(column)
        )

    columns = [
        F.coalesce(F.col(f"old.`{c.name}`"), F.col(f"new.`{c.name}`")).alias(c.name)
        if c.name in keys
        else value(c.name, default_value(c, policy))
        for c in payload_columns(table)
    ]
    kept = joined.filter(present | first.isNotNull())
    return _as_replica(kept.select(*columns, value(DELETED_AT, F.lit(None))), table, policy)


def merge_broadcast(replica: DataFrame, changes: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """The same rows as :func:`merge`, without moving the replica.

    For change sets of a checked size: the changes go to every task of the replica scan.
    The second, keys-only scan finds which of the changes hit a row; the others are new.
    """
    keys = table.keys
    small = F.broadcast(changes.alias("new"))
    same = [F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys]
    joined = replica.alias("old").join(small, same, "left")

    def value(column: str) -> Column:
        hit = F.col(f"new.`{column}`").isNotNull()
        return F.when(hit, F.col(f"new.`{column}`.v")).otherwise(F.col(f"old.`{column}`")).alias(column)

    columns = [
        F.col(f"old.`{c.name}`").alias(c.name) if c.name in keys else value(c.name) for c in payload_columns(table)
    ]
    kept = _as_replica(joined.select(*columns, value(DELETED_AT)), table, policy)
    named = [quoted(k) for k in keys]
    hits = replica.select(*named).join(F.broadcast(changes.select(*named)), keys, "left_semi")
    fresh = changes.join(F.broadcast(hits), keys, "left_anti")
    return kept.unionByName(rows_created(fresh, table, policy))


def _as_replica(rows: DataFrame, table: TableSchema, policy: Policy) -> DataFrame:
    fields = replica_schema(table, policy.dialect).fields
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def empty_replica(spark, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """A replica without rows."""
    return spark.createDataFrame([], replica_schema(table, policy.dialect))


def live_rows(replica: DataFrame) -> DataFrame:
    """Rows that are not deleted."""
    return replica.filter(F.col(DELETED_AT).isNull())
