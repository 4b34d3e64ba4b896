"""Shape full source tables, and lists of them, for the replica."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import Policy
from tidemark.functions.temporal import target_text
from tidemark.functions.types import DATETIME_TYPES, DELETED_AT, TableSchema, replica_schema


def lower_names(frame: DataFrame) -> DataFrame:
    """Column names without quotes, in lower case; two names may not become one."""
    names = [c.replace("`", "").replace('"', "").lower() for c in frame.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names differ only in case: {twice}")
    return frame.toDF(*names)


def bootstrap(frame: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """A source table as replica rows: types from the catalog, delete stamp added.

    Wall-clock columns (timestamps without zone) are read in the source zone. The plan is
    one projection over the scan. A value that does not fit its column becomes NULL instead of ending the load;
    :func:`misfits` lists such values.
    """
    source = lower_names(frame)
    stamp = F.col(DELETED_AT) if DELETED_AT in source.columns else F.lit(None)
    return source.select(*_typed(source, table, policy), stamp.cast("timestamp").alias(DELETED_AT))


def misfits(frame: DataFrame, table: TableSchema, policy: Policy = Policy()) -> DataFrame:
    """(keys, column_name, text) of the values of a source table that do not fit the replica's column."""
    source = lower_names(frame)
    keys = [F.col(f"`{k}`").cast("string").alias(k) for k in table.keys]
    typed = source.select("*", F.struct(*_typed(source, table, policy)).alias("__typed"))
    bad = [
        F.when(F.col(f"`{c.name}`").isNotNull() & F.col("__typed")[c.name].isNull(),
               F.struct(F.lit(c.name).alias("column_name"), F.col(f"`{c.name}`").cast("string").alias("text")))
        for c in table.columns if c.name != DELETED_AT
    ]
    return typed.select(*keys, F.inline(F.filter(F.array(*bad), lambda x: x.isNotNull())))


def _typed(source: DataFrame, table: TableSchema, policy: Policy) -> list[Column]:
    """The source's columns with the replica's types."""
    kinds = dict(source.dtypes)
    columns = []
    for column, field in zip([c for c in table.columns if c.name != DELETED_AT], replica_schema(table, policy.dialect)):
        value = F.col(f"`{column.name}`")
        if column.data_type in DATETIME_TYPES:
            if kinds[column.name] == "timestamp_ntz":
                # Text in between keeps the wall clock whatever the session zone is.
                value = F.to_utc_timestamp(F.concat(value.cast("string"), F.lit("Z")).cast("timestamp"), policy.source_zone)
            if policy.dialect == "mysql":
                value = target_text(value, policy.target_zone)
        # Only texts and numbers may fail to fit.
        fits = kinds[column.name] in ("string", "double", "float", "int", "bigint", "smallint", "tinyint") or kinds[column.name].startswith("decimal")
        columns.append((value.try_cast(field.dataType) if fits else value.cast(field.dataType)).alias(field.name))
    return columns


def table_list(tables: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Tables to replicate: excluded ones dropped, names that differ only in case merged.

    ``tables`` has table_name and a position; the first spelling of a name is kept.
    """
    name = F.lower("table_name")
    wanted = tables.filter(~name.isin([t.lower() for t in excluded]))
    first = wanted.groupBy(name.alias("replica_table")).agg(F.min(F.struct("position", "table_name")).alias("first"))
    return first.select("replica_table", F.col("first.table_name").alias("source_table"))
