"""Compare what the source has with what the replica has, by table and by column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import DELETED_AT


def _lower(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")
    ).distinct()


def columns_apart(source: DataFrame, target: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Columns only one side has. The delete stamp is expected on the target only."""
    left = _lower(source).filter(~F.col("table_name").isin([t.lower() for t in excluded]))
    right = _lower(target).filter(F.col("column_name") != DELETED_AT)
    on = ["table_name", "column_name"]
    missing = left.join(right, on, "left_anti").withColumn("side", F.lit("missing_in_target"))
    extra = right.join(left, on, "left_anti").withColumn("side", F.lit("missing_in_source"))
    return missing.unionByName(extra)


def tables_apart(source: DataFrame, target: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Tables only one side has."""
    left = _lower(source).select("table_name").distinct().filter(~F.col("table_name").isin([t.lower() for t in excluded]))
    right = _lower(target).select("table_name").distinct()
    missing = left.join(right, "table_name", "left_anti").withColumn("side", F.lit("missing_in_target"))
    extra = right.join(left, "table_name", "left_anti").withColumn("side", F.lit("missing_in_source"))
    return missing.unionByName(extra)


def summary(source: DataFrame, target: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """One row: table counts, the expected one, and whether every table can be soft-deleted."""
    dropped = [t.lower() for t in excluded]
    source_table = F.when(F.col("side") == "source", F.col("table_name"))
    target_table = F.when(F.col("side") == "target", F.col("table_name"))
    both = _lower(source).withColumn("side", F.lit("source")).unionByName(
        _lower(target).withColumn("side", F.lit("target"))
    )
    return both.agg(
        F.count_distinct(source_table).alias("source_tables"),
        F.count_distinct(F.when(~F.col("table_name").isin(dropped), source_table)).alias("expected_tables"),
        F.count_distinct(target_table).alias("target_tables"),
        F.count_distinct(F.when(F.col("column_name") == DELETED_AT, target_table)).alias("with_deleted_at"),
    ).select(
        "*",
        (F.col("target_tables") == F.col("expected_tables")).alias("counts_match"),
        (F.col("with_deleted_at") == F.col("target_tables")).alias("all_with_deleted_at"),
    )
