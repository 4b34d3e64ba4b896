"""Processing statistics as grouped aggregates over applied and rejected events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Upper bounds, in seconds, of the duration histogram.
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def processed(typed: DataFrame) -> DataFrame:
    """Applied events by table and operation."""
    counted = typed.groupBy("source_table", "operation").agg(F.count_if(F.col("reason").isNull()).alias("events"))
    return counted.filter(F.col("events") > 0)


def failed(rejects: DataFrame) -> DataFrame:
    """Rejected events by table, operation and error type."""
    return rejects.groupBy(
        F.coalesce("source_table", F.lit("")).alias("source_table"), "operation", F.col("reason").alias("error_type")
    ).agg(F.count(F.lit(1)).alias("events"))


def statement_durations(batches: DataFrame) -> DataFrame:
    """Share of its batch's duration each event gets.

    ``batches`` has one row per (batch_id, source_table, operation) with the number of
    events and the seconds the whole batch took.
    """
    # A batch has a few rows only, one per table and operation.
    batch_size = F.sum("events").over(Window.partitionBy("batch_id"))
    return batches.select("source_table", "operation", "events", (F.col("seconds") / batch_size).alias("duration"))


def duration_histogram(durations: DataFrame, buckets: tuple[float, ...] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative histogram by table and operation, one row per bucket and one for +Inf."""
    weight = F.col("events")
    wide = durations.groupBy("source_table", "operation").agg(
        *[F.sum(F.when(F.col("duration") <= b, weight).otherwise(0)).alias(f"b{i}") for i, b in enumerate(buckets)],
        F.sum(weight).alias("observations"),
        F.sum(F.col("duration") * weight).alias("total_seconds"),
    )
    rows = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("observations").alias("cumulative")))
    return wide.select(
        "source_table", "operation", "observations", "total_seconds", F.inline(F.array(*rows))
    )


def lag(log: DataFrame, applied: DataFrame) -> DataFrame:
    """Messages behind, by topic and partition. Nothing applied yet means all of them."""
    end = log.groupBy("topic", "partition").agg(
        F.max("offset").alias("end_offset"), F.min("offset").alias("start_offset")
    )
    done = applied.groupBy("topic", "partition").agg(F.max("offset").alias("applied_offset"))
    behind = F.col("end_offset") - F.coalesce("applied_offset", F.col("start_offset") - 1)
    return end.join(done, ["topic", "partition"], "left").select(
        "topic", "partition", "end_offset", "applied_offset", behind.alias("lag")
    )
