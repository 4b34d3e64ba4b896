"""Change-log sources. Topics and files give the same columns:
topic, partition, offset, timestamp, key, value."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

EARLIEST = "earliest"
LATEST = "latest"


def topic_options(brokers: str, prefix: str, start: str = EARLIEST, per_trigger: int | None = None) -> dict[str, str]:
    """Reader options for every topic that starts with the prefix, new ones included."""
    if start not in (EARLIEST, LATEST):
        raise ValueError(f"invalid start {start!r}: must be {EARLIEST} or {LATEST}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribePattern": re.escape(prefix) + ".*",
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def stream_topics(spark: SparkSession, **options) -> DataFrame:
    """Stream of all topics with a prefix; needs Spark's Kafka package on the class path."""
    frame = spark.readStream.format("kafka").options(**topic_options(**options)).load()
    return _log_columns(frame)


def read_topics(spark: SparkSession, brokers: str, prefix: str) -> DataFrame:
    """All retained rows of the topics with a prefix, for a replay."""
    options = topic_options(brokers, prefix, EARLIEST)
    frame = spark.read.format("kafka").options(**options).option("endingOffsets", LATEST).load()
    return _log_columns(frame)


def _log_columns(frame: DataFrame) -> DataFrame:
    return frame.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def stream_files(spark: SparkSession, path: str, files_per_trigger: int | None = None, form: str = "parquet") -> DataFrame:
    """Stream of log files as they arrive.

    With a limit per trigger, files that hold events of the same key must arrive in log
    order, because a micro-batch is only ordered within itself.
    """
    reader = spark.readStream.schema(LOG_SCHEMA).format(form)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(*LOG_SCHEMA.fieldNames())


def read_files(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """All log files of a folder."""
    return spark.read.schema(LOG_SCHEMA).format(form).load(path).select(*LOG_SCHEMA.fieldNames())


def archive(log: DataFrame, path: str, mode: str = "append") -> None:
    """Keep log rows as files, one folder per topic.

    Reading one table then opens its own folder only: the test on the topic becomes a
    partition filter, so a replay of many tables reads each event once.
    """
    log.write.mode(mode).partitionBy("topic").parquet(path)


def with_prefix(log: DataFrame, prefix: str) -> DataFrame:
    """Rows of the topics that start with the prefix."""
    return log.filter(F.col("topic").startswith(prefix))


def delivered_once(stream: DataFrame, within: str) -> DataFrame:
    """A stream without the rows that were sent again, by topic, partition and offset.

    Replicas need no such thing, since a repeated event changes nothing there; counts and dead letters do. A row is
    known again for ``within`` of its log time, which bounds the state. Rows that are later than that behind the
    newest are taken for repeats and dropped, so it must be longer than any delay of delivery.
    """
    return stream.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def after_positions(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows past the position recorded for their topic and partition.

    ``positions`` has topic, partition and the last offset already taken. Partitions
    without a position start at the earliest row. Grouped, the positions are one row per
    log partition, which bounds what is broadcast; the log itself is not moved.
    """
    taken = positions.groupBy("topic", "partition").agg(F.max("offset").alias("__taken"))
    joined = log.join(F.broadcast(taken), ["topic", "partition"], "left")
    return joined.filter(F.col("__taken").isNull() | (F.col("offset") > F.col("__taken"))).drop("__taken")


def end_positions(log: DataFrame) -> DataFrame:
    """Last offset of every topic and partition: where a start at the latest row begins."""
    return log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def start_at(log: DataFrame, start: str = EARLIEST) -> DataFrame:
    """What a first run over a finished log sees: everything, or nothing yet."""
    if start == EARLIEST:
        return log
    if start == LATEST:
        return after_positions(log, end_positions(log))
    raise ValueError(f"invalid start {start!r}: must be {EARLIEST} or {LATEST}")
