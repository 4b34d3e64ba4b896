"""Small files next to a table's data, through the file system that Spark itself uses for the path."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer has made this version."""


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    system, place = _at(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(place)] if system.exists(place) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    system, place = _at(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def read_json(spark: SparkSession, path: str) -> Any:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def commit_json(spark: SparkSession, path: str, value: Any) -> None:
    """Write a small file that appears whole or not at all, and never replaces one."""
    system, place = _at(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(hidden, True)
    try:
        stream.write(bytearray(json.dumps(value), "utf-8"))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(hidden, place):
        system.delete(hidden, False)
        raise CommitConflict(path)


def last_version(spark: SparkSession, folder: str) -> int | None:
    """The highest number among the files ``<number>.json`` of a folder."""
    numbers = [int(name.removesuffix(".json")) for name in names(spark, folder) if name.removesuffix(".json").isdigit()]
    return max(numbers, default=None)
