"""Envelope functions: from a log row (topic, partition, offset, timestamp, key, value)
to a change event with its meta fields, operation and payload.

A payload is kept as two parallel arrays, ``names`` (lower case) and ``texts`` (raw
JSON text of each value, NULL for an explicit JSON null). A name that is missing from
``names`` is a column the event does not mention, which is not the same as a null.
Both arrays run backwards, so that the first hit of a repeated name is the last one
written, and looking a name up needs no map to be rebuilt per event.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The operation codes, operation names and meta field names of the wire format.
INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"
UNKNOWN = "UNKNOWN"
OPERATION_OF_CODE = {"c": INSERT, "r": INSERT, "u": UPDATE, "d": DELETE}
META_PREFIX = "__"
META_FIELDS = ("__op", "__ts_ms", "__source_db", "__source_table", "__deleted")

# Plain JSON only: the reader's lenient extras would let malformed events through.
_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def operation(op: Column) -> Column:
    """INSERT, UPDATE, DELETE or UNKNOWN for an operation code."""
    result = F.lit(UNKNOWN)
    for name in (DELETE, UPDATE, INSERT):
        codes = [code for code, target in OPERATION_OF_CODE.items() if target == name]
        result = F.when(op.isin(codes), F.lit(name)).otherwise(result)
    return result


def event_time(ts_ms: Column) -> Column:
    """Instant of an epoch-millisecond field."""
    return F.timestamp_millis(ts_ms)


def topic_table(topic: Column) -> Column:
    """Table a topic is named after: its third dot-part, NULL if it has fewer parts.

    Cut out between two prefixes: a split would compile its pattern anew for every row.
    """
    before, upto = F.substring_index(topic, ".", 2), F.substring_index(topic, ".", 3)
    return F.nullif(F.substring(upto, F.length(before) + 2, F.length(upto)), F.lit(""))


def routed_table(topic: Column, source_table: Column) -> Column:
    """Table of the topic if it names one, else the event's own table field."""
    return F.coalesce(topic_table(topic), source_table)


def has(names: Column, name: str) -> Column:
    """Whether the payload mentions the column."""
    return F.array_position(names, F.lit(name)) > 0


def text_of(names: Column, texts: Column, name: str) -> Column:
    """Raw text of a payload column; NULL when absent or explicitly null."""
    return F.get(texts, F.array_position(names, F.lit(name)).cast("int") - 1)


def payload_map(names: Column, texts: Column) -> Column:
    """The row columns of a payload as a map, meta fields removed.

    Repeated names keep the last value written.
    """
    kept = F.filter(F.array_distinct(names), lambda n: ~n.startswith(META_PREFIX))
    values = F.transform(kept, lambda n: F.get(texts, F.array_position(names, n).cast("int") - 1))
    return F.map_from_arrays(kept, values)


def _bigint(text: Column) -> Column:
    """Whole number of a JSON number's text, which may be written with an exponent."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def parse(log: DataFrame) -> DataFrame:
    """Parse every log row once into an event; nothing is dropped.

    Rows whose value is not one JSON object have ``parse_error`` set. A NULL value is a
    delete marker with an empty payload.
    """
    # Inside brackets, text after the object is a syntax error instead of being skipped.
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = log.withColumn("__objects", F.from_json(wrapped, "array<map<string,string>>", _STRICT_JSON))
    empty = F.array().cast("array<string>")
    body = F.get("__objects", F.lit(0))
    json_null = F.trim("value") == "null"
    one_object = (F.size("__objects") == 1) & (
        (body.isNotNull() & F.rtrim("value").endswith("}")) | json_null
    )
    usable = F.coalesce(one_object & body.isNotNull(), F.lit(False))
    found = F.struct(
        (F.col("value").isNotNull() & ~F.coalesce(one_object, F.lit(False))).alias("parse_error"),
        F.when(usable, F.reverse(F.transform(F.map_keys(body), F.lower))).otherwise(empty).alias("names"),
        F.when(usable, F.reverse(F.map_values(body))).otherwise(empty).alias("texts"),
    )
    # A generated row, not a projection: filters on what was parsed stay above it, so
    # that no event is parsed again to decide whether to keep it. Its fields are made before, since
    # Spark interprets a generator's own expressions in a stage too large to compile.
    log_columns = [F.col(c) for c in ("topic", "partition", "offset", "timestamp", "key")] + [F.col("value").alias("raw")]
    made = parsed.select(*log_columns, found.alias("__found"))
    arrays = made.select(*made.columns[:-1], F.inline(F.array("__found")))
    names, texts = F.col("names"), F.col("texts")
    tombstone = F.col("raw").isNull()
    op = F.when(tombstone, F.lit("d")).otherwise(text_of(names, texts, "__op"))
    deleted = F.when(tombstone, F.lit("true")).otherwise(text_of(names, texts, "__deleted"))
    return arrays.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        "key",
        "raw",
        "parse_error",
        op.alias("op"),
        operation(op).alias("operation"),
        _bigint(text_of(names, texts, "__ts_ms")).alias("ts_ms"),
        text_of(names, texts, "__source_db").alias("source_db"),
        routed_table(F.col("topic"), text_of(names, texts, "__source_table")).alias("source_table"),
        deleted.alias("deleted"),
        "names",
        "texts",
    )


def parse_list(text: str | None) -> list[str]:
    """Items of a comma-separated setting, trimmed, empty ones dropped."""
    return [item.strip() for item in (text or "").split(",") if item.strip()]


def exclude_tables(events: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Drop the events of excluded tables; names match exactly, case included."""
    names = list(tables)
    if not names:
        return events
    return events.filter(F.col("source_table").isNull() | ~F.col("source_table").isin(names))


def exclude_topics(log: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Drop log rows whose topic already names an excluded table, before they are parsed."""
    names = list(tables)
    if not names:
        return log
    named = topic_table(F.col("topic"))
    return log.filter(named.isNull() | ~named.isin(names))
