"""Typed conversion: the raw text of a payload value to the type of its column."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import temporal
from tidemark.functions.types import (
    BINARY_TYPES,
    BOOLEAN_TYPES,
    DATE_TYPES,
    DATETIME_TYPES,
    TIME_TYPES,
    WHOLE_TYPES,
    ColumnSpec,
    spark_type,
)

# The texts that count as true; any other text is false.
TRUE_TEXTS = ("1", "true", "TRUE")
# Up to here every whole number is a double.
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Policy:
    """How a job converts and applies events.

    dialect: ``postgres`` keeps instants, ``mysql`` renders text in the target zone.
    delete_time: ``event_time`` stamps a delete with the event's own time, so that a
        replay gives the same rows; ``processing_time`` stamps the time of the run.
    unknown_columns: ``reject`` the event, or ``ignore`` the column.
    """

    source_zone: str = "UTC"
    target_zone: str = "UTC"
    dialect: str = "postgres"
    delete_time: str = "event_time"
    unknown_columns: str = "reject"

    def __post_init__(self) -> None:
        _one_of("dialect", self.dialect, ("postgres", "mysql"))
        _one_of("delete_time", self.delete_time, ("event_time", "processing_time"))
        _one_of("unknown_columns", self.unknown_columns, ("reject", "ignore"))


def _one_of(setting: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"invalid {setting} {value!r}: must be one of {', '.join(allowed)}")


def boolean(text: Column, quoted: Column | None = None) -> Column:
    """Numbers are true unless zero; of the texts only 1, true and TRUE are.

    ``quoted`` says whether a number stood in quotes, which makes it a text. It is only looked at for numbers that are
    neither zero nor one.
    """
    number = text.rlike(temporal.NUMBER) & (text.try_cast("double") != 0)
    number = number if quoted is None else number & ~quoted
    return F.when(text.isin(*TRUE_TEXTS), F.lit(True)).otherwise(F.when(text.isNotNull(), F.coalesce(number, F.lit(False))))


def quoted_in(raw: Column, name: str) -> Column:
    """Whether a field of a JSON object, named without regard to case, is a text."""
    # Lower case throughout: the names' own spelling is not known, and quotes stay quotes.
    value = F.try_variant_get(F.try_parse_json(F.lower(raw)), "$[" + json.dumps(name) + "]", "variant")
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def convert(text: Column, column: ColumnSpec, policy: Policy, raw: Column | None = None) -> Column:
    """Typed value of a payload text; NULL if it is NULL or does not fit the column.

    With the event's raw text, numbers in quotes are told from numbers where that matters.
    """
    name = column.data_type
    if name in DATETIME_TYPES:
        at = temporal.instant(text, policy.source_zone)
        return temporal.target_text(at, policy.target_zone) if policy.dialect == "mysql" else at
    if name in DATE_TYPES:
        return temporal.date_of(text)
    if name in TIME_TYPES:
        return temporal.time_of(text)
    if name in BOOLEAN_TYPES:
        return boolean(text, None if raw is None else quoted_in(raw, column.name))
    if name in BINARY_TYPES:
        return F.try_to_binary(text, F.lit("base64"))
    target = spark_type(column, policy.dialect)
    if target.simpleString() == "string":
        return text
    if name in WHOLE_TYPES:
        return F.coalesce(text.try_cast(target), _whole_double(text).try_cast(target))
    return text.try_cast(target)


def _whole_double(text: Column) -> Column:
    """A whole number that is written with a fraction of zero or with an exponent, as 5.0 is."""
    value = F.when(text.rlike(temporal.NUMBER), text.try_cast("double"))
    return F.when((F.abs(value) <= _EXACT) & (value == F.floor(value)), value)


def always_fits(column: ColumnSpec, policy: Policy) -> bool:
    """Whether any text can be converted to the column's type."""
    if column.data_type in BOOLEAN_TYPES:
        return True
    plain = column.data_type not in DATETIME_TYPES and column.data_type not in TIME_TYPES
    return plain and spark_type(column, policy.dialect).simpleString() == "string"


def fits(text: Column, column: ColumnSpec, policy: Policy) -> Column:
    """Whether a text that is not NULL can be converted: :func:`convert` without the work that only its value needs."""
    if always_fits(column, policy):
        return F.lit(True)
    if column.data_type in DATETIME_TYPES:
        return temporal.instant(text, policy.source_zone).isNotNull()
    if column.data_type in TIME_TYPES:
        return ~text.rlike(temporal.NUMBER) | temporal.whole_of(text).isNotNull()
    return convert(text, column, policy).isNotNull()


def default_value(column: ColumnSpec, policy: Policy, now: Column | None = None) -> Column:
    """The value a new row gets for a column its insert does not mention; ``now`` replaces the time of this run."""
    target = spark_type(column, policy.dialect)
    if column.default is None:
        return F.lit(None).cast(target)
    # Bit literals are written b'0' and b'1' in the source's catalog.
    text = column.default.removeprefix("b'").removesuffix("'") if column.default.startswith("b'") else column.default
    if text.lower().startswith("current_timestamp"):
        now = F.current_timestamp() if now is None else now
        return temporal.target_text(now, policy.target_zone) if policy.dialect == "mysql" else now
    if column.data_type in DATETIME_TYPES or column.data_type in BOOLEAN_TYPES:
        return convert(F.lit(text), column, policy)
    return F.lit(text).try_cast(target)
