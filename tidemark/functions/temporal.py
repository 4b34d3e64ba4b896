"""Temporal conversions. None of them depends on the session time zone.

The source database writes local wall clock without a zone, and the connector ships it
as if it were UTC. The wall clock is therefore re-read in the source zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text layouts of a date and time, without and with a zone.
LOCAL_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{1,2}:\d{2}:\d{2}([.,]\d+)?$"
ZONED_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"
NUMBER = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"

# Microseconds are 64 bit, so this is the largest millisecond count that fits.
_MAX_MILLIS = 9223372036854775
# Day numbers of 0001-01-01 and 9999-12-31, the range of a DATE.
_MIN_DAY, _MAX_DAY = -719162, 2932896


def whole_of(text: Column) -> Column:
    """The whole number of a JSON number's text, which may have a fraction, that is dropped, or an exponent."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def instant_of_millis(ms: Column, source_zone: str) -> Column:
    """Epoch milliseconds of a source wall clock, as the instant it stands for."""
    in_range = F.when(ms.between(-_MAX_MILLIS, _MAX_MILLIS), ms)
    return F.to_utc_timestamp(F.timestamp_millis(in_range), source_zone)


def instant_of_text(text: Column, source_zone: str) -> Column:
    """ISO text as an instant; text without a zone is in the source zone, other text is NULL."""
    dotted = F.translate(text, ",", ".")
    local = F.to_utc_timestamp(F.concat(dotted, F.lit("Z")).try_cast("timestamp"), source_zone)
    return F.when(text.rlike(LOCAL_TEXT), local).when(text.rlike(ZONED_TEXT), dotted.try_cast("timestamp"))


def instant(text: Column, source_zone: str) -> Column:
    """A date-and-time field, sent as epoch milliseconds or as ISO text, as an instant."""
    by_number = F.when(text.rlike(NUMBER), instant_of_millis(whole_of(text), source_zone))
    return F.coalesce(by_number, instant_of_text(text, source_zone))


def target_text(at: Column, target_zone: str) -> Column:
    """An instant as ``yyyy-MM-dd HH:mm:ss`` in the target zone, sub-seconds dropped."""
    wall = F.from_utc_timestamp(at, target_zone)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(wall), epoch).cast("string")


def date_of(text: Column) -> Column:
    """A date field, sent as days since 1970-01-01 or as text. Dates never shift with a zone."""
    days = whole_of(text)
    in_range = F.when(days.between(_MIN_DAY, _MAX_DAY), days).cast("int")
    epoch = F.lit("1970-01-01").cast("date")
    return F.when(text.rlike(NUMBER), F.date_add(epoch, in_range)).otherwise(text.try_cast("date"))


def time_of_millis(ms: Column) -> Column:
    """Milliseconds as ``HH:MM:SS``; negative counts as zero, hours may exceed 24."""
    seconds = F.floor(F.greatest(ms, F.lit(0).cast("bigint")) / 1000).cast("bigint")
    hours = F.floor(seconds / 3600).cast("bigint")
    minutes = F.floor(seconds / 60).cast("bigint") % 60
    return F.format_string("%02d:%02d:%02d", hours, minutes, seconds % 60)


def time_of(text: Column) -> Column:
    """A time field, sent as milliseconds or as text, which is kept."""
    ms = whole_of(text)
    return F.when(text.rlike(NUMBER), F.when(ms.isNotNull(), time_of_millis(ms))).otherwise(text)
