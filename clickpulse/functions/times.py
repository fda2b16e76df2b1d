"""Conversions between time text, epoch values and date parts (session time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date and time formats of the tables and reports.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_FORMAT = "yyyyMMddHHmmss"

_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}


def parse_time(text: Column) -> Column:
    """Time text ``yyyy-MM-dd HH:mm:ss`` as a timestamp; anything else, null too, fails the query."""
    shaped = F.when(text.rlike(_TIME_SHAPE), text)
    moment = F.try_to_timestamp(shaped, F.lit(TIME_FORMAT))
    shown = F.coalesce(text, F.lit("null"))
    return F.coalesce(moment, F.raise_error(F.concat(F.lit("not a time: "), shown)).cast("timestamp"))


def parse_millis(text: Column) -> Column:
    """Time text as epoch milliseconds, in whole seconds."""
    return F.unix_timestamp(parse_time(text)) * 1000


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def format_millis(millis: Column, pattern: str = TIME_FORMAT) -> Column:
    """Epoch milliseconds as text."""
    return F.date_format(from_millis(millis), pattern)


def date_part(millis: Column, part: str) -> Column:
    """Year, month (from 1), day, hour, minute, second or millisecond of an instant."""
    if part == "millisecond":
        return F.pmod(millis, F.lit(1000)).cast("int")
    return _PARTS[part](from_millis(millis))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)
