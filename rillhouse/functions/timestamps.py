"""Time helpers.  All labels follow spark.sql.session.timeZone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillhouse.functions.numbers import parse_integer
from rillhouse.functions.text import is_blank

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


# first and last millisecond of the years 1 to 9999
FIRST_MILLI, LAST_MILLI = -62135596800000, 253402300799999


def millis_to_timestamp(c: Column) -> Column:
    """Null for a number outside the years 1 to 9999, which no timestamp can show."""
    return F.timestamp_millis(F.when(c.between(FIRST_MILLI, LAST_MILLI), c))


def second_label(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def date_label(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def hour_label(ts: Column) -> Column:
    """``HH:00:00``"""
    return F.concat(F.date_format(ts, "HH"), F.lit(":00:00"))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def parse_event_time(c: Column, fallback: Column) -> Column:
    """Lenient: epoch milliseconds, then ``yyyy-MM-dd HH:mm:ss``, else ``fallback``."""
    by_number = millis_to_timestamp(parse_integer(c))
    by_text = F.try_to_timestamp(c, F.lit(SECOND_FORMAT))
    return F.when(is_blank(c), fallback).otherwise(F.coalesce(by_number, by_text, fallback))


def to_label(c: Column, data_type: str) -> Column:
    """Text form of a report value: timestamps and dates become strings, others stay."""
    if data_type.startswith("timestamp"):
        return second_label(c)
    if data_type == "date":
        return date_label(c)
    return c
