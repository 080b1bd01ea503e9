"""Dates and timestamps without a time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts accepted besides ISO 8601, tried in this order.
EXTRA_LAYOUTS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)
# Fixed value: largest epoch number read as seconds (year 2262); above it,
# the number is milliseconds.
LAST_EPOCH_SECOND = 9223372036


def moment(as_of: str | dt.date | dt.datetime) -> Column:
    """``as_of`` as a timestamp literal; stands in for every wall-clock call."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def today(as_of: str | dt.date | dt.datetime) -> Column:
    return moment(as_of).cast("date")


def try_stamp(column: Column) -> Column:
    """ISO text or a date to a timestamp, NULL where it does not parse."""
    return column.try_cast("timestamp_ntz")


def lenient_stamp(column: Column) -> Column:
    """ISO text, one of the listed layouts, or epoch digits; else NULL."""
    text = F.trim(column.cast("string"))
    layouts = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in EXTRA_LAYOUTS]
    digits = F.when(
        text.rlike(r"^\d{9,10}$|^\d{13}$"), epoch_stamp(text.try_cast("bigint"))
    )
    return F.coalesce(digits, try_stamp(text), *layouts)


def blank_words_to_null(column: Column) -> Column:
    """Raw exports write a missing value as '' or 'null'."""
    return F.nullif(F.nullif(column.cast("string"), F.lit("")), F.lit("null"))


def epoch_stamp(number: Column) -> Column:
    """Epoch seconds or milliseconds, told apart by size, as UTC wall clock."""
    seconds = F.when(
        F.abs(number) <= LAST_EPOCH_SECOND, number.cast("decimal(20,3)")
    ).otherwise((number.cast("decimal(20,0)") / 1000).cast("decimal(20,3)"))
    micros = (seconds * 1000000).cast("bigint")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, start)


def iso_millis(stamp: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, cut (not rounded) to milliseconds."""
    text = stamp.cast("timestamp_ntz").cast("string")
    dotted = F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".")))
    return F.substring(F.rpad(dotted, 26, "0"), 1, 23)


def iso_day(column: Column) -> Column:
    return column.try_cast("date").cast("string")


def month_start(column: Column) -> Column:
    return F.trunc(column.cast("date"), "MM")


def month_end(column: Column) -> Column:
    return F.last_day(column.cast("date"))


def iso_weekday(column: Column) -> Column:
    """Monday is 1."""
    return F.weekday(column.cast("date")) + 1


def cut_to_millis(column: Column) -> Column:
    """Drop digits below the millisecond, whatever the session time zone."""
    return iso_millis(column).cast("timestamp_ntz")
