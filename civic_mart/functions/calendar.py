"""Calendar expressions (date dimension, fact date/hour keys).

All take and return ``Column``s and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(c: Column) -> Column:
    """``FORMAT_DATE('%Y-%m-%d', d)``."""
    return F.date_format(c, "yyyy-MM-dd")


def month_name(c: Column) -> Column:
    """``FORMAT_DATE('%B', d)``: full English month name."""
    return F.date_format(c, "MMMM")


def day_name(c: Column) -> Column:
    """``FORMAT_DATE('%A', d)``: full English weekday name."""
    return F.date_format(c, "EEEE")


def sunday_week(c: Column) -> Column:
    """``EXTRACT(WEEK FROM d)``: weeks start on Sunday, days before the first
    Sunday of the year are week 0 (range 0..53). ISO ``weekofyear`` differs."""
    return F.floor((F.dayofyear(c) + F.lit(7) - F.dayofweek(c)) / F.lit(7)).cast("bigint")


def is_weekend(c: Column) -> Column:
    """1 when ``EXTRACT(DAYOFWEEK)`` (1 = Sunday) is 1 or 7, else 0."""
    return F.when(F.dayofweek(c).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def parse_day_month_year(day: Column, month: Column, year: Column) -> Column:
    """``PARSE_DATE('%d %B %Y', CONCAT(day, ' ', month, ' ', year))``."""
    return F.to_date(F.concat_ws(" ", day.cast("string"), month, year.cast("string")), "d MMMM yyyy")


def hour_diff(start: Column, end: Column) -> Column:
    """``TIMESTAMP_DIFF(end, start, HOUR)``: whole hours, truncated toward zero."""
    return F.timestamp_diff("HOUR", start, end)
