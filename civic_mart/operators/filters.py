"""Row filters: time windows, NOT NULL conjunctions, case-insensitive matches.

All are plain predicates, so Catalyst pushes the comparable parts to the
Parquet scan (``PushedFilters``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def half_open_window(col: str, start, end) -> Column:
    """``start <= col < end`` (extract windows)."""
    c = F.col(col)
    return (c >= _ts(start)) & (c < _ts(end))


def open_window(col: str, start, end) -> Column:
    """``start < col < end`` (geocode source query: both bounds exclusive)."""
    c = F.col(col)
    return (c > _ts(start)) & (c < _ts(end))


def all_not_null(cols: list[str]) -> Column:
    """Conjunction of IS NOT NULL; unlike ``dropna`` a NaN double is kept."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def caseless_eq(col: str, value) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return F.lower(F.col(col)) == F.lower(v)


def caseless_one_of(col: str, values: list[str]) -> Column:
    return F.lower(F.col(col)).isin([v.lower() for v in values])


def any_yes(*cols: str) -> Column:
    """``a = 'yes' OR b = 'yes'`` with SQL three-valued logic (NULL -> not kept)."""
    return reduce(lambda a, b: a | b, [F.col(c) == F.lit("yes") for c in cols])


def geolocated(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
