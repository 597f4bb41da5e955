"""Typed getters for raw string records (JSON pages, CSV cells).

Safe variants return NULL on bad input; strict variants raise (ANSI mode),
matching which getters of the source system fail the job and which do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: source timestamp formats
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
US_AMPM_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _digits_underscores(c: Column) -> Column:
    # float('1_000') and int('1_000') accept one underscore between digits
    return F.regexp_replace(c.cast("string"), r"(?<=[0-9])_(?=[0-9])", "")


def safe_double(c: Column) -> Column:
    """float() that yields NULL when the text does not parse."""
    return _digits_underscores(c).try_cast("double")


def safe_long(c: Column) -> Column:
    """int() that yields NULL on bad text; ``'12.0'`` is bad, ``' 7 '`` is 7."""
    return _digits_underscores(c).try_cast("bigint")


def safe_decimal(c: Column, precision: int = 38, scale: int = 9) -> Column:
    """NUMERIC column fed through a float parse first (string -> double -> decimal)."""
    return safe_double(c).try_cast(f"decimal({precision},{scale})")


def strict_double(c: Column) -> Column:
    """float() that raises on bad text (ANSI cast)."""
    return c.cast("double")


def ts_iso(c: Column) -> Column:
    """strptime('%Y-%m-%dT%H:%M:%S.%f'); malformed text raises under ANSI."""
    return F.to_timestamp_ntz(c, F.lit(ISO_FORMAT))


def try_ts_iso(c: Column) -> Column:
    """Like :func:`ts_iso` but NULL on malformed text (for quarantine splits)."""
    return F.try_to_timestamp(c, F.lit(ISO_FORMAT)).cast("timestamp_ntz")


def ts_us_ampm(c: Column) -> Column:
    """``%m/%d/%Y %I:%M:%S %p`` timestamps of the applications CSV; NULL stays NULL."""
    return F.to_timestamp_ntz(c, F.lit(US_AMPM_FORMAT))
