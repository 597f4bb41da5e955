"""Typed record maps: raw string records -> declared columns.

Driven by the target schema: strings pass through (absent or null -> NULL),
timestamps use the source format (strict: malformed text fails the job, as the
source getters do), doubles / decimals / integers use the safe parsers (bad text
-> NULL).  Everything is a column expression; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civic_mart import schemas
from civic_mart.functions import casts


def _typed(c: Column, dt: T.DataType, ts_kind: str) -> Column:
    if isinstance(dt, T.TimestampNTZType) or isinstance(dt, T.TimestampType):
        return casts.ts_iso(c) if ts_kind == "iso" else casts.ts_us_ampm(c)
    if isinstance(dt, T.DoubleType):
        return casts.safe_double(c)
    if isinstance(dt, T.DecimalType):
        return casts.safe_decimal(c, dt.precision, dt.scale)
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return casts.safe_long(c).cast(dt)
    return c.cast("string")


def typed_map(raw: DataFrame, ddl: str, renames: dict[str, str] | None = None, ts_kind: str = "iso",
              keep: list[str] | None = None) -> DataFrame:
    """Project raw (all-string) records onto the declared schema; missing raw fields -> NULL.
    ``keep`` columns pass through in front (e.g. page coordinates)."""
    renames = renames or {}
    have = set(raw.columns)
    cols = [F.col(k) for k in keep or []]
    for f in schemas.struct(ddl).fields:
        src = renames.get(f.name, f.name)
        c = F.col(f"`{src}`") if src in have else F.lit(None).cast("string")
        cols.append(_typed(c, f.dataType, ts_kind).alias(f.name))
    return raw.select(*cols)


def map_311(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """311 API records (33 columns, two renamed computed-region fields)."""
    return typed_map(raw, schemas.NYC_311_SERVICE_REQUEST, schemas.NYC_311_RENAMES, "iso", keep)


def map_inspection(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Restaurant inspection API records (26 columns)."""
    return typed_map(raw, schemas.NYC_RESTAURANT_INSPECTION, None, "iso", keep)


def map_application(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Open-restaurant application CSV rows (35 columns, US AM/PM timestamps)."""
    return typed_map(raw, schemas.NYC_OPEN_RESTAURANT_APPLICATIONS, None, "us", keep)
