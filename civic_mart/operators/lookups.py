"""Lookups against dimension / category tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: category of a location type that is absent from the lookup
UNSPECIFIED = "Unspecified"


def lookup_with_default(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, value: str,
                        out: str, default: str = UNSPECIFIED) -> DataFrame:
    """Exact (case-sensitive) match of ``df[key]`` in ``lookup``; the smallest value of a
    repeated key wins; no match or NULL key -> ``default``.  The planner sizes the lookup
    and chooses the join."""
    one = lookup.groupBy(F.col(lookup_key).alias("_lk")).agg(F.min(value).alias("_lv"))
    return (df.join(one, F.col(key) == F.col("_lk"), "left")
            .withColumn(out, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv"))
