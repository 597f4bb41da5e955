"""Deterministic surrogate keys.

A random UUID is re-drawn whenever a task is retried or a plan is recomputed,
so the same business row would get two ids.  A hash of the business key is
stable across retries and can be recomputed by any engine with SHA-256.
Each part is length-prefixed, so NULL and '' and values containing the
separator stay distinct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def surrogate_key(*cols: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[_part(c) for c in cols]), 256)


def surrogate_key_sql(*exprs: str) -> str:
    """The same key as SQL text (DuckDB / Spark SQL) for oracles."""
    parts = [f"coalesce(CAST(length(CAST({e} AS VARCHAR)) AS VARCHAR) || ':' || CAST({e} AS VARCHAR), '-')" for e in exprs]
    return "sha256(" + " || '|' || ".join(parts) + ")"
