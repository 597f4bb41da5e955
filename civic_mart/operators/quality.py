"""REQUIRED-column gate.

Spark does not enforce ``nullable=False`` on files, so the mode of a declared
column is checked as data: rows are split into valid and rejected (with the
list of missing columns), or the write fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_mart.operators.filters import all_not_null


def missing_columns(required: list[str]):
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def split_required(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    ok = all_not_null(required)
    valid = df.where(ok)
    rejected = df.where(~ok).withColumn("missing", missing_columns(required))
    return valid, rejected


def tag_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Both sides in one pass: ``gate`` = 'valid' | 'rejected', ``missing`` columns list."""
    ok = all_not_null(required)
    return df.withColumn("gate", F.when(ok, F.lit("valid")).otherwise(F.lit("rejected"))).withColumn(
        "missing", F.when(ok, F.lit(None).cast("string")).otherwise(missing_columns(required)))


def assert_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail the job (at execution) on the first row that breaks a REQUIRED column."""
    cond = all_not_null(required)
    # a filter predicate is always evaluated (an unused check column would be pruned)
    return df.where(F.when(cond, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("REQUIRED column is NULL: "), missing_columns(required)))))
