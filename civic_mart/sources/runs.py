"""Repeatable job commits: data by run, and a ledger that names the runs.

A job writes what a run stages to ``<root>/<table>/run=<id>``, overwriting only that
folder, and then one ledger row that names the run.  Readers take only the runs that the
ledger names, from the last snapshot on.  A run that dies between its writes leaves a folder
that nobody reads; run again under the same id it overwrites the folder and commits once.  A
run that is already committed is left alone.

The ledger row of a run lies in a folder of its own as well, so committing twice writes the
same row to the same place.  The ledger has one row for each job and run: it is small.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart import schemas
from civic_mart.operators import ledger as L

LEDGER_SCHEMA = f"{L.LEDGER_SCHEMA}, run_id string, run_mode string, window_end timestamp_ntz"
_ID = re.compile(r"[A-Za-z0-9_-]+")


def _folder(root: str, table: str, run_id: str) -> str:
    if not _ID.fullmatch(run_id):
        raise ValueError(f"run id {run_id!r} must be letters, digits, - and _")
    return f"{root}/{table}/run={run_id}"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All committed rows (empty before the first run)."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def committed(spark: SparkSession, root: str, job: str, run_id: str) -> bool:
    return bool(read_ledger(spark, root).where((F.col("job_name") == job) & (F.col("run_id") == run_id)).limit(1).count())


def watermark(spark: SparkSession, root: str, job: str, execution: str):
    """Latest record date that runs executed before ``execution`` have processed, as a literal."""
    row = read_ledger(spark, root).where((F.col("job_name") == job) & (
        F.col("execution_date") < F.lit(execution).cast("timestamp_ntz"))).agg(F.max("latest_record_date")).first()
    return F.lit(row[0].isoformat(sep=" ") if row[0] else L.EMPTY_WATERMARK).cast("timestamp_ntz")


def write_run(df: DataFrame, root: str, table: str, run_id: str, ddl: str | None = None,
              sort_by: list[str] | None = None) -> DataFrame:
    """Store a run's rows and read them back.  With ``sort_by`` the rows are range-partitioned on
    it and sorted, so that files and row groups hold narrow ranges that filters can skip."""
    from civic_mart.sources.sinks import write_table
    path = _folder(root, table, run_id)
    write_table(df.repartitionByRange(*sort_by) if sort_by else df, path, "overwrite", ddl, sort_by=sort_by)
    return df.sparkSession.read.parquet(path)


def commit(spark: SparkSession, root: str, job: str, run_id: str, mode: str, latest: Column, execution: Column,
           window_end: Column | None = None) -> None:
    """Append the ledger row that makes a run's tables visible."""
    end = F.lit(None) if window_end is None else window_end
    row = L.ledger_row(spark, job, latest, execution).select(
        "*", F.lit(run_id).alias("run_id"), F.lit(mode).alias("run_mode"), end.cast("timestamp_ntz").alias("window_end"))
    row.coalesce(1).write.mode("overwrite").parquet(_folder(root, f"ledger/{job}", run_id))


def runs_of(spark: SparkSession, root: str, job: str, before: str | None = None) -> list[str]:
    """Committed runs whose rows make up a job's tables: the last snapshot and what came after
    it (``before``: as they stood at that execution date)."""
    rows = read_ledger(spark, root).where(F.col("job_name") == job)
    if before:
        rows = rows.where(F.col("execution_date") < F.lit(before).cast("timestamp_ntz"))
    out: list[str] = []
    for r in rows.select("run_id", "run_mode", "execution_date").orderBy("execution_date", "run_id").collect():
        out = [r["run_id"]] if r["run_mode"] == "snapshot" else [*out, r["run_id"]]
    return out


def read_runs(spark: SparkSession, root: str, table: str, job: str, ddl: str, before: str | None = None,
              runs: list[str] | None = None) -> DataFrame:
    """A job's table: the rows of its committed runs only."""
    runs = runs_of(spark, root, job, before) if runs is None else runs
    reader = spark.read.schema(schemas.struct(ddl))
    return reader.parquet(*[_folder(root, table, r) for r in runs]) if runs else spark.createDataFrame([], schemas.struct(ddl))
