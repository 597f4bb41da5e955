"""High-watermark ledger and load windows.

The ledger is an append-only table ``(job_name, latest_record_date,
execution_date)``.  A job reads its watermark as a scalar subquery (planned once,
no driver round trip), processes the rows past it, writes its data, and only then
appends its ledger row, so a failed run is simply re-run from the old watermark.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: ledger defaults, zones and snapshot horizons of the source jobs
EMPTY_WATERMARK = "1900-01-01 00:00:00"
SOURCE_ZONE = "America/New_York"
EXTRACT_SNAPSHOT_START = "2016-01-01 00:00:00"
MODES = ("snapshot", "increment")

LEDGER_SCHEMA = "job_name string, latest_record_date timestamp_ntz, execution_date timestamp_ntz"


def watermark(ledger: DataFrame, job_name: str, default: str = EMPTY_WATERMARK) -> Column:
    """``IFNULL(MAX(latest_record_date), default)`` for one job, as a scalar subquery."""
    return (ledger.where(F.col("job_name") == F.lit(job_name))
            .agg(F.coalesce(F.max("latest_record_date"), F.lit(default).cast("timestamp_ntz")))
            .scalar())


def watermarks(ledger: DataFrame, job_names: list[str], default: str = EMPTY_WATERMARK) -> DataFrame:
    """Watermark of every listed job (jobs absent from the ledger get the default)."""
    spark = ledger.sparkSession
    jobs = spark.createDataFrame([(j,) for j in job_names], "job_name string")
    per_job = ledger.groupBy("job_name").agg(F.max("latest_record_date").alias("_m"))
    # no hint: the planner sizes the per-job maxima (jobs absent from the ledger stay, with the default)
    return (jobs.join(per_job, "job_name", "left")
            .select("job_name", F.coalesce(F.col("_m"), F.lit(default).cast("timestamp_ntz")).alias("latest_record_date")))


def ledger_row(spark: SparkSession, job_name: str, latest: Column, execution: Column) -> DataFrame:
    """One ledger row; ``latest`` must not be NULL (REQUIRED column)."""
    row = spark.range(1).select(F.lit(job_name).alias("job_name"),
                                latest.cast("timestamp_ntz").alias("latest_record_date"),
                                execution.cast("timestamp_ntz").alias("execution_date"))
    return row.where(F.when(F.col("latest_record_date").isNotNull(), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"ledger {job_name}: latest_record_date is NULL (empty source)"))))


def source_max(source: DataFrame, col: str) -> Column:
    """``(SELECT MAX(col) FROM source)``: NULL on an empty source."""
    return source.agg(F.max(col)).scalar()


def local_now(run_utc: str | Column, zone: str = SOURCE_ZONE) -> Column:
    """``CURRENT_DATETIME(zone)`` for a given run instant (UTC, zone-less)."""
    c = run_utc if isinstance(run_utc, Column) else F.lit(run_utc).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def local_today(run_utc: datetime, zone: str = SOURCE_ZONE) -> date:
    return run_utc.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone)).date()


def extract_window(mode: str, run_utc: datetime, lag_days: int = 0,
                   snapshot_start: str = EXTRACT_SNAPSHOT_START) -> tuple[str, str]:
    """Half-open extract window in local dates.

    ``increment`` covers the one local day ending ``lag_days`` before today
    (311: [T-1, T); inspections use ``lag_days=1``: [T-2, T-1)); ``snapshot``
    starts at the horizon.  Other modes are rejected.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    end = local_today(run_utc) - timedelta(days=lag_days)
    start = snapshot_start if mode == "snapshot" else f"{end - timedelta(days=1)} 00:00:00"
    return start, f"{end} 00:00:00"


def write_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return "overwrite" if mode == "snapshot" else "append"
