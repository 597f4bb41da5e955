"""Extract-side queries over the driver tables (311 and inspection feeds)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart import schemas
from civic_mart.operators import filters, ledger, records
from civic_mart.operators.lookups import lookup_with_default
from civic_mart.operators.quality import tag_required
from civic_mart.plans.pipeline import (FOCUS_COMPLAINT_TYPES, FOCUS_VIOLATIONS_V2, LOCATION_CATEGORIES,
                                       REQUEST_REQUIRED, SNAPSHOT_START, Mart)
from civic_mart.sources import paging

EXTRACT_START = ledger.EXTRACT_SNAPSHOT_START
# a run instant inside the driver data, for the window-per-mode query
WINDOW_RUN_UTC = "2024-01-20 03:30:00"

EXTRACT_COLS = ["unique_key", "created_date", "closed_date", "complaint_type", "descriptor", "location_type",
                "incident_zip", "borough", "latitude", "longitude"]


def focus_types(spark: SparkSession) -> DataFrame:
    """Distinct focus complaint types, exact case (two differ only in case)."""
    return spark.createDataFrame([(t,) for t in FOCUS_COMPLAINT_TYPES], "focus_type string").distinct()


def extract_requests(mart: Mart, start: str = EXTRACT_START, end: str | None = None,
                     extra: list[str] | None = None) -> DataFrame:
    """FLT1-FLT3/PRJ5/A8/PRJ8: rows of each focus type in [start, end), geolocated, keyed;
    a row matching two focus types (same text, other case) is extracted twice."""
    end = end or mart.request_end
    req = mart.m.requests().where(filters.half_open_window("created_date", start, end)
                                  & filters.all_not_null(["latitude", "longitude", "unique_key"]))
    focus = focus_types(mart.spark)
    j = req.join(focus, F.lower(req["complaint_type"]) == F.lower(focus["focus_type"]))
    return j.select("focus_type", *EXTRACT_COLS, *(extra or []))


def extract_inspections(mart: Mart, start: str = SNAPSHOT_START, end: str | None = None) -> DataFrame:
    """FLT4/J9: inspections whose violation code is one of the focus codes, any case."""
    end = end or mart.request_end
    codes = [c for c, _ in FOCUS_VIOLATIONS_V2]
    ins = mart.m.inspections().where(filters.half_open_window("inspection_date", start, end)
                                     & filters.all_not_null(["latitude", "longitude", "camis"])
                                     & filters.caseless_one_of("violation_code", codes))
    return ins.select("camis", "inspection_date", "violation_code", "cuisine_description", "rec_order", "rec_line")


def request_counts(mart: Mart, start: str = EXTRACT_START, end: str | None = None) -> DataFrame:
    """A1: per focus type, the number of matching rows (0 when none)."""
    end = end or mart.request_end
    req = mart.m.requests().where(filters.half_open_window("created_date", start, end)
                                  & filters.all_not_null(["latitude", "longitude", "unique_key"]))
    per = req.groupBy(F.lower("complaint_type").alias("_lt")).agg(F.count(F.lit(1)).alias("n"))
    focus = focus_types(mart.spark)
    return (focus.join(per, F.lower(focus["focus_type"]) == per["_lt"], "left")
            .select("focus_type", F.coalesce("n", F.lit(0)).alias("n")))


def page_plan_query(mart: Mart) -> DataFrame:
    """SRC4/F24/SRC7: one row per page of the extract."""
    return paging.page_plan(request_counts(mart), "focus_type", "n")


def raw_request_records(mart: Mart) -> DataFrame:
    """The extract as the API would return it: every field a string, source names."""
    ts_txt = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return extract_requests(mart, extra=["value"]).select(
        F.col("focus_type").alias("key"), "unique_key", ts_txt(F.col("created_date")).alias("created_date"),
        ts_txt(F.col("closed_date")).alias("closed_date"), "complaint_type", "descriptor", "location_type",
        "incident_zip", "borough",
        F.when(F.col("unique_key").cast("bigint") % 10 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
        .alias("x_coordinate_state_plane"),
        F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"),
        F.col("incident_zip").alias(":@computed_region_efsh_h5xi"))


PAGE_READ_COLS = ["unique_key", "created_date", "closed_date", "complaint_type", "descriptor",
                  "x_coordinate_state_plane", "latitude", "longitude", "compute_zip"]


def page_read_query(mart: Mart) -> DataFrame:
    """SRC5/O2/SRC6/F16/F17/F19/PRJ1: read every planned page, check it against the plan,
    decode and type its records."""
    plan = paging.page_plan(request_counts(mart), "focus_type", "n")
    raw = paging.with_pages(raw_request_records(mart), ["key"], ["unique_key"])
    pages = paging.page_bodies(raw, ["key", "page"], "unique_key")
    schema = schemas.all_strings(schemas.NYC_311_SERVICE_REQUEST, schemas.NYC_311_RENAMES)
    recs = paging.page_records(paging.checked_pages(plan, pages), schema)
    typed = records.map_311(recs, keep=["key", "page"])
    return typed.select("key", "page", *PAGE_READ_COLS)


def paged_source_query(mart: Mart) -> DataFrame:
    """SRC5: page files that landed are read through the partitioned data source, some first and,
    as after a job that died, the rest without those; then decoded and typed as in ``page_read``."""
    from civic_mart.sources import paged_source, sinks

    plan = sinks.materialize(paging.page_plan(request_counts(mart), "focus_type", "n"), "page-plan")
    raw = paging.with_pages(raw_request_records(mart), ["key"], ["unique_key"])
    root, done = (sinks.scratch_path(mart.spark, n) for n in ("landed-pages", "read-pages"))
    paged_source.land_pages(paging.page_bodies(raw, ["key", "page"], "unique_key"), root)
    fetch = paged_source.landed_fetcher(root)
    for part in (plan.where("page < 3"), plan):  # the second run goes on where the first ended
        have = None if part is not plan else mart.spark.read.parquet(done)
        paged_source.read_pages(part, fetch, have).write.mode("append").parquet(done)
    schema = schemas.all_strings(schemas.NYC_311_SERVICE_REQUEST, schemas.NYC_311_RENAMES)
    recs = paging.page_records(paging.checked_pages(plan, mart.spark.read.parquet(done)), schema)
    return records.map_311(recs, keep=["key", "page"]).select("key", "page", *PAGE_READ_COLS)


def keyset_pages_query(mart: Mart) -> DataFrame:
    """SRC4/O2 by key ranges: the pages of each complaint type's requests over their numeric key."""
    req = mart.m.requests().select("complaint_type", F.col("unique_key").cast("bigint").alias("k"))
    return paging.keyset_plan(req, "complaint_type", "k")


def required_gate_query(mart: Mart) -> DataFrame:
    """K8/FLT5: every request tagged valid / rejected with its missing REQUIRED columns."""
    return tag_required(mart.m.requests(), REQUEST_REQUIRED).select("unique_key", "gate", "missing")


def location_category_query(mart: Mart) -> DataFrame:
    """Location type -> category, 'Unspecified' when absent (exact case)."""
    df = mart.m.requests().select("unique_key", "location_type")
    return lookup_with_default(df, "location_type", mart.location_categories(), "location_type", "category",
                               "locationType")


def window_counts_query(mart: Mart) -> DataFrame:
    """Extract windows of both jobs in both modes for one run instant, with row counts
    (one pass over each source)."""
    run = datetime.fromisoformat(WINDOW_RUN_UTC)
    parts = []
    for job, lag, src, col in (("extract_311", 0, mart.m.table("events"), "ts"),
                               ("extract_inspection", 1, mart.m.table("lineitem"), "l_shipdate")):
        windows = {mode: ledger.extract_window(mode, run, lag_days=lag) for mode in ledger.MODES}
        rows = F.array(*[F.struct(
            F.lit(job).alias("job"), F.lit(mode).alias("mode"), F.lit(start).cast("timestamp_ntz").alias("window_start"),
            F.lit(end).cast("timestamp_ntz").alias("window_end"), F.col(f"n_{mode}").alias("n_rows"),
            F.lit(ledger.write_mode(mode)).alias("write_mode")) for mode, (start, end) in windows.items()])
        counts = src.agg(*[F.count_if(filters.half_open_window(col, *w)).alias(f"n_{mode}") for mode, w in windows.items()])
        parts.append(counts.select(F.explode(rows).alias("w")).select("w.*"))
    return parts[0].unionByName(parts[1]).withColumn("run_local", ledger.local_now(WINDOW_RUN_UTC))
