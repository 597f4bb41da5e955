"""Stored jobs: read the ledger, stage, write the run's folders, then commit its ledger row.

A job's tables live under one root folder, by run (sources/runs.py).  A run that fails is
simply run again under its id: only its own folders are overwritten, and nothing of it is read
before its ledger row is there.

Two variants.  ``literal`` keeps the watermark of the source jobs: the newest date of the whole
source, read after staging, with an exclusive lower bound.  It loses rows that arrive late, that
carry the watermark itself, or that lie between a run's upper bound and the newest date.
``safe`` records the newest date that the run has processed, looks back ``LOOK_BACK_DAYS``
behind it and leaves out the records that earlier runs have staged.  It reads each source once.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart import schemas
from civic_mart.operators import dims, ledger
from civic_mart.operators.quality import tag_required
from civic_mart.plans.pipeline import (JOB_311, JOB_DIM_LOC_311, JOB_DIM_LOC_INS, JOB_DIM_VIO, JOB_INS, REQUEST_REQUIRED,
                                       SNAPSHOT_START, Mart)
from civic_mart.sources import runs, sinks
from civic_mart.sources.runs import read_ledger

# instants of the two runs of the registered query: one inside the request data, one after all data
FIRST_RUN_UTC, SECOND_RUN_UTC = "2024-01-15 12:00:00", "2024-02-01 12:00:00"
LOOK_BACK_DAYS = 3
VARIANTS = ("literal", "safe")

REJECTED = "unique_key string, created_date timestamp_ntz, missing string"
# keys and dates of the records that a run has processed, for the look-back of later runs
SEEN = {"requests": ("unique_key string, created_date timestamp_ntz", ["unique_key"], "created_date"),
        "inspections": ("rec_order bigint, rec_line int, inspection_date timestamp_ntz", ["rec_order", "rec_line"], "inspection_date")}
TABLES = {"requests": (JOB_311, schemas.STAGE_311_LOCATION), "inspections": (JOB_INS, schemas.STAGE_INSPECTION_LOCATION),
          "applications": (JOB_INS, schemas.STAGE_OPEN_RESTAURANT_LOCATION),
          "rejected_requests": (JOB_311, REJECTED), "dim_location": (JOB_DIM_LOC_INS, schemas.DIM_LOCATION)}


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table: the rows of its committed runs."""
    job, ddl = TABLES[table]
    rows = runs.read_runs(spark, root, table, job, ddl)
    if table == "applications":  # whole in each run: the last one counts
        last = runs.runs_of(spark, root, job)[-1:]
        rows = runs.read_runs(spark, root, table, job, ddl, runs=last)
    return rows


def run_id_of(mart: Mart, mode: str) -> str:
    return f"{mode}-{datetime.fromisoformat(mart.run_utc):%Y%m%dT%H%M%S}"


def _local(mart: Mart) -> str:
    return mart.spark.range(1).select(mart.run_time().cast("string")).first()[0]


def _stage(mart: Mart, root: str, mode: str, variant: str, table: str, source: DataFrame, date: str, end: str,
           stage: Callable[[DataFrame], DataFrame], required: list[str] | None,
           ready: Callable[[], object] = lambda: None) -> None:
    """One staging table of a run, committed with its watermark once ``ready`` returns."""
    spark, run_id, now = mart.spark, run_id_of(mart, mode), _local(mart)
    job, ddl = TABLES[table]
    if runs.committed(spark, root, job, run_id):
        return
    snapshot = mode == "snapshot"
    mark = F.lit(SNAPSHOT_START).cast("timestamp_ntz") if snapshot else runs.watermark(spark, root, job, now)
    seen_ddl, keys, _ = SEEN[table]
    low = mark - F.expr(f"INTERVAL {LOOK_BACK_DAYS} DAYS") if variant == "safe" and not snapshot else mark
    below = F.col(date) < F.lit(end).cast("timestamp_ntz")
    inside = (F.col(date) > low) & below
    if required:  # rows without a date fall in no window: each run has them, minus those rejected before
        inside = inside | F.col(date).isNull()
    rows = tag_required(source, required) if required else source
    rows = rows.where(inside)
    if not snapshot:
        old = [runs.read_runs(spark, root, "rejected_requests", job, REJECTED, now).select("unique_key")] if required else []
        if variant == "safe":
            seen = runs.read_runs(spark, root, f"seen_{table}", job, seen_ddl, now).where(F.col(date) > low).select(*keys)
            rows = _without(rows, seen, keys)
        if old:
            gone = rows.where("gate = 'rejected'")
            rows = rows.where("gate = 'valid'").unionByName(_without(gone, old[0], ["unique_key"]))
    rows = sinks.materialize(rows, f"window-{table}")  # the one scan of the source
    valid = rows
    if required:
        valid = rows.where("gate = 'valid'").drop("gate", "missing")
        runs.write_run(rows.where("gate = 'rejected'"), root, "rejected_requests", run_id, REJECTED)
    # sorted by date: the next run's look-back and the dimension load read few files
    staged = sinks.materialize(stage(valid), f"staged-{table}")  # sorting samples its input first: not the geocode again
    runs.write_run(staged, root, table, run_id, ddl, sort_by=[date])
    sinks.discard(staged)
    if variant == "safe":
        runs.write_run(valid, root, f"seen_{table}", run_id, seen_ddl, sort_by=[date])
        latest = F.greatest(mark, ledger.source_max(valid, date))  # what is processed; no rows: as before
    else:
        whole = source.where(F.forall(F.array(*[F.col(c).isNotNull() for c in required]), lambda x: x)) if required else source
        latest = ledger.source_max(whole, date)
    ready()
    runs.commit(spark, root, job, run_id, mode, latest, mart.run_time(), F.lit(end))


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among ``gone`` (null keys count as equal)."""
    g = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_gone_{k}"))
    return rows.join(g, cond, "left_anti")


def run_geocode(mart: Mart, root: str, mode: str, variant: str = "literal",
                fail_after: str | None = None) -> None:
    """Stage requests, inspections and applications of a run into ``root``: a snapshot starts
    anew, an increment adds what lies past the job's watermark.  Requests that lack a REQUIRED
    column go to ``rejected_requests`` with what they lack.  ``fail_after`` names a table after
    whose writes the run dies before it commits (to try recovery)."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    ledger.write_mode(mode)  # rejects other modes

    def stage(table: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        def run(valid: DataFrame) -> DataFrame:
            out = build(valid)
            if fail_after == table:
                runs.write_run(out, root, table, run_id_of(mart, mode), TABLES[table][1])
                raise RuntimeError(f"run died after writing {table}")
            return out
        return run

    _stage(mart, root, mode, variant, "requests", mart.m.requests(), "created_date", mart.request_end,
           stage("requests", lambda v: mart.stage_requests(src=v)), REQUEST_REQUIRED)
    if runs.committed(mart.spark, root, JOB_INS, run_id_of(mart, mode)):
        return
    with ThreadPoolExecutor(1) as pool:  # the applications (no dates: always whole) are written beside the inspections, committed with them
        whole = pool.submit(lambda: runs.write_run(mart.stage_applications(), root, "applications", run_id_of(mart, mode),
                                                   schemas.STAGE_OPEN_RESTAURANT_LOCATION))
        _stage(mart, root, mode, variant, "inspections", mart.m.inspections(), "inspection_date", mart.inspection_end,
               stage("inspections", lambda v: mart.stage_inspections(src=v)), None, ready=whole.result)


def run_dim_location(mart: Mart, root: str, mode: str) -> None:
    """DimLocation from the stored staging tables: a snapshot refreshes it, an increment adds the
    places of staging runs that the load has not seen.  Its ledger rows carry the staging jobs'
    watermarks; the second one commits the run."""
    spark, run_id, now = mart.spark, run_id_of(mart, mode), _local(mart)
    ledger.write_mode(mode)
    if runs.committed(spark, root, JOB_DIM_LOC_INS, run_id):
        return
    staged = [read_staged(spark, root, t) for t in ("requests", "inspections", "applications")]
    if mode == "snapshot":
        new = dims.dim_location_refresh(staged, mart.m.population_blocks())
    else:
        def fresh(table: str, load: str) -> DataFrame:
            job, ddl = TABLES[table]
            before = read_ledger(spark, root).where((F.col("job_name") == load) & (
                F.col("execution_date") < F.lit(now).cast("timestamp_ntz"))).agg(F.max("execution_date")).first()[0]
            known = set(runs.runs_of(spark, root, job, f"{before}")) if before else set()
            since = read_ledger(spark, root).where((F.col("job_name") == job) & (F.col("execution_date") == F.lit(
                str(before)).cast("timestamp_ntz"))).select("run_id").collect() if before else []
            known |= {r["run_id"] for r in since}  # staged and loaded by the same run
            return runs.read_runs(spark, root, table, job, ddl, runs=[r for r in runs.runs_of(spark, root, job) if r not in known])

        prior = runs.read_runs(spark, root, "dim_location", JOB_DIM_LOC_INS, schemas.DIM_LOCATION, now)
        new = dims.dim_location_increment([fresh("requests", JOB_DIM_LOC_311), fresh("inspections", JOB_DIM_LOC_INS), staged[2]],
                                          mart.m.population_blocks(), prior)
    runs.write_run(new, root, "dim_location", run_id, schemas.DIM_LOCATION)
    for job, of in ((JOB_DIM_LOC_311, JOB_311), (JOB_DIM_LOC_INS, JOB_INS)):
        latest = read_ledger(spark, root).where(F.col("job_name") == of).agg(F.max("latest_record_date")).first()[0]
        runs.commit(spark, root, job, run_id, mode, F.lit(str(latest)), mart.run_time())


def run_violations(mart: Mart, root: str, mode: str, version: int, side: str, latest, now, fail: bool = False) -> None:
    """DimRestaurantViolation as a stored load: expire changed versions and add new ones past the
    load's watermark, as the next version of the dimension, then commit the ledger row.  ``fail``:
    the run dies between the two."""
    spark, run_id = mart.spark, run_id_of(mart, mode)
    if runs.committed(spark, root, JOB_DIM_VIO, run_id):
        return
    mark = runs.watermark(spark, root, JOB_DIM_VIO, "9999-12-31 00:00:00")
    rows = dims.pairs_as_rows(mart.violation_pairs, side)
    if side == "before":
        rows = rows.where(F.col("inspection_date") <= latest)

    def build(current: DataFrame | None) -> DataFrame:
        dim = current if current is not None else spark.createDataFrame([], schemas.struct(schemas.DIM_RESTAURANT_VIOLATION))
        return dims.scd2_apply(rows, mart.focus_violations(version), dim, mark, now)

    sinks.update_versioned(spark, f"{root}/dim_violation", build, schemas.DIM_RESTAURANT_VIOLATION, tag=run_id)
    if fail:
        raise RuntimeError("run died after writing dim_violation")
    runs.commit(spark, root, JOB_DIM_VIO, run_id, mode, latest, now)


def scd2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(table_name, id, cuisine, code, category, first, last, is_current)``: the violation dimension
    and its ledger after two stored loads, read back.  Categories change between the loads; the
    second one dies before it commits and is run again."""
    root = sinks.scratch_path(spark, "violation-job")
    mart = Mart(spark, sf_dir, run_utc=SECOND_RUN_UTC)
    mid = mart.watermark(JOB_DIM_VIO)  # the first load saw inspections up to here
    run_violations(mart, root, "snapshot", 1, "before", mid, mid)
    newest = ledger.source_max(mart.m.inspections(), "inspection_date")
    try:
        run_violations(mart, root, "increment", 2, "after", newest, mart.run_time(), fail=True)
    except RuntimeError as e:
        if "run died" not in str(e):
            raise
    run_violations(mart, root, "increment", 2, "after", newest, mart.run_time())
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    dim = sinks.read_versioned(spark, f"{root}/dim_violation").select(
        F.lit("dim_violation").alias("table_name"), F.col("RestaurantViolationID").alias("id"), F.col("Cuisine").alias("cuisine"),
        F.col("ViolationCode").alias("code"), F.col("Category").alias("category"), at("StartDate").alias("first"),
        at("EndDate").alias("last"), F.col("IsCurrent").alias("is_current"))
    none = F.lit(None).cast("string")
    return dim.unionAll(read_ledger(spark, root).select(F.lit("ledger"), "job_name", none, none, "run_mode", at("latest_record_date"),
                                                        at("execution_date"), F.lit(None).cast("bigint")))


def as_of(spark: SparkSession, sf_dir: str, run_utc: str) -> Mart:
    """The mart as a run at that instant finds it: sources hold what lies before its local day."""
    full = Mart(spark, sf_dir, run_utc=run_utc)
    day = F.lit(full.request_end).cast("timestamp_ntz")
    return Mart(spark, sf_dir, run_utc=run_utc, overrides={
        "events": full.m.table("events").where(F.col("ts") < day),
        "lineitem": full.m.table("lineitem").where(F.col("l_shipdate") < day)})


def contents(spark: SparkSession, root: str) -> DataFrame:
    """``(table_name, key, at)``: rows of the staging tables and the ledger."""
    parts = [read_staged(spark, root, "requests").select(F.lit("requests").alias("table_name"), F.col("unique_key").alias("key"),
                                                         F.col("created_date").alias("at")),
             read_staged(spark, root, "inspections").select(F.lit("inspections"), "camis", "inspection_date"),
             read_ledger(spark, root).select(F.lit("ledger"), "job_name", "latest_record_date")]
    return parts[0].union(parts[1]).union(parts[2])


def snapshot_then_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(table_name, key, at)`` after a snapshot and the next increment."""
    root = sinks.scratch_path(spark, "geocode-job")
    run_geocode(as_of(spark, sf_dir, FIRST_RUN_UTC), root, "snapshot")
    run_geocode(as_of(spark, sf_dir, SECOND_RUN_UTC), root, "increment")
    return contents(spark, root)


def retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs, but each dies once after it has written its requests, the second
    also after its inspections, and is run again; a run that is committed is run once more."""
    root = sinks.scratch_path(spark, "geocode-retry")
    for run_utc, mode, deaths in ((FIRST_RUN_UTC, "snapshot", ["requests"]),
                                  (SECOND_RUN_UTC, "increment", ["requests", "inspections"])):
        mart = as_of(spark, sf_dir, run_utc)
        for table in deaths:
            try:
                run_geocode(mart, root, mode, fail_after=table)
            except RuntimeError as e:
                if "run died" not in str(e):
                    raise
        run_geocode(mart, root, mode)
        run_geocode(mart, root, mode)
    return contents(spark, root)


def boundary_sources(spark: SparkSession, sf_dir: str) -> tuple[Mart, Mart]:
    """Sources of two runs between which rows arrive late.

    Of the two days before the first run, requests with ``event_id % 5 = 0`` and inspections with
    ``l_orderkey % 5 = 0`` are not there yet.  Later some requests appear that carry exactly the
    first run's upper bound, and some that carry the newest date the first run has processed."""
    first, second = (Mart(spark, sf_dir, run_utc=u) for u in (FIRST_RUN_UTC, SECOND_RUN_UTC))
    events, lines = first.m.table("events"), first.m.table("lineitem")
    bound = F.lit(first.request_end).cast("timestamp_ntz")

    def late(date: str, key: str, end: str):
        day = F.lit(end).cast("timestamp_ntz")
        return (F.col(key) % 5 == 0) & (F.col(date) >= day - F.expr("INTERVAL 2 DAYS")) & (F.col(date) < day)

    early = events.where(~late("ts", "event_id", first.request_end))
    newest = early.where((F.col("ts") < bound) & (F.col("event_id") % 53 != 0)).agg(F.max("ts")).scalar()
    more = events.where("user_id % 50 = 3")
    arrived = events.unionByName(more.withColumn("event_id", F.col("event_id") + 1_000_000_000).withColumn("ts", bound)).unionByName(
        more.withColumn("event_id", F.col("event_id") + 2_000_000_000).withColumn("ts", newest))
    return (Mart(spark, sf_dir, run_utc=FIRST_RUN_UTC, overrides={
                "events": early, "lineitem": lines.where(~late("l_shipdate", "l_orderkey", first.inspection_end))}),
            Mart(spark, sf_dir, run_utc=SECOND_RUN_UTC, overrides={"events": sinks.materialize(arrived, "arrived"), "lineitem": lines}))


def boundary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(variant, table_name, key, at)``: the staged records and the ledger of both variants after both runs.

    The variants read the same sources and layers and write under roots of their own: they run side by side."""
    marts = boundary_sources(spark, sf_dir)
    for mart in marts:
        _ = mart.layers  # both variants read them

    def both_runs(variant: str) -> str:
        root = sinks.scratch_path(spark, f"geocode-{variant}")
        for mart, mode in zip(marts, ("snapshot", "increment")):
            run_geocode(mart, root, mode, variant)
        return root

    with ThreadPoolExecutor(len(VARIANTS)) as pool:
        roots = list(pool.map(both_runs, VARIANTS))
    parts = []
    for variant, root in zip(VARIANTS, roots):
        staged = read_staged(spark, root, "requests")
        parts.append(staged.select(F.lit(variant).alias("variant"), F.lit("requests").alias("table_name"), F.col("unique_key").alias("key"),
                                   F.col("created_date").alias("at")))
        if variant == "safe":
            seen = runs.read_runs(spark, root, "seen_inspections", JOB_INS, SEEN["inspections"][0])
            parts.append(seen.select(F.lit(variant), F.lit("inspections"), F.concat_ws("-", "rec_order", "rec_line"), "inspection_date"))
        parts.append(read_ledger(spark, root).select(F.lit(variant), F.lit("ledger"), "job_name", "latest_record_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
