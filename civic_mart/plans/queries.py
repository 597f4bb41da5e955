"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator group.

Every query reads the driver tables (or tables Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.operators import dims, spatial
from civic_mart.plans import model as M
from civic_mart.plans.model import Model
from civic_mart.plans.pipeline import Mart
from civic_mart.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]


def _store(df: DataFrame) -> DataFrame:
    return sinks.materialize(df, "layer")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from civic_mart.plans.model import read_table
    return read_table(spark, sf_dir, name)


# ------------------------------------------------------------------ date dimension
def dim_date_full(spark, sf_dir):
    """W7 from an empty dimension: every request and inspection date."""
    return dims.dim_date_increment([(_t(spark, sf_dir, "events"), "ts"), (_t(spark, sf_dir, "lineitem"), "l_shipdate")])


def dim_date_incremental(spark, sf_dir):
    """W7 against an existing dimension (built from order dates): only newer dates."""
    prior = dims.date_rows(_t(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct())
    return dims.dim_date_increment([(_t(spark, sf_dir, "events"), "ts"), (_t(spark, sf_dir, "lineitem"), "l_shipdate")],
                                   dim_date=prior)


# ------------------------------------------------------------------ spatial
def point_in_polygon(spark, sf_dir):
    """SP3/SP4/O4: embedding points (elements 1, 2) -> first containing block of their borough."""
    m = Model(spark, sf_dir)
    e = _t(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "CAST(embedding[1] AS DOUBLE) AS x", "CAST(embedding[2] AS DOUBLE) AS y")
    b = m.boroughs()
    e = e.withColumn("_band", F.floor((F.col("y") + 0.5) * 5).cast("int"))
    e = e.join(b, e["_band"] == b["_rk"], "left").withColumn(
        "borough", F.expr("CASE WHEN vec_id % 29 = 0 THEN NULL WHEN vec_id % 31 = 0 THEN lower(r_name) "
                          "WHEN vec_id % 37 = 0 THEN 'Unknown' ELSE r_name END")).select("vec_id", "x", "y", "borough")
    layer = spatial.prepare_layer(m.layer("blocks"), "the_geom", "BoroName", "poly_id", ["code"], materialize=_store)
    out = spatial.first_containing(e, layer, "vec_id", "x", "y", "borough")
    return out.select("vec_id", "borough", F.col("pid").alias("block_id"), F.col("code").alias("block_code"))


def slanted_containment(spark, sf_dir):
    """SP3/SP4: points on the corners and slanted edges of diamonds, one rounding step beside
    them, and inside, against the diamonds of their borough: exact strict containment.

    Coordinates are multiples of 2^-16 (the diamonds' of 2^-14), and steps are of 2^-62 or the
    spacing of doubles at the point, so the oracle can calculate in whole numbers."""
    m = Model(spark, sf_dir)
    diamonds = spatial.spread(_t(spark, sf_dir, "customer")).selectExpr(*[f"{e} AS {c}" for c, e in M.DIAMOND.items()])
    b = m.boroughs()
    diamonds = diamonds.join(b, F.col("band") == F.col("_rk")).select("k", "cx", "cy", "a", "b", "r_name")
    corner = "concat(CAST((cx {0}) / 16384D AS STRING), ' ', CAST((cy {1}) / 16384D AS STRING))"
    corners = [corner.format(x, y) for x, y in (("+ a", "+ b"), ("- b", "+ a"), ("- a", "- b"), ("+ b", "- a"), ("+ a", "+ b"))]
    wkt = F.expr(f"concat('POLYGON ((', concat_ws(', ', {', '.join(corners)}), '))')")
    layer = spatial.prepare_layer(diamonds.select(F.col("k").alias("poly_id"), wkt.alias("the_geom"), "r_name"), "the_geom",
                                  "r_name", "poly_id", [], materialize=_store)
    pts = diamonds.select("k", "r_name", F.explode(F.expr(M.DIAMOND_POINTS["spark"])).alias("p")).select(
        "k", "r_name", "p.*").withColumn("d", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    step = "CASE WHEN abs(nx) < 128 THEN 1D ELSE power(2D, length(bin(abs(nx))) - 7) END"
    pts = pts.select("k", "corner", "quarter", "d", "r_name", F.expr(f"nx / 65536D + d * {step} / 4611686018427387904D").alias("x"),
                     F.expr("ny / 65536D").alias("y"))
    out = spatial.locate(pts, layer, "x", "y", "r_name", "")
    return out.select("k", "corner", "quarter", "d", F.col("pid").alias("poly_id"))


def geocode_requests(spark, sf_dir):
    """SP5/SP6/J13-J16/A10/J12: 311 staging rows (one per unique key), stored as the
    staging table the later jobs read."""
    return Mart(spark, sf_dir).stored_stage("requests")


def geocode_inspections(spark, sf_dir):
    """Inspection staging rows: one per camis, merged over all its inspections (stored)."""
    return Mart(spark, sf_dir).stored_stage("inspections")


def geocode_applications(spark, sf_dir):
    """Open-restaurant staging rows, geolocated applications only (stored)."""
    return Mart(spark, sf_dir).stored_stage("applications")


# ------------------------------------------------------------------ ledger / increments
def ledger_watermark(spark, sf_dir):
    """W2/A4/SRC3: watermark per job from the ledger (absent job -> 1900-01-01)."""
    from civic_mart.operators import ledger as L
    from civic_mart.plans.pipeline import LEDGER_JOBS
    return L.watermarks(Mart(spark, sf_dir).ledger(), [*LEDGER_JOBS, "Load_DimOpenRestaurant"])


def increment_requests(spark, sf_dir):
    """W1/W2/SRC2/FLT6: daily geocode increment, rows after the ledger watermark."""
    from civic_mart.plans.pipeline import JOB_311
    mart = Mart(spark, sf_dir)
    return mart.stage_requests(start=mart.watermark(JOB_311))


def increment_inspections(spark, sf_dir):
    """W1/W2/SRC2/FLT6: daily inspection increment, rows after the ledger watermark and before
    the day before the run."""
    from civic_mart.plans.pipeline import JOB_INS
    mart = Mart(spark, sf_dir)
    return mart.stage_inspections(start=mart.watermark(JOB_INS))


def job_snapshot_then_increment(spark, sf_dir):
    """The geocode job run twice over its stored ledger, a snapshot and the next
    increment; what the staging tables and the ledger hold afterwards."""
    from civic_mart.plans.jobs import snapshot_then_increment
    return snapshot_then_increment(spark, sf_dir)


def job_retry(spark, sf_dir):
    """Both runs die after their first writes and are run again: the same tables and
    ledger as clean runs."""
    from civic_mart.plans.jobs import retried
    return retried(spark, sf_dir)


def job_boundary_rows(spark, sf_dir):
    """Rows at the watermark, at a run's upper bound and late ones, in both variants: the safe
    one loses none and stages none twice."""
    from civic_mart.plans.jobs import boundary_rows
    return boundary_rows(spark, sf_dir)


def ledger_append(spark, sf_dir):
    """Ledger rows written after the geocode run (max over the whole source) and
    after the DimLocation load (the staging jobs' watermarks)."""
    from civic_mart.operators import ledger as L
    from civic_mart.plans.pipeline import JOB_311, JOB_DIM_LOC_311, JOB_DIM_LOC_INS, JOB_DIM_VIO, JOB_INS
    mart = Mart(spark, sf_dir)
    now = mart.run_time()
    geocode_rows = L.ledger_row(spark, JOB_311, L.source_max(mart.valid_requests(), "created_date"), now).unionByName(
        L.ledger_row(spark, JOB_INS, L.source_max(mart.m.inspections(), "inspection_date"), now))
    # The DimLocation load records the staging jobs' watermarks, not its own data max
    dim_rows = L.ledger_row(spark, JOB_DIM_LOC_311, mart.watermark(JOB_311), now).unionByName(
        L.ledger_row(spark, JOB_DIM_LOC_INS, mart.watermark(JOB_INS), now))
    # the violation load records the newest inspection it read
    vio_row = L.ledger_row(spark, JOB_DIM_VIO, L.source_max(mart.m.inspections(), "inspection_date"), now)
    return geocode_rows.unionByName(dim_rows).unionByName(vio_row)


# ------------------------------------------------------------------ dimensions / fact
def dim_open_type(spark, sf_dir):
    """W6/U3/FLT7/F2: open-restaurant type dimension (full refresh, stored)."""
    return Mart(spark, sf_dir).stored("dim_open")


def dim_location_refresh(spark, sf_dir):
    """W6/U2/FLT2/J1/A7/F3/PRJ7: DimLocation full refresh from the three staging tables (stored)."""
    return Mart(spark, sf_dir).stored("dim_location")


def dim_location_incremental(spark, sf_dir):
    """Insert-only DimLocation increment past the ledger watermarks."""
    return Mart(spark, sf_dir).dim_location_increment()


def _text_validity(df: DataFrame) -> DataFrame:
    # validity bounds as text: 9999-12-31 does not fit a nanosecond pandas timestamp
    return df.withColumn("StartDate", F.date_format("StartDate", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "EndDate", F.date_format("EndDate", "yyyy-MM-dd HH:mm:ss"))


def scd2_expire(spark, sf_dir):
    """DimRestaurantViolation after closing changed versions."""
    return _text_validity(Mart(spark, sf_dir).violations_expired())


def scd2_insert(spark, sf_dir):
    """W4/J7/FLT8/F12/F13: new current versions of DimRestaurantViolation."""
    return _text_validity(Mart(spark, sf_dir).violations_new())


def scd2_job(spark, sf_dir):
    """Two stored loads of DimRestaurantViolation, the second one run again after it
    died; the dimension and the ledger read back."""
    from civic_mart.plans.jobs import scd2_runs
    return scd2_runs(spark, sf_dir)


def fact_rodent_issue(spark, sf_dir):
    """Fact refresh, pre-aggregated exact form (oracle: the literal 12-relation join)."""
    return Mart(spark, sf_dir).fact()


def fact_focus_chain(spark, sf_dir):
    """SP6/W8: the whole chain from the focus extract: extract, geocode staging, dimensions, fact.
    Requests that the extract holds twice stay twice."""
    return Mart(spark, sf_dir, focus=True).fact()


# ------------------------------------------------------------------ extract / loaders
def _mart_query(fn):
    def run(spark, sf_dir):
        return fn(Mart(spark, sf_dir))
    run.__doc__ = fn.__doc__
    run.__name__ = fn.__name__
    return run


def _extract():
    from civic_mart.plans import extract as X
    from civic_mart.plans import loads as L
    return {
        "extract_focus_requests": _mart_query(X.extract_requests),
        "extract_inspections_caseless": _mart_query(X.extract_inspections),
        "page_plan": _mart_query(X.page_plan_query),
        "page_read": _mart_query(X.page_read_query),
        "paged_source": _mart_query(X.paged_source_query),
        "keyset_pages": _mart_query(X.keyset_pages_query),
        "required_gate": _mart_query(X.required_gate_query),
        "location_category": _mart_query(X.location_category_query),
        "load_mode_window": _mart_query(X.window_counts_query),
        "csv_records": _mart_query(L.csv_records_query),
        "wkt_rings": _mart_query(L.wkt_rings_query),
        "geojson_layer": _mart_query(L.geojson_layer_query),
        "unmatched_borough": _mart_query(L.unmatched_borough_query),
        "sink_roundtrip": _mart_query(L.sink_roundtrip_query),
        "inspection_records": _mart_query(L.inspection_records_query),
        "seed_dims": _mart_query(L.seed_dims_query),
        "geojson_collections": _mart_query(L.geojson_collections_query),
    }


def stream_geocode_requests(spark, sf_dir):
    """Structured Streaming (availableNow) increment over the landed request files; after
    draining, equal to the full 311 staging table."""
    from civic_mart.streaming.incremental import run_request_geocode
    return run_request_geocode(spark, sf_dir)


def registry() -> dict[str, Query]:
    return {
        "dim_date_full": dim_date_full,
        "dim_date_incremental": dim_date_incremental,
        "point_in_polygon": point_in_polygon,
        "slanted_containment": slanted_containment,
        "geocode_requests": geocode_requests,
        "geocode_inspections": geocode_inspections,
        "geocode_applications": geocode_applications,
        "ledger_watermark": ledger_watermark,
        "increment_requests": increment_requests,
        "increment_inspections": increment_inspections,
        "job_snapshot_then_increment": job_snapshot_then_increment,
        "job_retry": job_retry,
        "job_boundary_rows": job_boundary_rows,
        "ledger_append": ledger_append,
        "dim_open_type": dim_open_type,
        "dim_location_refresh": dim_location_refresh,
        "dim_location_incremental": dim_location_incremental,
        "scd2_expire": scd2_expire,
        "scd2_insert": scd2_insert,
        "scd2_job": scd2_job,
        "fact_rodent_issue": fact_rodent_issue,
        "fact_focus_chain": fact_focus_chain,
        **_extract(),
        "stream_geocode_requests": stream_geocode_requests,
    }
