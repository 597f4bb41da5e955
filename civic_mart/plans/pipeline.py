"""The mart pipeline over the derived civic tables.

``Mart`` wires the operators the way the warehouse jobs do: extract window ->
geocode staging -> dimensions -> fact.  The registered queries in
``plans.queries`` are thin selections of these steps.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.functions.keys import surrogate_key
from civic_mart.operators import dims, ledger, spatial
from civic_mart.operators.facts import FactInputs, fact_preaggregated
from civic_mart.operators.filters import caseless_one_of, geolocated, half_open_window, open_window
from civic_mart.operators.geocode import GeocodeSpec, LayerSpec, geocode
from civic_mart.operators.lookups import lookup_with_default
from civic_mart.operators.quality import split_required
from civic_mart.plans.model import Model
from civic_mart.sources import sinks

# fixed values (driver model): location type -> category lookup
LOCATION_CATEGORIES = [
    ("Street", "Street"),
    ("Residential Building", "Residential"),
    ("RESIDENTIAL BUILDING", "Residential"),
    ("Park", "Park"),
    ("", "Other"),
    ("Store", "Commercial"),
]
# fixed values (driver model): focus complaint types, as listed (two differ only in case)
FOCUS_COMPLAINT_TYPES = ["click", "CLICK", "purchase", "signup", "Signup", "Rodent"]
# fixed values (driver model): focus violation codes and categories, before and after a change
FOCUS_VIOLATIONS_V1 = [("VAF", "Rodent"), ("VNF", "Rodent"), ("VRF", "Pest"), ("VAO", "Pest")]
FOCUS_VIOLATIONS_V2 = [("VAF", "Rodent"), ("VNF", "Pest"), ("VRF", "Pest"), ("VAO", "Facility"), ("VNO", "Rodent")]

REQUEST_REQUIRED = ["unique_key", "created_date", "complaint_type", "latitude", "longitude"]
SNAPSHOT_START = "1900-01-01 00:00:00"
# run instant of the registered queries, a job's argument: UTC
RUN_UTC = "2024-02-01 12:00:00"

JOB_311 = "batch_311_request_location"
JOB_INS = "batch_restaurant_inspection_location"
JOB_DIM_VIO = "Load_DimRestaurantInspection"
JOB_DIM_LOC_311 = "Load_DimLocation_311Requests"
JOB_DIM_LOC_INS = "Load_DimLocation_RestaurantInspection"
LEDGER_JOBS = [JOB_311, JOB_INS, JOB_DIM_VIO, JOB_DIM_LOC_311, JOB_DIM_LOC_INS]

LAYER_OUTPUTS = {
    "blocks": {"block_bctcb2020": "code", "block_geoid": "geoid"},
    "tracts": {"tract_bct2020": "code", "tract_geoid": "geoid"},
    "ntas": {"neighborhood_code": "code", "neighborhood_name": "label"},
}


def mid_date(df: DataFrame, col: str) -> DataFrame:
    """One row: ``first`` (earliest day) and ``mid`` (middle day) of ``col`` at midnight."""
    lo, hi = F.to_date(F.min(col)), F.to_date(F.max(col))
    return df.agg(lo.cast("timestamp_ntz").alias("first"),
                  F.date_add(lo, F.floor(F.datediff(hi, lo) / 2).cast("int")).cast("timestamp_ntz").alias("mid"))


# prepared layers, staging tables and dimensions, materialized once per (application, state of
# the source folder, run): the warehouse stores them as tables; later jobs read them instead of
# recomputing.  New, changed or removed files are another state and are never missed.
_SHARED: dict[tuple, object] = {}


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """What the source folder holds now: number, bytes and a hash of names, sizes and times of
    its files (a listing; no file is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(sf_dir)
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"),
                           F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def _shared_key(spark: SparkSession, sf_dir: str, what: str, *extra) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what, *extra)


# fixed values (time seed): first hour of each period of the day
TIME_PERIODS = [(0, "Night"), (5, "Early Morning"), (7, "Breakfast"), (10, "Morning"), (12, "Lunch"), (15, "Afternoon"),
                (18, "Dinner"), (22, "Night")]


class Mart:
    """The warehouse jobs over one source folder.

    Jobs build on each other as in the source system: geocode staging reads the
    layers, the dimensions read the staging tables, the fact reads the dimensions.
    With ``materialize`` (the default) every table a later job reads is written
    once to the shared checkpoint folder and read back from there.  ``overrides``
    replaces a driver table, e.g. by one micro-batch of a stream.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, broadcast_limit: int = spatial.DEFAULT_BROADCAST_LIMIT,
                 materialize: bool = True, overrides: dict[str, DataFrame] | None = None, run_utc: str = RUN_UTC,
                 focus: bool = False):
        self.spark = spark
        #: whether the request table is the focus extract (as in the source system) or all requests
        self.focus = focus
        self.run_utc = run_utc
        day = ledger.local_today(datetime.fromisoformat(run_utc))
        #: staging takes requests before the run's local day, inspections before the day before it
        self.request_end, self.inspection_end = f"{day} 00:00:00", f"{day - timedelta(days=1)} 00:00:00"
        self.m = Model(spark, sf_dir, overrides)
        self.broadcast_limit = broadcast_limit
        self.materialize = materialize

    def _keep(self, df: DataFrame) -> DataFrame:
        """Materialize a reused intermediate in the checkpoint folder (reliable, survives
        executor loss; the lineage above it is cut)."""
        if not self.materialize:
            return df
        if not self.spark.sparkContext.getCheckpointDir():
            from civic_mart.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(self.spark)
        return sinks.materialize(df, "mart")

    @cached_property
    def _state(self) -> tuple:
        return source_state(self.spark, self.m.sf_dir)

    def _shared(self, what: str, build):
        """``build()`` once per application, source folder and ``what``; inputs replaced by
        ``overrides`` are never shared (the layers do not depend on them)."""
        if not self.materialize or (self.m.overrides and what != "layers"):
            return build()
        # the layers depend neither on the run's instant nor on the focus extract
        of_run = () if what == "layers" else (self.run_utc, self.focus)
        key = _shared_key(self.spark, self.m.sf_dir, what, self.broadcast_limit, self._state, *of_run)
        if key not in _SHARED:
            _SHARED[key] = build()
        return _SHARED[key]

    # ---------------------------------------------------------------- lookups
    def location_categories(self) -> DataFrame:
        return self.spark.createDataFrame(LOCATION_CATEGORIES, "location_type string, category string")

    def focus_violations(self, version: int = 2) -> DataFrame:
        rows = FOCUS_VIOLATIONS_V1 if version == 1 else FOCUS_VIOLATIONS_V2
        return self.spark.createDataFrame(rows, "violation_code string, category string")

    # ---------------------------------------------------------------- layers
    @cached_property
    def layers(self) -> list[LayerSpec]:
        def build():
            if self.materialize and not self.spark.sparkContext.getCheckpointDir():
                from civic_mart.session import ensure_checkpoint_dir
                ensure_checkpoint_dir(self.spark)
            def one(name: str, prefix: str) -> LayerSpec:
                attrs = sorted(set(LAYER_OUTPUTS[name].values()) | {"BoroCode", "BoroName"})
                layer = spatial.prepare_layer(self.m.layer(name), "the_geom", "BoroName", "poly_id", attrs,
                                              materialize=self._keep if self.materialize else None)
                return LayerSpec(prefix, layer, LAYER_OUTPUTS[name])

            # the layers do not depend on each other: their jobs run side by side
            with ThreadPoolExecutor(3) as pool:
                return list(pool.map(one, ("blocks", "tracts", "ntas"), ("b_", "t_", "n_")))
        return self._shared("layers", build)

    # ---------------------------------------------------------------- staging
    def valid_requests(self) -> DataFrame:
        """Requests with every REQUIRED column; with ``focus`` those of the focus extract: a request
        that matches two focus types (the same text in other case) is there twice."""
        valid, _ = split_required(self.m.requests(), REQUEST_REQUIRED)
        if not self.focus:
            return valid
        types = self.spark.createDataFrame([(t,) for t in FOCUS_COMPLAINT_TYPES], "_focus string")
        return valid.where(half_open_window("created_date", ledger.EXTRACT_SNAPSHOT_START, self.request_end)).join(
            F.broadcast(types), F.lower("complaint_type") == F.lower("_focus")).drop("_focus")  # a fixed list of types

    def rejected_requests(self) -> DataFrame:
        """Requests that lack a REQUIRED column, for the quarantine table."""
        return split_required(self.m.requests(), REQUEST_REQUIRED)[1]

    def stage_requests(self, start=SNAPSHOT_START, end: str | None = None, src: DataFrame | None = None) -> DataFrame:
        """Staging rows of the valid requests of a window, or of ``src``, a run's own rows."""
        if src is None:
            src = self.valid_requests().where(open_window("created_date", start, end or self.request_end))
        spec = GeocodeSpec(key="unique_key", order=["created_date", "unique_key"], x="longitude", y="latitude",
                           borough="borough",
                           fields={"created_date": "created_date", "zipcode": "incident_zip",
                                   "location_type": "location_type"},
                           layers=self.layers)
        g = geocode(src, spec, self.broadcast_limit)
        g = lookup_with_default(g, "location_type", self.location_categories(), "location_type", "category", "locationType")
        return g.select("unique_key", "created_date", *dims.STAGE_LOCATION_COLS)

    def stage_inspections(self, start=SNAPSHOT_START, end: str | None = None, src: DataFrame | None = None) -> DataFrame:
        """Staging rows of the inspections of a window, or of ``src``, a run's own rows."""
        if src is None:
            src = self.m.inspections().where(open_window("inspection_date", start, end or self.inspection_end))
        spec = GeocodeSpec(key="camis", order=["inspection_date", "rec_order", "rec_line"], x="longitude",
                           y="latitude", borough="boro",
                           fields={"inspection_date": "inspection_date", "zipcode": "zipcode"},
                           layers=self.layers)
        g = geocode(src, spec, self.broadcast_limit).withColumn("locationType", F.lit("Commercial"))
        return g.select("camis", "inspection_date", *dims.STAGE_LOCATION_COLS)

    def stage_applications(self) -> DataFrame:
        src = geolocated(self.m.applications())
        spec = GeocodeSpec(key="objectid", order=["time_of_submission", "objectid"], x="longitude", y="latitude",
                           borough="borough", fields={"zipcode": "zip"}, layers=self.layers)
        g = geocode(src, spec, self.broadcast_limit)
        g = g.withColumn("locationType", F.lit("Commercial"))
        return g.select("objectid", *dims.STAGE_LOCATION_COLS)

    # ---------------------------------------------------------------- ledger
    def ledger(self) -> DataFrame:
        """Ledger of two earlier runs per job (first day and middle day of its source)."""
        def runs(src: DataFrame, jobs: list[str]) -> DataFrame:
            entries = [F.struct(F.lit(j).alias("job_name"), F.col(c).alias("latest_record_date"))
                       for j in jobs for c in ("first", "mid")]
            return src.select(F.explode(F.array(*entries)).alias("e")).select(
                "e.job_name", "e.latest_record_date",
                (F.col("e.latest_record_date") + F.expr("INTERVAL 25 HOURS")).alias("execution_date"))
        req = mid_date(self.valid_requests(), "created_date")
        ins = mid_date(self.m.inspections(), "inspection_date")
        return runs(req, [JOB_311, JOB_DIM_LOC_311]).unionByName(runs(ins, [JOB_INS, JOB_DIM_VIO, JOB_DIM_LOC_INS]))

    @cached_property
    def _watermarks(self) -> dict[str, object]:
        """All job watermarks, read once (one small job) like the source jobs read their
        ledger before building the query; as literals they reach the Parquet scan as
        pushed filters, which scalar subqueries do not."""
        rows = ledger.watermarks(self.ledger(), LEDGER_JOBS).collect()
        return {r["job_name"]: r["latest_record_date"] for r in rows}

    def watermark(self, job: str):
        # a zone-less literal built from text: independent of the session time zone
        return F.lit(self._watermarks[job].isoformat(sep=" ")).cast("timestamp_ntz")

    # ---------------------------------------------------------------- staging (materialized)
    def stored_stage(self, source: str) -> DataFrame:
        """The staging table of one source as its geocode job stored it (written once per
        session and source folder; later jobs read the files)."""
        build = {"requests": self.stage_requests, "inspections": self.stage_inspections,
                 "applications": self.stage_applications}[source]
        return self._shared(f"stage_{source}", lambda: self._keep(build()))

    @property
    def staged(self) -> dict[str, DataFrame]:
        names = ("requests", "inspections", "applications")
        _ = self.layers  # all three read them; the staging jobs themselves do not depend on each other
        with ThreadPoolExecutor(len(names)) as pool:
            return dict(zip(names, pool.map(self.stored_stage, names)))

    # ---------------------------------------------------------------- dimensions
    def dim_time(self) -> DataFrame:
        period = F.coalesce(*[F.when(F.col("h") >= first, F.lit(name)) for first, name in reversed(TIME_PERIODS)])
        return self.spark.range(24).select(F.col("id").alias("h")).select(
            F.lpad(F.col("h").cast("string"), 2, "0").alias("TimeID"), F.col("h").alias("Hour"),
            F.when(F.col("h") < 12, F.lit("AM")).otherwise("PM").alias("AMPM"), period.alias("TimePeriod"))

    def dim_complaint(self) -> DataFrame:
        req = self.valid_requests().where(caseless_one_of("complaint_type", FOCUS_COMPLAINT_TYPES))
        kinds = req.select(F.col("complaint_type").alias("ComplaintType"),
                           F.coalesce("descriptor", F.lit("N/A")).alias("ComplaintDescription")).distinct()
        default = self.spark.range(1).select(F.lit("Not Interested").alias("ComplaintType"),
                                             F.lit("N/A").alias("ComplaintDescription"))
        out = kinds.unionByName(default)
        return out.select(surrogate_key(F.col("ComplaintType"), F.col("ComplaintDescription")).alias("ComplaintID"),
                          "ComplaintType", "ComplaintDescription",
                          F.when(F.col("ComplaintType") == "Not Interested", F.lit("None"))
                          .otherwise(F.lower("ComplaintType")).alias("Category"))

    def dim_date(self) -> DataFrame:
        return dims.dim_date_increment([(self.valid_requests(), "created_date"),
                                        (self.m.inspections(), "inspection_date")])

    def dim_open(self) -> DataFrame:
        return dims.dim_open_restaurant(self.m.applications())

    def dim_location(self) -> DataFrame:
        st = self.staged
        return dims.dim_location_refresh([st["requests"], st["inspections"], st["applications"]],
                                         self.m.population_blocks())

    def dim_location_increment(self) -> DataFrame:
        """Prior dimension = refresh over staging up to the ledger watermarks (open
        restaurants always whole); increment = new keys from rows after them."""
        st = self.staged
        w311, wins = self.watermark(JOB_DIM_LOC_311), self.watermark(JOB_DIM_LOC_INS)
        pop = self.m.population_blocks()
        prior = dims.dim_location_refresh([st["requests"].where(F.col("created_date") <= w311),
                                           st["inspections"].where(F.col("inspection_date") <= wins),
                                           st["applications"]], pop)
        return dims.dim_location_increment([st["requests"].where(F.col("created_date") > w311),
                                            st["inspections"].where(F.col("inspection_date") > wins),
                                            st["applications"]], pop, prior)

    def _empty_violations(self) -> DataFrame:
        return self.spark.createDataFrame([], "RestaurantViolationID string, Cuisine string, ViolationCode string, "
                                              "Category string, StartDate timestamp_ntz, EndDate timestamp_ntz, "
                                              "IsCurrent bigint")

    @cached_property
    def violation_pairs(self) -> DataFrame:
        return self._keep(dims.violation_pairs(self.m.inspections()))

    def violations_prior(self) -> DataFrame:
        """The dimension as the earlier run (v1 categories, inspections up to the watermark) left it."""
        w = self.watermark(JOB_DIM_VIO)
        ins = dims.pairs_as_rows(self.violation_pairs, "before").where(F.col("inspection_date") <= w)
        return dims.scd2_apply(ins, self.focus_violations(1), self._empty_violations(),
                               F.lit(SNAPSHOT_START).cast("timestamp_ntz"), w)

    def run_time(self):
        return ledger.local_now(self.run_utc)

    def violations_expired(self, prior: DataFrame | None = None) -> DataFrame:
        # the previous run's dimension is a stored table in the warehouse: written once
        prior = self._keep(self.violations_prior()) if prior is None else prior
        return dims.scd2_expire(dims.pairs_as_rows(self.violation_pairs, "after"), self.focus_violations(2), prior,
                                self.watermark(JOB_DIM_VIO), self.run_time())

    def violations_new(self, expired: DataFrame | None = None) -> DataFrame:
        expired = self.violations_expired() if expired is None else expired
        return dims.scd2_new_versions(dims.pairs_as_rows(self.violation_pairs, "after"), self.focus_violations(2),
                                      expired, self.watermark(JOB_DIM_VIO), self.run_time())

    def dim_violation(self) -> DataFrame:
        expired = self._keep(self.violations_expired())
        none = self.spark.range(1).select(
            surrogate_key(F.lit("None"), F.lit("None"), F.lit("None"), F.lit("1900-01-01 00:00:00"))
            .alias("RestaurantViolationID"), F.lit("None").alias("Cuisine"), F.lit("None").alias("ViolationCode"),
            F.lit("None").alias("Category"), F.lit(SNAPSHOT_START).cast("timestamp_ntz").alias("StartDate"),
            F.lit(dims.OPEN_END).cast("timestamp_ntz").alias("EndDate"), F.lit(1).cast("bigint").alias("IsCurrent"))
        return expired.unionByName(self.violations_new(expired)).unionByName(none)

    # ---------------------------------------------------------------- fact
    def fact_inputs(self) -> FactInputs:
        st = self.staged
        names = ("dim_location", "dim_complaint", "dim_violation", "dim_open", "dim_date")
        with ThreadPoolExecutor(len(names)) as pool:  # nor do the dimensions, once the staging tables are there
            dim = dict(zip(names, pool.map(self.stored, names)))
        return FactInputs(
            requests=self.valid_requests(), request_locations=st["requests"],
            inspection_locations=st["inspections"], inspections=self.m.inspections(),
            open_locations=st["applications"], applications=self.m.applications(),
            **dim, dim_time=self.dim_time())

    def stored(self, dim: str) -> DataFrame:
        """A dimension as its load job stored it: built and written once per session and
        source folder, then read by every later job (the fact reads tables, it does not
        re-derive them)."""
        return self._shared(dim, lambda: self._keep(getattr(self, dim)()))

    def fact(self) -> DataFrame:
        return fact_preaggregated(self.fact_inputs(), self._keep)
