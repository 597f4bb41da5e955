"""Dimension loads: date (incremental), open-restaurant type (full refresh),
location (full refresh and insert-only increment), restaurant violation (SCD-2).

Surrogate ids are SHA-256 hashes of the business key (see ``functions.keys``),
so a retried task or a recomputed plan gives the same id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_mart.functions import calendar as cal
from civic_mart.functions.keys import surrogate_key
from civic_mart.operators.filters import all_not_null, any_yes

# fixed values: defaults and sentinels of the warehouse scripts
EMPTY_WATERMARK = "1900-01-01"
OPEN_END = "9999-12-31 00:00:00"
NONE_OPEN_TYPE = "none"

DIM_DATE_COLS = ["DateID", "Year", "Month", "DayOfMonth", "Week", "DayOfWeek", "IsWeekend"]


# ------------------------------------------------------------------ DimDate
def dim_date_watermark(dim_date: DataFrame) -> DataFrame:
    """One row ``latest``: the newest date already in DimDate (1900-01-01 when empty)."""
    d = cal.parse_day_month_year(F.col("DayOfMonth"), F.col("Month"), F.col("Year"))
    return dim_date.agg(F.coalesce(F.max(d), F.lit(EMPTY_WATERMARK).cast("date")).alias("latest"))


def date_rows(dates: DataFrame, col: str = "d") -> DataFrame:
    d = F.col(col)
    return dates.select(
        cal.date_id(d).alias("DateID"), F.year(d).cast("bigint").alias("Year"), cal.month_name(d).alias("Month"),
        F.dayofmonth(d).cast("bigint").alias("DayOfMonth"), cal.sunday_week(d).alias("Week"),
        cal.day_name(d).alias("DayOfWeek"), cal.is_weekend(d).alias("IsWeekend"))


def dim_date_increment(sources: list[tuple[DataFrame, str]], dim_date: DataFrame | None = None) -> DataFrame:
    """New DimDate rows for dates after the newest date already present.

    Each source is reduced to its distinct dates first (before the union), then the
    union is made distinct: a date dimension has at most a few thousand rows, the
    sources may have billions.
    """
    # the newest date present: a literal for an empty dimension, else a scalar subquery
    latest = (F.lit(EMPTY_WATERMARK).cast("date") if dim_date is None
              else dim_date_watermark(dim_date).scalar())
    parts = [
        df.select(F.col(c).cast("date").alias("d")).where(F.col("d") > latest).distinct()
        for df, c in sources
    ]
    dates = reduce(lambda a, b: a.unionByName(b), parts).distinct()
    return date_rows(dates)


# ------------------------------------------------------------------ DimOpenRestaurant
def dim_open_restaurant(applications: DataFrame) -> DataFrame:
    """Full refresh: approved seating types x alcohol flag, plus the ('none', 0) member."""
    flag = F.when(F.col("qualify_alcohol") == "yes", F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    approved = applications.where(any_yes("approved_for_roadway_seating", "approved_for_sidewalk_seating"))
    types = approved.select(F.col("seating_interest_sidewalk").alias("OpenRestaurantType"),
                            flag.alias("IsQualifyAlcohol")).distinct()
    none = applications.sparkSession.range(1).select(F.lit(NONE_OPEN_TYPE).alias("OpenRestaurantType"),
                                                     F.lit(0).cast("bigint").alias("IsQualifyAlcohol"))
    out = types.unionByName(none)
    return out.select(surrogate_key(F.col("OpenRestaurantType"), F.col("IsQualifyAlcohol")).alias("OpenRestaurantID"),
                      "OpenRestaurantType", "IsQualifyAlcohol")


# ------------------------------------------------------------------ DimLocation
STAGE_LOCATION_COLS = ["borough_code", "borough_name", "neighborhood_code", "neighborhood_name", "zipcode",
                       "tract_bct2020", "tract_geoid", "block_bctcb2020", "block_geoid", "locationType"]
LOCATION_KEY = ["BoroughCode", "Borough", "NeighborhoodCode", "Neighborhood", "ZipCode", "Tract", "Block",
                "LocationType"]
DIM_LOCATION_COLS = ["LocationID", *LOCATION_KEY, "PopulationDensity"]


def one_density_per_block(population: DataFrame) -> DataFrame:
    """Population rows, one per ``GeoID``.  Rows that repeat a block with the same numbers
    count once; a block with two densities would give two locations one id, so it fails
    the load."""
    per = population.groupBy("GeoID").agg(
        F.min(F.struct("Pop1", "LandAcres")).alias("lo"), F.max(F.struct("Pop1", "LandAcres")).alias("hi"))
    same = F.col("lo").eqNullSafe(F.col("hi"))
    checked = F.when(same, F.col("lo")).otherwise(F.raise_error(F.concat(
        F.lit("population: several densities for block "), F.col("GeoID"))))
    return per.withColumn("one", checked).select("GeoID", F.col("one.Pop1").alias("Pop1"),
                                                 F.col("one.LandAcres").alias("LandAcres"))


def location_candidates(stages: list[DataFrame], population: DataFrame) -> DataFrame:
    """Union of the staging branches with all ten columns present, joined to block population."""
    merged = reduce(lambda a, b: a.unionByName(b),
                    [s.select(*STAGE_LOCATION_COLS).where(all_not_null(STAGE_LOCATION_COLS)) for s in stages])
    pop = one_density_per_block(population).select(F.col("GeoID").alias("_geoid"), "Pop1", "LandAcres")
    j = merged.join(pop, merged["block_bctcb2020"] == pop["_geoid"], "inner")
    return j.select(
        F.col("borough_code").alias("BoroughCode"), F.col("borough_name").alias("Borough"),
        F.col("neighborhood_code").alias("NeighborhoodCode"), F.col("neighborhood_name").alias("Neighborhood"),
        F.col("zipcode").alias("ZipCode"), F.col("tract_bct2020").alias("Tract"),
        F.col("block_bctcb2020").alias("Block"), F.col("locationType").alias("LocationType"),
        F.try_divide(F.col("Pop1"), F.col("LandAcres")).alias("PopulationDensity"),
    ).distinct()


def with_location_id(df: DataFrame) -> DataFrame:
    return df.select(surrogate_key(*[F.col(c) for c in LOCATION_KEY]).alias("LocationID"), *LOCATION_KEY,
                     "PopulationDensity")


def dim_location_refresh(stages: list[DataFrame], population: DataFrame) -> DataFrame:
    """Full refresh (the target is emptied first, so the anti-join is a no-op)."""
    return with_location_id(location_candidates(stages, population))


def dim_location_increment(stages: list[DataFrame], population: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Insert-only: candidates whose 8-column key is not yet in the dimension
    (density is not compared).  Written as a left anti join."""
    cand = location_candidates(stages, population)
    existing = dim_location.select(*LOCATION_KEY)
    return with_location_id(cand.join(existing, on=[cand[c] == existing[c] for c in LOCATION_KEY], how="left_anti"))


# ------------------------------------------------------------------ DimRestaurantViolation (SCD-2)
VIOLATION_COLS = ["RestaurantViolationID", "Cuisine", "ViolationCode", "Category", "StartDate", "EndDate", "IsCurrent"]


def violation_pairs(inspections: DataFrame) -> DataFrame:
    """Distinct (cuisine, violation code) with the first and last inspection date.

    The SCD-2 steps only ask whether a pair occurs after (or up to) a watermark:
    ``last > w`` / ``first <= w``.  One partial aggregation reduces billions of
    inspection rows to the business keys before any join."""
    return inspections.groupBy("cuisine_description", "violation_code").agg(
        F.min("inspection_date").alias("first_date"), F.max("inspection_date").alias("last_date"))


def pairs_as_rows(pairs: DataFrame, side: str) -> DataFrame:
    """View the pair table as inspection rows dated ``last`` (for '> w' tests) or
    ``first`` (for '<= w' tests)."""
    col = "last_date" if side == "after" else "first_date"
    return pairs.select("cuisine_description", "violation_code", F.col(col).alias("inspection_date"))


def _changed_ids(inspections: DataFrame, focus: DataFrame, dim: DataFrame, watermark: Column) -> DataFrame:
    src = inspections.where(F.col("inspection_date") > watermark).select("cuisine_description", "violation_code")
    f = focus.select(F.col("violation_code").alias("_fcode"), F.col("category").alias("_fcat"))
    cur = dim.where(F.col("IsCurrent") == 1).select("RestaurantViolationID", "Cuisine", "ViolationCode", "Category")
    j = (src.join(f, src["violation_code"] == f["_fcode"], "inner")
         .join(cur, (cur["Cuisine"] == src["cuisine_description"]) & (cur["ViolationCode"] == src["violation_code"])
               & (cur["Category"] != f["_fcat"]), "inner"))
    return j.select("RestaurantViolationID").distinct()


def scd2_expire(inspections: DataFrame, focus: DataFrame, dim: DataFrame, watermark: Column,
                execution_time: Column) -> DataFrame:
    """The dimension after closing current versions whose category changed:
    ``EndDate = execution_time, IsCurrent = 0``.  Parquet has no UPDATE, so the
    whole (small) dimension is rewritten from a left join on a flag column."""
    ids = _changed_ids(inspections, focus, dim, watermark).withColumn("_hit", F.lit(True))
    j = dim.join(ids, "RestaurantViolationID", "left")
    hit = F.col("_hit").isNotNull()
    return j.select(
        "RestaurantViolationID", "Cuisine", "ViolationCode", "Category", "StartDate",
        F.when(hit, execution_time.cast("timestamp_ntz")).otherwise(F.col("EndDate")).alias("EndDate"),
        F.when(hit, F.lit(0).cast("bigint")).otherwise(F.col("IsCurrent")).alias("IsCurrent"))


def scd2_new_versions(inspections: DataFrame, focus: DataFrame, dim_after_expire: DataFrame, watermark: Column,
                      execution_time: Column) -> DataFrame:
    """New current versions: (cuisine, code, category) with no current row in the
    already-expired dimension.  A NULL cuisine never matches, so it is inserted again
    on every run, as in the source script."""
    src = inspections.where(F.col("inspection_date") > watermark).select("cuisine_description", "violation_code")
    f = focus.select(F.col("violation_code").alias("_fcode"), F.col("category").alias("_fcat"))
    cand = (src.join(f, src["violation_code"] == f["_fcode"], "inner")
            .select(F.col("cuisine_description").alias("Cuisine"), F.col("violation_code").alias("ViolationCode"),
                    F.col("_fcat").alias("Category")).distinct())
    cur = dim_after_expire.where(F.col("IsCurrent") == 1).select(
        F.col("Cuisine").alias("_c"), F.col("ViolationCode").alias("_v"), F.col("Category").alias("_k"))
    new = cand.join(cur, (cand["Cuisine"] == cur["_c"]) & (cand["ViolationCode"] == cur["_v"])
                    & (cand["Category"] == cur["_k"]), "left_anti")
    start = execution_time.cast("timestamp_ntz")
    return new.select(
        surrogate_key(F.col("Cuisine"), F.col("ViolationCode"), F.col("Category"),
                      F.date_format(start, "yyyy-MM-dd HH:mm:ss")).alias("RestaurantViolationID"),
        "Cuisine", "ViolationCode", "Category", start.alias("StartDate"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("EndDate"), F.lit(1).cast("bigint").alias("IsCurrent"))


def scd2_apply(inspections: DataFrame, focus: DataFrame, dim: DataFrame, watermark: Column,
               execution_time: Column) -> DataFrame:
    """Expire changed versions, then append new current versions (the next dimension)."""
    expired = scd2_expire(inspections, focus, dim, watermark, execution_time)
    return expired.unionByName(scd2_new_versions(inspections, focus, expired, watermark, execution_time))
