"""Fact refresh: FactNYCRodentIssue.

The source script joins twelve relations; requests, inspections and open
applications meet through full outer joins on (block, location type), which
multiplies every request by every inspection and application of its block.
Because the grouping key splits into a request part, an inspection part and an
open-restaurant part, every request row of a group is repeated the same number
of times, and COUNT DISTINCT / AVG do not change under uniform repetition.
``fact_preaggregated`` therefore aggregates each side on its own and joins the
aggregates on (block, type): the exact result without the fan-out.  Every source is
scanned once: what two parts need of the inspections is stored between them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_mart.functions import calendar as cal
from civic_mart.functions.keys import surrogate_key

# fixed values: default members of the fact's dimension joins
DEFAULT_COMPLAINT_TYPE = "Not Interested"
DEFAULT_COMPLAINT_DESCRIPTION = "N/A"
DEFAULT_VIOLATION = "None"
DEFAULT_OPEN_TYPE = "none"

FACT_COLS = ["RodentIssueID", "LocationID", "RestaurantViolationID", "OpenRestaurantID", "DateID", "TimeID",
             "ComplaintID", "NumberOfComplaints", "NumberOfViolations", "AvgResolveTimeForComplaints"]
# requests or visits that one task joins and aggregates: what a task holds does not grow with the input
ROWS_PER_TASK = 100_000
GROUP_IDS = ["LocationID", "RestaurantViolationID", "OpenRestaurantID", "DateID", "TimeID", "ComplaintID"]


@dataclass
class FactInputs:
    requests: DataFrame          # unique_key, created_date, closed_date, complaint_type, descriptor
    request_locations: DataFrame  # unique_key, block_bctcb2020, locationType
    inspection_locations: DataFrame  # camis, block_bctcb2020, locationType
    inspections: DataFrame       # camis, violation_code, cuisine_description, inspection_date
    open_locations: DataFrame    # objectid, block_bctcb2020, locationType
    applications: DataFrame      # objectid, seating_interest_sidewalk, qualify_alcohol, approved_* columns
    dim_location: DataFrame
    dim_complaint: DataFrame
    dim_violation: DataFrame
    dim_open: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame


def _alcohol(c) -> F.Column:
    return F.when(c == "yes", F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _approved(df: DataFrame) -> DataFrame:
    return df.where((F.col("approved_for_roadway_seating") == "yes") | (F.col("approved_for_sidewalk_seating") == "yes"))


def _member_ids(members: DataFrame, id_col: str) -> F.Column:
    """Ids of a dimension's default member(s) as a scalar array subquery (a handful of
    rows; several only when the dimension repeats the default business key)."""
    return members.agg(F.array_sort(F.collect_list(id_col))).scalar()


def _tasks(stored: DataFrame) -> int:
    spark = stored.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), stored.count() // ROWS_PER_TASK)


def _with_id(df: DataFrame) -> DataFrame:
    return df.select(surrogate_key(*[F.col(c) for c in GROUP_IDS]).alias("RodentIssueID"), *FACT_COLS[1:])


def _or_default(left: DataFrame, side: DataFrame, member: str, defaults: F.Column) -> DataFrame:
    """``left`` with the members of ``side`` in its (block, type).  A (block, type) that the
    side does not know gets the default members; one that it knows without a member (a
    NULL id) has no row."""
    j = left.join(side.withColumn("_known", F.lit(True)), ["_b", "_t"], "left")
    ids = F.when(F.col("_known").isNull(), defaults).when(F.col(member).isNotNull(), F.array(member))
    return j.withColumn("_ids", ids).withColumn(member, F.explode("_ids")).drop("_known", "_ids")


def fact_preaggregated(x: FactInputs, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Exact fact without the block-level fan-out (see module doc).

    ``keep`` stores an intermediate that two parts read.  Every staged request location
    has its request (staging is made from the requests), so the blocks with requests are
    known from the staging table alone.  The planner sizes every join, but requests and visits are
    dealt to as many tasks as they need, since a fixed number of tasks would hold ever more of them."""
    tasks = _tasks(x.request_locations)
    # --- requests: one aggregate row per block, type, date, hour and complaint.  Every location of a (block, type) has the
    # same requests, so the long location ids come last: only where the rows lie by (block, type) anyway
    places_known = x.dim_location.select("LocationID", F.col("Block").alias("_b"), F.col("LocationType").alias("_t")).distinct()
    located = x.request_locations.select("unique_key", F.col("block_bctcb2020").alias("_b"),
                                         F.col("locationType").alias("_t")).join(
        places_known.select("_b", "_t"), ["_b", "_t"], "left_semi")
    complaints = x.dim_complaint.select("ComplaintID", F.col("ComplaintType").alias("_ct"),
                                        F.col("ComplaintDescription").alias("_cd"))
    dates = x.dim_date.select(F.col("DateID").alias("_date"), "DateID")
    hours = x.dim_time.select(F.col("Hour").alias("_hour"), "TimeID")
    r = x.requests.select(
        "unique_key", cal.date_id(F.col("created_date")).alias("_date"), F.hour("created_date").alias("_hour"),
        cal.hour_diff(F.col("created_date"), F.col("closed_date")).alias("_hours_open"),
        F.coalesce("complaint_type", F.lit(DEFAULT_COMPLAINT_TYPE)).alias("_ct"),
        F.coalesce("descriptor", F.lit(DEFAULT_COMPLAINT_DESCRIPTION)).alias("_cd"))
    group = ["_b", "_t", "DateID", "TimeID", "ComplaintID"]
    r = r.join(complaints, ["_ct", "_cd"]).join(dates, "_date").join(hours, "_hour").repartition(tasks, "unique_key")
    r = (r.join(located.repartition(tasks, "unique_key"), "unique_key").select(*group, "unique_key", "_hours_open")
         .repartition(tasks, *group).groupBy(*group).agg(
             F.count_distinct("unique_key").alias("NumberOfComplaints"), F.avg("_hours_open").alias("_avg")))

    # --- inspections: the visits of every staged inspection location with their violation member
    vio = x.dim_violation.select("RestaurantViolationID", F.col("ViolationCode").alias("_vc"), F.col("Cuisine").alias("_vu"))
    places = x.inspection_locations.select("camis", F.col("block_bctcb2020").alias("_b"), F.col("locationType").alias("_t"))
    seen = x.inspections.select(F.col("camis").alias("_ic"), "violation_code", "cuisine_description",
                                cal.date_id(F.col("inspection_date")).alias("_date"),
                                F.hour("inspection_date").alias("_hour"))  # not made distinct: only restaurants are counted
    visits = keep(places.join(seen, F.col("camis") == F.col("_ic"), "left").select(
        "_b", "_t", "_ic", "_date", "_hour", F.coalesce("violation_code", F.lit(DEFAULT_VIOLATION)).alias("_vc"),
        F.coalesce("cuisine_description", F.lit(DEFAULT_VIOLATION)).alias("_vu")).join(vio, ["_vc", "_vu"], "left").select(
        "_b", "_t", "_ic", "_date", "_hour", "RestaurantViolationID"))
    violations = visits.groupBy("_b", "_t", "RestaurantViolationID").agg(
        F.count_distinct("_ic").alias("NumberOfViolations"))
    no_violation = _member_ids(vio.where((F.col("_vc") == DEFAULT_VIOLATION) & (F.col("_vu") == DEFAULT_VIOLATION)),
                               "RestaurantViolationID")

    # --- open restaurants per (block, type)
    kinds = x.dim_open.select("OpenRestaurantID", F.col("OpenRestaurantType").alias("_ot"),
                              F.col("IsQualifyAlcohol").alias("_oa"))
    sites = x.open_locations.select("objectid", F.col("block_bctcb2020").alias("_b"), F.col("locationType").alias("_t"))
    approved = _approved(x.applications).select(F.col("objectid").alias("_ao"), "seating_interest_sidewalk", "qualify_alcohol")
    opened = sites.join(approved, F.col("objectid") == F.col("_ao"), "left").select(
        "_b", "_t", F.coalesce("seating_interest_sidewalk", F.lit(DEFAULT_OPEN_TYPE)).alias("_ot"),
        _alcohol(F.col("qualify_alcohol")).alias("_oa")).join(kinds, ["_ot", "_oa"], "left").select(
        "_b", "_t", "OpenRestaurantID").distinct()
    not_open = _member_ids(kinds.where((F.col("_ot") == DEFAULT_OPEN_TYPE) & (F.col("_oa") == 0)), "OpenRestaurantID")

    with_requests = _or_default(_or_default(r, violations, "RestaurantViolationID", no_violation), opened,
                                "OpenRestaurantID", not_open).join(places_known, ["_b", "_t"]).select(
        *GROUP_IDS, "NumberOfComplaints", F.coalesce("NumberOfViolations", F.lit(0)).alias("NumberOfViolations"),
        F.coalesce("_avg", F.lit(0.0)).alias("AvgResolveTimeForComplaints"))

    # --- visits in a (block, type) without a request: no location, complaint or open restaurant
    no_complaint = _member_ids(complaints.where((F.col("_ct") == DEFAULT_COMPLAINT_TYPE)
                                                & (F.col("_cd") == DEFAULT_COMPLAINT_DESCRIPTION)), "ComplaintID")
    # the blocks of requests, made distinct before they meet the dimension
    asked = x.request_locations.select(F.col("block_bctcb2020").alias("_b"), F.col("locationType").alias("_t")).distinct().join(
        x.dim_location.select(F.col("Block").alias("_b"), F.col("LocationType").alias("_t")), ["_b", "_t"], "left_semi")
    visited = visits.where(F.col("RestaurantViolationID").isNotNull())
    somewhere = F.col("_b").isNotNull() & F.col("_t").isNotNull()  # other visits match no block and need no shuffle
    unasked = visited.where(somewhere).repartition(_tasks(visits), "_b", "_t").join(
        asked, ["_b", "_t"], "left_anti").unionByName(visited.where(~somewhere))
    alone = (unasked.join(dates, "_date").join(hours, "_hour")
             .groupBy("RestaurantViolationID", "DateID", "TimeID").agg(F.count_distinct("_ic").alias("NumberOfViolations"))
             .withColumn("ComplaintID", F.explode(no_complaint)).withColumn("OpenRestaurantID", F.explode(not_open)))
    return _with_id(with_requests.unionByName(alone.select(
        F.lit(None).cast("string").alias("LocationID"), "RestaurantViolationID", "OpenRestaurantID", "DateID", "TimeID",
        "ComplaintID", F.lit(0).cast("bigint").alias("NumberOfComplaints"), "NumberOfViolations",
        F.lit(0.0).alias("AvgResolveTimeForComplaints"))))
