"""Dimensions (date, open type, location, SCD-2) and the fact refresh."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from civic_mart.operators import dims
from civic_mart.operators.facts import FactInputs, fact_preaggregated
from conftest import SF_SMALL, rows

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1, 7, 0)
END = dt.datetime(9999, 12, 31)
DIM_DDL = ("RestaurantViolationID string, Cuisine string, ViolationCode string, Category string, "
           "StartDate timestamp_ntz, EndDate timestamp_ntz, IsCurrent bigint")


def _scd_inputs(spark):
    prior = spark.createDataFrame([
        ("id1", "c1", "VAF", "Rodent", T0, END, 1),
        ("id2", "c1", "VNF", "Rodent", T0, END, 1),
        ("id3", "c2", "VAF", "Pest", T0, T0, 0),       # already expired
    ], DIM_DDL)
    focus = spark.createDataFrame([("VAF", "Rodent"), ("VNF", "Pest"), ("VNO", "Rodent")],
                                  "violation_code string, category string")
    ins = spark.createDataFrame([
        ("c1", "VAF", dt.datetime(2024, 1, 10)), ("c1", "VNF", dt.datetime(2024, 1, 10)),
        ("c1", "VNO", dt.datetime(2024, 1, 11)), (None, "VAF", dt.datetime(2024, 1, 12)),
        ("c2", "VAF", dt.datetime(2024, 1, 12)), ("c9", "VNF", dt.datetime(2023, 1, 1)),  # before the watermark
        ("c1", "XXX", dt.datetime(2024, 1, 12)),                                         # not a focus code
    ], "cuisine_description string, violation_code string, inspection_date timestamp_ntz")
    return prior, focus, ins


def test_scd2_expire_and_insert(spark):
    prior, focus, ins = _scd_inputs(spark)
    wm, now = F.lit(dt.datetime(2023, 12, 31)), F.lit(T1)
    expired = dims.scd2_expire(ins, focus, prior, wm, now)
    assert rows(expired, "RestaurantViolationID", "EndDate", "IsCurrent") == [
        ("id1", END, 1), ("id2", T1, 0), ("id3", T0, 0)]
    new = dims.scd2_new_versions(ins, focus, expired, wm, now)
    assert rows(new, "Cuisine", "ViolationCode", "Category", "IsCurrent") == [
        ("None", "VAF", "Rodent", 1), ("c1", "VNF", "Pest", 1), ("c1", "VNO", "Rodent", 1), ("c2", "VAF", "Rodent", 1)
    ] or rows(new, "Cuisine", "ViolationCode", "Category", "IsCurrent") == sorted(
        [(None, "VAF", "Rodent", 1), ("c1", "VNF", "Pest", 1), ("c1", "VNO", "Rodent", 1), ("c2", "VAF", "Rodent", 1)],
        key=lambda t: tuple(str(x) for x in t))
    assert all(r["StartDate"] == T1 and r["EndDate"] == END for r in new.collect())


def test_scd2_rerun_only_reinserts_null_cuisine(spark):
    prior, focus, ins = _scd_inputs(spark)
    wm = F.lit(dt.datetime(2023, 12, 31))
    once = dims.scd2_apply(ins, focus, prior, wm, F.lit(T1))
    twice = dims.scd2_apply(ins, focus, once, wm, F.lit(dt.datetime(2024, 2, 2)))
    assert twice.count() == once.count() + 1
    assert twice.subtract(once).select("Cuisine").collect()[0][0] is None
    cur = twice.where("IsCurrent = 1 AND Cuisine IS NOT NULL").groupBy("Cuisine", "ViolationCode", "Category").count()
    assert cur.where("count > 1").count() == 0


def test_dim_open_restaurant(spark):
    apps = spark.createDataFrame([
        ("sidewalk", "yes", "no", "yes"), ("sidewalk", "no", "yes", "no"), ("roadway", "no", "no", "yes"),
        (None, "yes", "yes", None), ("both", None, "yes", "yes"),
    ], "seating_interest_sidewalk string, approved_for_sidewalk_seating string, "
       "approved_for_roadway_seating string, qualify_alcohol string")
    got = rows(dims.dim_open_restaurant(apps), "OpenRestaurantType", "IsQualifyAlcohol")
    assert got == sorted([("sidewalk", 1), ("sidewalk", 0), (None, 0), ("both", 1), ("none", 0)],
                         key=lambda t: tuple(str(x) for x in t))


def _stage(spark, rows_):
    return spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in dims.STAGE_LOCATION_COLS))


def test_dim_location_refresh_and_increment(spark):
    base = ["1", "Q", "N1", "Nbhd", "11101", "T1", "G1", "B1", "GB1", "Residential"]
    s1 = _stage(spark, [base, base[:7] + ["B2", "GB2", "Residential"], base[:9] + [None]])
    s2 = _stage(spark, [base[:4] + ["11102"] + base[5:], base[:7] + ["B3", "GB3", "Commercial"]])
    pop = spark.createDataFrame([("B1", 100, 2.0), ("B2", 50, 0.0)], "GeoID string, Pop1 long, LandAcres double")
    refresh = dims.dim_location_refresh([s1, s2], pop)
    got = {(r["Block"], r["ZipCode"]): r["PopulationDensity"] for r in refresh.collect()}
    assert got == {("B1", "11101"): 50.0, ("B2", "11101"): None, ("B1", "11102"): 50.0}  # B3: no population
    empty = refresh.limit(0)
    assert rows(dims.dim_location_increment([s1, s2], pop, empty)) == rows(refresh)
    inc = dims.dim_location_increment([s2], pop, dims.dim_location_refresh([s1], pop))
    assert rows(inc, "Block", "ZipCode") == [("B1", "11102")]


def test_dim_date_increment_after_existing(spark):
    src = spark.createDataFrame([(dt.datetime(2023, 12, 30, 5),), (dt.datetime(2024, 1, 2, 23),),
                                 (dt.datetime(2024, 1, 2, 1),)], "ts timestamp_ntz")
    prior = dims.date_rows(spark.createDataFrame([(dt.date(2023, 12, 31),)], "d date"))
    got = dims.dim_date_increment([(src, "ts")], prior)
    assert rows(got, "DateID", "Week", "DayOfWeek", "IsWeekend") == [("2024-01-02", 0, "Tuesday", 0)]
    full = dims.dim_date_increment([(src, "ts")])
    assert full.count() == 2


def test_location_load_rejects_a_block_with_two_densities(spark):
    base = ["1", "Q", "N1", "Nbhd", "11101", "T1", "G1", "B1", "GB1", "Residential"]
    ddl = "GeoID string, Pop1 long, LandAcres double"
    same = spark.createDataFrame([("B1", 100, 2.0), ("B1", 100, 2.0)], ddl)
    assert dims.dim_location_refresh([_stage(spark, [base])], same).count() == 1
    two = spark.createDataFrame([("B1", 100, 2.0), ("B1", 50, 10.0)], ddl)
    with pytest.raises(Exception, match="several densities"):
        dims.dim_location_refresh([_stage(spark, [base])], two).collect()


def test_fact_by_hand(spark):
    """Three blocks: B1 with visits and an open restaurant, B2 with neither, B3 with a visit and no request."""
    t = dt.datetime(2024, 1, 5, 9, 30)
    mk = spark.createDataFrame
    x = FactInputs(
        requests=mk([("r1", t, dt.datetime(2024, 1, 5, 11, 30), "Rodent", None), ("r2", t, dt.datetime(2024, 1, 5, 15, 30), "Rodent", None),
                     ("r3", t, None, "Rodent", None), ("r4", t, t, "Other", None)],
                    "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, complaint_type string, descriptor string"),
        request_locations=mk([("r1", "B1", "C"), ("r2", "B1", "C"), ("r3", "B2", "C"), ("r4", "B1", "C")],
                             "unique_key string, block_bctcb2020 string, locationType string"),
        inspection_locations=mk([("c1", "B1", "C"), ("c2", "B1", "C"), ("c3", "B3", "C"), ("c4", "B9", "C")],
                                "camis string, block_bctcb2020 string, locationType string"),
        inspections=mk([("c1", "V", "it", t), ("c2", "V", "it", t), ("c2", "W", "it", t), ("c3", "V", "it", t)],
                       "camis string, violation_code string, cuisine_description string, inspection_date timestamp_ntz"),
        open_locations=mk([("o1", "B1", "C"), ("o2", "B1", "C")], "objectid string, block_bctcb2020 string, locationType string"),
        applications=mk([("o1", "both", "yes", "yes", "no"), ("o2", "both", "no", "no", "no")],
                        "objectid string, seating_interest_sidewalk string, qualify_alcohol string, "
                        "approved_for_roadway_seating string, approved_for_sidewalk_seating string"),
        dim_location=mk([("L1", "B1", "C"), ("L2", "B2", "C")], "LocationID string, Block string, LocationType string"),
        dim_complaint=mk([("K1", "Rodent", "N/A"), ("K0", "Not Interested", "N/A")],
                         "ComplaintID string, ComplaintType string, ComplaintDescription string"),
        dim_violation=mk([("V1", "V", "it"), ("V0", "None", "None")],
                         "RestaurantViolationID string, ViolationCode string, Cuisine string"),
        dim_open=mk([("O1", "both", 1), ("O0", "none", 0)], "OpenRestaurantID string, OpenRestaurantType string, IsQualifyAlcohol long"),
        dim_date=mk([("2024-01-05",)], "DateID string"), dim_time=mk([(9, "09")], "Hour long, TimeID string"))
    got = rows(fact_preaggregated(x), "LocationID", "RestaurantViolationID", "OpenRestaurantID", "ComplaintID",
               "NumberOfComplaints", "NumberOfViolations", "AvgResolveTimeForComplaints")
    assert got == sorted([
        ("L1", "V1", "O1", "K1", 2, 2, 4.0),   # r1 and r2, two and six hours open, visits c1 and c2
        ("L1", "V1", "O0", "K1", 2, 2, 4.0),   # o2 is not approved: the default member
        ("L2", "V0", "O0", "K1", 1, 0, 0.0),   # nothing known of B2, and r3 is still open
        (None, "V1", "O0", "K0", 0, 1, 0.0),   # c3's visit, without a request; c4 was never seen, 'None' has no date
    ], key=lambda r: tuple(str(v) for v in r))


def test_fact_scans_each_source_once(spark):
    from civic_mart.plans.pipeline import Mart
    mart = Mart(spark, SF_SMALL)
    scans = [line for line in fact_preaggregated(mart.fact_inputs())._jdf.queryExecution().executedPlan().toString().split("\n")
             if "FileScan" in line]
    assert sum("events.parquet" in line for line in scans) == 1
    # 'visits' is read twice here, without a store between: two scans; a stored one leaves none
    kept = fact_preaggregated(mart.fact_inputs(), mart._keep)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "lineitem.parquet" in line for line in kept.split("\n")) == 0


def test_fact_deals_rows_to_as_many_tasks_as_they_need(spark, monkeypatch):
    """Requests and visits go to more tasks as there are more of them (it was a fixed number)."""
    from civic_mart.operators import facts
    from civic_mart.plans.pipeline import Mart
    inputs = Mart(spark, SF_SMALL).fact_inputs()
    want = rows(fact_preaggregated(inputs))
    monkeypatch.setattr(facts, "ROWS_PER_TASK", 7)
    fact = fact_preaggregated(inputs)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    n = inputs.request_locations.count() // 7
    dealt = [int(k) for k in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert n > 8 and dealt.count(n) >= 3 and min(dealt) > 8
    assert rows(fact) == want


def test_visits_are_joined_without_being_made_distinct(spark):
    """Only restaurants are counted, so repeated visits need no shuffle of all inspections, and change nothing."""
    from dataclasses import replace

    from civic_mart.plans.pipeline import Mart
    x = Mart(spark, SF_SMALL).fact_inputs()
    kept = []

    def keep(df):
        kept.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    twice = rows(fact_preaggregated(replace(x, inspections=x.inspections.unionAll(x.inspections)), keep))
    assert "Aggregate" not in kept[0]
    assert rows(fact_preaggregated(x)) == twice


def test_staging_and_dimension_jobs_run_side_by_side(spark, monkeypatch):
    """Jobs that do not depend on each other wait for each other here: one after the other they would never end."""
    from threading import Barrier

    from civic_mart.plans.pipeline import Mart
    three, five = Barrier(3, timeout=20), Barrier(5, timeout=20)

    def run(wait, name):
        wait.wait()
        return spark.range(1).withColumn("name", F.lit(name))
    monkeypatch.setattr(Mart, "layers", [])
    monkeypatch.setattr(Mart, "stored_stage", lambda self, name: run(three, name))
    monkeypatch.setattr(Mart, "stored", lambda self, name: run(five, name))
    x = Mart(spark, SF_SMALL).fact_inputs()
    assert [d.first()["name"] for d in (x.request_locations, x.open_locations, x.dim_location, x.dim_date)] == [
        "requests", "applications", "dim_location", "dim_date"]


def test_location_ids_are_not_shuffled_with_requests(spark):
    """The fact's requests meet their location ids where they lie by (block, type) anyway."""
    from civic_mart.plans.pipeline import Mart
    from conftest import SF_SMALL
    plan = Mart(spark, SF_SMALL).fact()._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "RepartitionByExpression" in line and "unique_key" in line]
    assert dealt and not any("LocationID" in plan[i] for i in dealt)
    group = next(line for line in plan if "Aggregate [" in line and "ComplaintID" in line and "_b#" in line)
    assert "LocationID" not in group


def test_locations_of_one_block_and_type(spark):
    """Two location ids of a (block, type), one listed twice: a fact row for each id, with the same measures."""
    from dataclasses import replace

    from civic_mart.operators.facts import fact_preaggregated
    from civic_mart.plans.pipeline import Mart
    from conftest import SF_SMALL
    x = Mart(spark, SF_SMALL).fact_inputs()
    second = x.dim_location.withColumn("LocationID", F.concat(F.lit("2-"), "LocationID"))
    both = replace(x, dim_location=x.dim_location.unionByName(x.dim_location).unionByName(second))
    cols = ["RestaurantViolationID", "OpenRestaurantID", "DateID", "TimeID", "ComplaintID", "NumberOfComplaints",
            "NumberOfViolations", "AvgResolveTimeForComplaints"]
    once = rows(fact_preaggregated(x).select("LocationID", *cols))
    got = rows(fact_preaggregated(both).select("LocationID", *cols))
    known = [r for r in once if r[0] is not None]
    assert known and sorted(map(str, got)) == sorted(map(str, once + [(f"2-{r[0]}", *r[1:]) for r in known]))
