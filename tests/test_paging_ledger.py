"""Page plan, distributed positions, page fetch; ledger and load windows; REQUIRED gate."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from civic_mart.operators import ledger, quality
from civic_mart.sources import paging
from conftest import rows


@pytest.mark.parametrize("n,pages", [(0, 0), (1, 1), (999, 1), (1000, 1), (1001, 2), (2500, 3)])
def test_page_plan_counts(spark, n, pages):
    plan = paging.page_plan(spark.createDataFrame([("k", n)], "key string, n long"), "key", "n")
    got = plan.collect()
    assert len(got) == pages
    assert [r["offset"] for r in got] == [i * 1000 for i in range(pages)]
    assert pages * 1000 >= n


def test_positions_equal_row_number_under_skew(spark):
    hot = [("hot", i) for i in range(3000)]
    cold = [(f"c{j}", i) for j in range(20) for i in range(j + 1)]
    df = spark.createDataFrame(hot + cold, "g string, o long").repartition(5)
    got = paging.positions(df, ["g"], ["o"], partitions=6)
    ref = df.withColumn("_pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert rows(got, "g", "o", "_pos") == rows(ref, "g", "o", "_pos")


def test_pages_are_checked_against_the_plan(spark):
    plan = spark.createDataFrame([("x", p, p * 2, 2, 5) for p in range(3)], paging.PAGE_PLAN_SCHEMA)
    raw = spark.createDataFrame([("x", i // 2, str(i)) for i in range(5)], "key string, page long, a string")
    pages = paging.page_bodies(raw, ["key", "page"], "a")
    schema = spark.createDataFrame([], "a string").schema
    got = paging.page_records(paging.checked_pages(plan, pages), schema)
    assert rows(got, "page", "a") == [(0, "0"), (0, "1"), (1, "2"), (1, "3"), (2, "4")]
    for broken, message in ((pages.where("page <> 1"), "no such page"),
                            (paging.page_bodies(raw.where("a <> '4'").unionByName(raw.where("a = '0'").selectExpr(
                                "key", "2L AS page", "a")).unionByName(raw.where("a = '1'").selectExpr(
                                    "key", "2L AS page", "a")), ["key", "page"], "a"), "records: 2")):
        with pytest.raises(Exception, match=message):
            paging.page_records(paging.checked_pages(plan, broken), schema).collect()


def test_fetched_pages_that_fail_fail_the_job(spark):
    def fetch(key, page, offset, size):
        if page == 1:
            raise OSError("no route")
        return "[]" if page > 2 else '[{"a": "1"}, {"a": "2"}]'

    plan = spark.createDataFrame([("x", p, p * 2, 2, 6) for p in range(3)], paging.PAGE_PLAN_SCHEMA)
    fetched = paging.fetch_pages(plan, fetch, tasks=2)
    assert [(e["page"], e["error"]) for e in paging.page_errors(fetched).collect()] == [(1, "OSError: no route")]
    with pytest.raises(Exception, match="no route"):
        paging.checked_pages(plan, fetched).collect()
    assert paging.checked_pages(plan.where("page <> 1"), fetched).count() == 2


def test_watermark_defaults_and_max(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    empty = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    assert spark.range(1).select(ledger.watermark(empty, "a")).first()[0] == ts("1900-01-01 00:00:00")
    led = spark.createDataFrame([("a", ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00")),
                                 ("a", ts("2024-01-05 00:00:00"), ts("2024-01-06 00:00:00")),
                                 ("b", ts("2030-01-01 00:00:00"), ts("2030-01-01 00:00:00"))], ledger.LEDGER_SCHEMA)
    assert spark.range(1).select(ledger.watermark(led, "a")).first()[0] == ts("2024-01-05 00:00:00")
    got = {r[0]: r[1] for r in ledger.watermarks(led, ["a", "b", "c"]).collect()}
    assert got == {"a": ts("2024-01-05 00:00:00"), "b": ts("2030-01-01 00:00:00"), "c": ts("1900-01-01 00:00:00")}


def test_ledger_row_rejects_null(spark):
    ok = ledger.ledger_row(spark, "j", F.lit("2024-01-01 00:00:00"), ledger.local_now("2024-02-01 12:00:00")).first()
    assert ok["execution_date"] == dt.datetime(2024, 2, 1, 7, 0)
    with pytest.raises(Exception):
        ledger.ledger_row(spark, "j", F.lit(None), F.lit("2024-01-01 00:00:00")).collect()


def test_extract_windows_and_modes():
    run = dt.datetime(2024, 1, 20, 3, 30)  # 2024-01-19 22:30 in New York
    assert ledger.extract_window("increment", run) == ("2024-01-18 00:00:00", "2024-01-19 00:00:00")
    assert ledger.extract_window("increment", run, lag_days=1) == ("2024-01-17 00:00:00", "2024-01-18 00:00:00")
    assert ledger.extract_window("snapshot", run) == ("2016-01-01 00:00:00", "2024-01-19 00:00:00")
    summer = dt.datetime(2024, 7, 1, 3, 30)  # EDT: still 30 June in New York
    assert ledger.extract_window("increment", summer)[1] == "2024-06-30 00:00:00"
    assert ledger.write_mode("snapshot") == "overwrite" and ledger.write_mode("increment") == "append"
    with pytest.raises(ValueError):
        ledger.extract_window("daily", run)


def test_required_gate(spark):
    df = spark.createDataFrame([("1", 1.0), (None, 2.0), ("3", None), (None, None)], "k string, v double")
    valid, rejected = quality.split_required(df, ["k", "v"])
    assert valid.count() == 1
    assert rows(rejected, "missing") == [("k",), ("k,v",), ("v",)]
    nan = spark.createDataFrame([("1", float("nan"))], "k string, v double")
    assert quality.split_required(nan, ["k", "v"])[0].count() == 1  # NaN is not NULL
    with pytest.raises(Exception):
        quality.assert_required(df, ["k"]).collect()


def test_boundary_variants_share_their_sources(spark, monkeypatch):
    """The late rows are made once, and neither variant waits for the other."""
    import threading

    from civic_mart.plans import jobs
    from conftest import SF_SMALL
    made, ran, both = [], [], threading.Barrier(2)

    def run(mart, root, mode, variant):
        ran.append((root, mode, variant))
        both.wait(timeout=60)

    monkeypatch.setattr(jobs, "boundary_sources", lambda *a, _of=jobs.boundary_sources: made.append(1) or _of(*a))
    monkeypatch.setattr(jobs, "run_geocode", run)
    assert jobs.boundary_rows(spark, SF_SMALL).count() == 0 and made == [1]
    assert sorted(r[1:] for r in ran) == [(m, v) for m in ("increment", "snapshot") for v in ("literal", "safe")]
    assert len({r[0] for r in ran}) == 2
