"""Every registered query against its DuckDB oracle (sf0.001), plus plan checks."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import compare, duck  # noqa: E402

# the training-data queries have their own tests
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "RodentIssueID" in df.columns


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_increment_watermark_reaches_parquet_scan(spark):
    df = QUERIES["increment_requests"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in text  # the ledger watermark is pushed to the events scan


def test_a_file_that_arrives_in_the_session_is_seen(spark, tmp_path):
    """Stored staging tables belong to a state of the source folder."""
    import shutil

    from civic_mart.plans.pipeline import Mart
    for name in os.listdir(SF_SMALL):
        if name.split(".")[0] in ("region", "nation", "customer", "supplier"):
            shutil.copy(f"{SF_SMALL}/{name}", tmp_path / name)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.where("event_id % 2 = 0").write.parquet(f"{tmp_path}/events.parquet")
    first = Mart(spark, str(tmp_path)).stored_stage("requests").count()
    assert Mart(spark, str(tmp_path)).stored_stage("requests").count() == first
    events.where("event_id % 2 = 1").write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert Mart(spark, str(tmp_path)).stored_stage("requests").count() > first


def test_checkpoint_folder_is_asked_for_on_a_cluster(monkeypatch):
    from civic_mart.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_stored_jobs_end_like_one_snapshot(spark):
    """A snapshot and an increment leave the same locations as one snapshot of everything."""
    from civic_mart.plans import jobs
    from civic_mart.sources import sinks
    one, two = sinks.scratch_path(spark, "jobs"), sinks.scratch_path(spark, "jobs")
    for root, runs in ((one, [(jobs.SECOND_RUN_UTC, "snapshot")]),
                       (two, [(jobs.FIRST_RUN_UTC, "snapshot"), (jobs.SECOND_RUN_UTC, "increment")])):
        for run_utc, mode in runs:
            mart = jobs.as_of(spark, SF_SMALL, run_utc)
            jobs.run_geocode(mart, root, mode)
            jobs.run_dim_location(mart, root, mode)
    places = [sorted(map(str, jobs.read_staged(spark, r, "dim_location").collect())) for r in (one, two)]
    assert places[0] == places[1] and places[0]
    assert jobs.read_ledger(spark, one).count() == 4 and jobs.read_ledger(spark, two).count() == 8


def test_applications_are_staged_beside_the_inspections(spark, tmp_dir, monkeypatch):
    """The two wait for each other here; applications that fail leave the inspections uncommitted."""
    from threading import Barrier

    from civic_mart import schemas
    from civic_mart.plans import jobs
    from civic_mart.plans.pipeline import JOB_311, JOB_INS
    both = Barrier(2, timeout=60)

    def empty(table):
        return spark.createDataFrame([], schemas.struct(jobs.TABLES[table][1]))

    def meet(table, fail=False):
        both.wait()
        if fail:
            raise RuntimeError("no applications")
        return empty(table)
    monkeypatch.setattr(jobs.Mart, "stage_requests", lambda self, src: empty("requests"))
    monkeypatch.setattr(jobs.Mart, "stage_inspections", lambda self, src: meet("inspections"))
    monkeypatch.setattr(jobs.Mart, "stage_applications", lambda self: meet("applications", fail=True))
    mart = jobs.as_of(spark, SF_SMALL, jobs.SECOND_RUN_UTC)
    with pytest.raises(RuntimeError, match="no applications"):
        jobs.run_geocode(mart, tmp_dir, "snapshot")
    assert {r["job_name"] for r in jobs.read_ledger(spark, tmp_dir).collect()} == {JOB_311}
    monkeypatch.setattr(jobs.Mart, "stage_applications", lambda self: meet("applications"))
    jobs.run_geocode(mart, tmp_dir, "snapshot")
    assert {r["job_name"] for r in jobs.read_ledger(spark, tmp_dir).collect()} == {JOB_311, JOB_INS}
