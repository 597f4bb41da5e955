"""The partitioned page source and keyset paging: failing and short pages, resuming, rows that arrive."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from civic_mart.sources import paged_source, paging
from conftest import rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


def plan_of(spark, counts, size=10):
    return paging.page_plan(spark.createDataFrame(counts, "k string, n bigint"), "k", "n", size)


def body(key, page, offset, size, total):
    return json.dumps([{"id": f"{key}{i}"} for i in range(offset, min(offset + size, total))])


def test_ranges_cover_the_plan_without_landed_pages(spark):
    plan = plan_of(spark, [("a", 250), ("b", 5), ("c", 0)])
    assert rows(paged_source.page_ranges(plan, size=20), "key", "first", "last") == [("a", 0, 19), ("a", 20, 24), ("b", 0, 0)]
    landed = spark.createDataFrame([("a", 3), ("a", 4), ("a", 20), ("b", 0), ("b", 0)], "key string, page bigint")
    assert rows(paged_source.page_ranges(plan, landed, 20), "key", "first", "last") == [
        ("a", 0, 2), ("a", 21, 24), ("a", 5, 19)]


def test_a_page_that_fails_is_tried_again(spark, tmp_path):
    plan, marks = plan_of(spark, [("a", 95), ("b", 7)]), str(tmp_path)

    def flaky(key, page, offset, size):
        import os
        if page % 3 == 1 and not os.path.exists(f"{marks}/{key}{page}"):
            open(f"{marks}/{key}{page}", "w").close()
            raise OSError("connection reset")
        return body(key, page, offset, size, {"a": 95, "b": 7}[key])

    got = paged_source.read_pages(plan, flaky, pause=0.01, size=4).collect()
    assert sorted((r.key, r.page) for r in got) == [("a", i) for i in range(10)] + [("b", 0)]
    assert sum(len(json.loads(r.body)) for r in got) == 102


@pytest.mark.parametrize("fault,said", [("short", "records, planned"), ("broken", "JSONDecodeError"), ("down", "OSError")])
def test_a_page_that_stays_wrong_fails_the_job(spark, fault, said):
    def wrong(key, page, offset, size):
        if page != 2:
            return body(key, page, offset, size, 40)
        if fault == "down":
            raise OSError("no route")
        return "[{" if fault == "broken" else body(key, page, offset, size - 1, 40)

    with pytest.raises(Exception, match=said):
        paged_source.read_pages(plan_of(spark, [("a", 40)]), wrong, attempts=2, pause=0.01).collect()


def test_a_second_job_reads_only_what_is_missing(spark, tmp_path):
    plan, asked = plan_of(spark, [("a", 60)]), str(tmp_path / "asked")
    (tmp_path / "asked").mkdir()
    landed = spark.createDataFrame([("a", 0), ("a", 1), ("a", 4)], "key string, page bigint")

    def fetch(key, page, offset, size):
        open(f"{asked}/{page}", "w").close()
        return body(key, page, offset, size, 60)

    got = paged_source.read_pages(plan, fetch, landed, size=3).collect()
    assert sorted(r.page for r in got) == [2, 3, 5] == sorted(int(p.name) for p in (tmp_path / "asked").iterdir())
    whole = spark.createDataFrame([("a", i) for i in range(6)], "key string, page bigint")
    assert paged_source.read_pages(plan, fetch, whole).collect() == []


def test_landed_pages_are_fetched_from_their_files(spark, tmp_path):
    pages = spark.createDataFrame([("é/x", 0, '[{"a": 1}]'), ("é/x", 1, "[]"), ("X", 0, '["é"]')], "key string, page bigint, body string")
    root = str(tmp_path / "landed")
    assert rows(paged_source.land_pages(pages, root)) == sorted([("é/x", 0), ("é/x", 1), ("X", 0)])
    fetch = paged_source.landed_fetcher(root)
    assert [fetch("é/x", 0, 0, 1), fetch("é/x", 1, 1, 1), fetch("X", 0, 0, 1)] == ['[{"a": 1}]', "[]", '["é"]']
    with pytest.raises(FileNotFoundError):
        fetch("X", 5, 0, 1)


def test_rows_that_arrive_between_two_page_reads(spark):
    """Offset pages shift and lose rows; key ranges read every old row once."""
    old = spark.range(0, 1000, 7).select(F.lit("a").alias("g"), F.col("id").alias("k"))
    plan = paging.keyset_plan(old, "g", "k", 20).collect()
    new = old.unionByName(spark.createDataFrame([("a", i) for i in range(1, 120, 7)] + [("a", 5000)], "g string, k bigint"))
    read = []
    for i, p in enumerate(sorted(plan, key=lambda p: p.page)):
        source = old if i < 3 else new  # the rows arrive after the third page
        read += [r.k for r in source.where(paging.in_page(F.col("k"), F.lit(p.low), F.lit(p.high))).collect()]
    assert len(read) == len(set(read)) and set(range(0, 1000, 7)) <= set(read) and 5000 in read
    # the same with offsets: rows come twice
    by_offset = [r.k for i in range(len(plan)) for r in
                 (old if i < 3 else new).orderBy("k").offset(20 * i).limit(20).collect()]
    assert len(by_offset) != len(set(by_offset))
