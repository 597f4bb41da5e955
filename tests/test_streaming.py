"""Structured Streaming increment: equals the batch staging; a re-run with no new files adds nothing."""

from __future__ import annotations

from civic_mart.plans.pipeline import Mart
from civic_mart.sources import sinks
from civic_mart.streaming.incremental import run_request_geocode
from conftest import SF_SMALL, rows


def test_stream_equals_batch_and_is_incremental(spark):
    sink = sinks.scratch_path(spark, "t-stream-sink")
    ckpt = sinks.scratch_path(spark, "t-stream-ckpt")
    first = run_request_geocode(spark, SF_SMALL, sink, ckpt)
    batch = Mart(spark, SF_SMALL).stage_requests()
    assert rows(first) == rows(batch)
    n_epochs = spark.read.parquet(sink).select("epoch").distinct().count()
    again = run_request_geocode(spark, SF_SMALL, sink, ckpt)       # nothing new landed
    assert again.count() == first.count()
    assert spark.read.parquet(sink).select("epoch").distinct().count() == n_epochs
