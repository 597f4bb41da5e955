"""Incremental geocode as Structured Streaming.

The batch jobs keep a high-watermark ledger to know which rows are new.  With
a file source, Structured Streaming keeps that state itself: its checkpoint
records which files were processed, and ``trigger(availableNow=True)`` drains
everything that landed since the last run and stops, which is the daily
increment.  Each micro-batch goes through the same operators as the batch job
(``Mart.stage_requests``) and is written to its own ``epoch=<id>`` folder in
overwrite mode, so a replayed batch (after a failure) replaces its output
instead of duplicating it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from civic_mart.plans.model import DRIVER_SCHEMAS
from civic_mart.plans.pipeline import Mart
from civic_mart.sources import sinks


def start_request_geocode(spark: SparkSession, sf_dir: str, sink: str, checkpoint: str,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream the landed request (event) files of ``sf_dir`` through the geocode into ``sink``."""
    reader = (spark.readStream.schema(DRIVER_SCHEMAS["events"]).option("pathGlobFilter", "events*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(sf_dir)

    def process(batch: DataFrame, epoch_id: int) -> None:
        staged = Mart(spark, sf_dir, overrides={"events": batch}).stage_requests()
        staged.write.mode("overwrite").parquet(os.path.join(sink, f"epoch={epoch_id}"))

    return (events.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_request_geocode(spark: SparkSession, sf_dir: str, sink: str | None = None,
                        checkpoint: str | None = None) -> DataFrame:
    """Drain the available request files once and return everything the stream wrote."""
    sink = sink or sinks.scratch_path(spark, "stream-stage-requests")
    checkpoint = checkpoint or sinks.scratch_path(spark, "stream-checkpoint")
    q = start_request_geocode(spark, sf_dir, sink, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink).drop("epoch")
