"""Session helpers.

Nothing here changes how queries are planned; it only gives tests and the bench a
local session with the settings a cluster job would also carry (AQE on, UTC
session zone so zone-less timestamps are never shifted, UI off).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "civic_mart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CIVIC_DRIVER_MEMORY", "8g"))
    )
    if os.environ.get("CIVIC_EVENT_LOG"):
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir",
                                                                          os.environ["CIVIC_EVENT_LOG"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests) a fresh scratch folder
    is created: on a cluster a machine's own folder would be lost to the other machines.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="civic-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path
