"""Session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "meridian") -> SparkSession:
    """A session tuned for this library (AQE on, UI off, UTC, Arrow).

    On a cluster pass ``master=None`` so the submitter's settings win; the
    shuffle-partition count is then left to the cluster configuration too.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("MERIDIAN_DRIVER_MEMORY", "16g"),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return the directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used.  Only a local-mode session without that setting (tests, the
    bench) gets a fresh scratch folder of its own.  A cluster session without
    the setting is an error: a machine-local folder does not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:                 # the cluster vouches that this folder is shared
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: iterative operators need a shared "
            "checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="meridian-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
