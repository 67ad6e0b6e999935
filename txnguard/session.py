"""Session construction and the shared scratch area.

Every job that cuts lineage or lands intermediate data writes below the
directory named by ``spark.checkpoint.dir``. On a cluster that setting points at
shared storage and is read, never overridden. Only when it is unset under a ``local``
master (tests, the smoke session) do we create one of our own; on a cluster an
unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(
    master: str | None = None,
    app: str = "txnguard",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    hive: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    ``master`` is left to the launcher when None, as on a cluster. ``hive``
    makes the session catalog the persistent one (the jobs' default).
    """
    b = SparkSession.builder.appName(app)
    if hive:
        b = b.enableHiveSupport()
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_STREAM_CKPT_KEY = "spark.sql.streaming.checkpointLocation"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, creating a local one only if unset.

    Also gives streaming queries a session default checkpoint root under the
    same shared folder when none is configured (each query still names its own).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        _default_stream_checkpoints(spark, current)
        return current
    configured = sc.getConf().get(_CHECKPOINT_KEY, None) or spark.conf.get(
        _CHECKPOINT_KEY, None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        # One process, one machine: tests and local runs.
        configured = tempfile.mkdtemp(prefix="txnguard-ckpt-")
    sc.setCheckpointDir(configured)
    current = sc.getCheckpointDir() or configured
    _default_stream_checkpoints(spark, current)
    return current


def _default_stream_checkpoints(spark: SparkSession, base: str) -> None:
    if not spark.conf.get(_STREAM_CKPT_KEY, None):
        spark.conf.set(_STREAM_CKPT_KEY, os.path.join(base.rstrip("/"), "streaming"))


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared scratch area for one job."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "txnguard", f"{tag}-{uuid.uuid4().hex[:12]}")
