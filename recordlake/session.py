"""Spark session and shared-folder helpers.

Everything in the library takes a ``SparkSession``; this module only builds one for
local runs and tests, and resolves the shared folder used for lineage cuts and
scratch output (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; a cluster session built elsewhere keeps its own values.
SCALE_CONF = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed join partitions,
    # switch to a broadcast join when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # size-checked broadcast: Catalyst broadcasts a join side only under this estimate,
    # otherwise it keeps the sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # parquet size estimates are compressed bytes; scale them so the check above compares
    # something closer to the in-memory size of a broadcast relation
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "recordlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local run (one process, as in tests) gets a fresh local
    folder; on a cluster that is an error, as executors don't share machine-local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="recordlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder (one per call, never reused)."""
    base = shared_dir(spark)
    return f"{base}/recordlake/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the rare plain-Python file operation in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
