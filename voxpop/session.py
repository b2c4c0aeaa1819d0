"""Spark session and shared-storage helpers.

The library never picks a machine-local folder on a cluster: intermediate
tables go under the checkpoint directory the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting
(tests, laptops) gets a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "voxpop",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("VOXPOP_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run, to pass to the builder.

    The largest shuffle here (order lines joined to orders) moves at most
    the scanned columns of the input, so ``input_bytes / target_bytes``
    initial shuffle partitions keep each reducer near ``target_bytes``
    (at least two per core).  AQE then coalesces
    small partitions toward the same advisory size and splits a skewed one
    (a partition over 4x the target and 5x the median).  Scan splits use
    the same target, so a task's input fits in executor memory."""
    parts = max(2 * total_cores, -(-int(input_bytes) // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and derived tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Sets a
    scratch folder only when it is unset *and* the session is local.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="voxpop-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
