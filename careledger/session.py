"""SparkSession settings used by tests and the benchmark."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


# Settings for the 100 TB target (1000 executors).  The run date window keeps
# the fact side of most joins small, so runtime filters and AQE's runtime
# broadcast matter more than static sizing; shuffles start wide and AQE
# coalesces them to ~256 MB partitions and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply ``CLUSTER_CONF`` (runtime SQL settings) to a cluster session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "careledger") -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset in local mode (tests).

    On a cluster every executor would write to a disk of its own, so an unset folder is an error there."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is unset: master {master} needs a folder that all executors share")
    path = tempfile.mkdtemp(prefix="careledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path
