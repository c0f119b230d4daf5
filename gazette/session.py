"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle settings for the largest exchange a job will make.

    Adaptive execution merges small partitions afterwards, so the initial
    number only has to be high enough for one partition to fit a task.
    """
    partitions = max(2 * cores, math.ceil(shuffle_bytes / TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def build_session(
    app: str = "gazette", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # recording the Python line of every column doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else one below the warehouse.

    A cluster must name the folder, as its warehouse may be a disk of the driver.
    The session's checkpoints go there too, if it has no folder for them yet.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
