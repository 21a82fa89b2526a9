"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession, functions as F


# Shuffle data per task. Adaptive execution joins smaller partitions, but does not
# split larger ones, so the number of partitions has to fit the largest shuffle.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


# Compressed shuffle data that adaptive execution joins for a task. Its rows take about five times the space while they
# are sorted, and a join sorts two sides.
JOINED_PARTITION_BYTES = 16 * 1024 * 1024
_JOINED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def keep_sorts_in_memory(spark: SparkSession) -> None:
    """Smaller joined partitions, so that tasks need not spill, unless the session has a size of its own."""
    if spark.conf.get(_JOINED, None) is None:
        spark.conf.set(_JOINED, JOINED_PARTITION_BYTES)


# Tasks that list the folders of a table. Spark's 10,000 make one of each folder, and starting it takes longer than listing.
LISTING_TASKS = 64
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_in_few_tasks(spark: SparkSession) -> None:
    """Many folders a task when they are listed, unless the session has a number of its own."""
    if spark.conf.get(_LISTING, None) is None:
        spark.conf.set(_LISTING, LISTING_TASKS)


def build_session(
    app_name: str = "starfold", master: str | None = None, largest_shuffle_bytes: int = 0, **conf: str
) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` is added last.

    `largest_shuffle_bytes` is about the size of the largest fact's staged columns.
    """
    partitions = max(200, -(-largest_shuffle_bytes // SHUFFLE_PARTITION_BYTES))
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="starfold-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def empty_folder(spark: SparkSession, path: str) -> None:
    """Free the space of a table that is no longer needed; reading it fails after that."""
    spark.range(0, 0, 1, 1).select(F.lit("").alias("value")).write.mode("overwrite").text(path)
