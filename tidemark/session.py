"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of the files that rebalanced writes aim for (128 MB).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else a new local one.

    The fallback serves single-machine tests only.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        ensure_checkpoint_dir(spark)
        named = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return named.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder; frames read from it are gone."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(root, True)


@contextmanager
def shuffles_for(spark: SparkSession, scanned_bytes: int) -> Iterator[int]:
    """Enough shuffle partitions for an input of this size, as long as the block runs.

    The setting only grows: AQE merges small partitions, but it cannot cut a number that is too
    low for a large table. Scanned Parquet is taken to be three times as large in a shuffle.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = -(-3 * scanned_bytes // SHUFFLE_PARTITION_BYTES)
    sized = max(int(before), min(needed, MAX_SHUFFLE_PARTITIONS))
    spark.conf.set(key, str(sized))
    try:
        yield sized
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable: a folder is set only where the session has none.

    A folder of this machine is enough for a local master only; on a cluster it is an error, as the
    executors would write to disks of their own and the tables would be read back empty.
    """
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(named)
