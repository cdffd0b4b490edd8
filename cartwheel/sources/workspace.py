"""Folders for intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session without one falls back to a new folder."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} is not set")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read back: several branches then read narrow columns, and lost executors cost no reparse."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def make_folder(spark: SparkSession, path: str) -> None:
    """A stream can read a folder only once it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
