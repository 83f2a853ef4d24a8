"""Where written intermediates live: the shared folder named by `spark.checkpoint.dir`."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A local session may leave the setting unset and gets a temporary folder; on a cluster
    an unset folder is an error because executors would not share it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="arenalake-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block give up their shuffle files when they end, not when the driver collects its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back, cutting its lineage and giving it exact statistics."""
    path = new_dir(df.sparkSession, label)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
