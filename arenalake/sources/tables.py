"""Parquet tables: layered paths, static and incremental reads, refreshed and clustered writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from arenalake.sources.versions import commit, new_part, newest, read_part


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Static scan of the table's newest version; pass the declared schema to skip footer inference.

    Tables that streams append to have no manifests and are read as they are.
    """
    path = table_path(root, layer, table)
    version = newest(spark, path)
    if version is not None:
        return read_part(spark, path, version.parts[-1], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def stream_table(spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType) -> DataFrame:
    """Incremental scan of a table another stream appends to."""
    return spark.readStream.schema(schema).parquet(table_path(root, layer, table))


def clustered(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by key so that file statistics can skip row groups.

    Range bounds are sampled, and a key too frequent for one range spreads no further than
    its other clustering columns allow; list them all in `keys`.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def refresh_table(df: DataFrame, root: str, layer: str, table: str, cluster_by: list[str] | None = None) -> str:
    """Fully recompute a materialized table.

    The old version stays readable until the new one is written whole, also where the write fails.
    """
    spark, path = df.sparkSession, table_path(root, layer, table)
    before = newest(spark, path)
    part = new_part(clustered(df, cluster_by) if cluster_by else df, path, (before.number if before else 0) + 1)
    commit(spark, path, before, [part])
    return path


def save_bucketed(
    df: DataFrame, name: str, keys: list[str], buckets: int, sort: list[str] | None = None, path: str | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Save as a bucketed catalog table: joins of two such tables on `keys` need no shuffle, nor do aggregates by them.

    Rows are dealt to the buckets before they are written, so there is one file per bucket; `dealt`: they were, by the
    same keys and number, before a function Spark cannot look into. With `path` the files lie there and outlive the
    catalog entry.
    """
    writer = (df if dealt else df.repartition(buckets, *keys)).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*(sort or keys))
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a lazy frame to SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in `path`; none if there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()] if fs.exists(at) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
