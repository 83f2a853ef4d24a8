"""CSV sources: explicit all-string schemas for production, inference for exploration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenalake.schemas import RAW_FOLDERS, raw_schema

# Reader options of the landed files and the record source written beside each row.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
RECORD_SOURCE = "Kaggle"


def landing_glob(root: str, table: str, pattern: str = "*.csv.gz") -> str:
    """Files of one source below the landing root."""
    return f"{root.rstrip('/')}/{RAW_FOLDERS[table]}/{pattern}"


def with_audit(df: DataFrame, record_source: str = RECORD_SOURCE) -> DataFrame:
    """Add load time, source file name and record source."""
    return df.select(
        "*",
        F.current_timestamp().alias("ldts"),
        F.col("_metadata.file_name").alias("file_name"),
        F.lit(record_source).alias("rsrc"),
    )


def _options(strict_header: bool, extra: dict[str, str] | None) -> dict[str, str]:
    # CSV columns bind by position. With enforceSchema off Spark checks the header names of
    # every file and fails on a reordered one instead of mixing columns up.
    return {**CSV_OPTIONS, "enforceSchema": str(not strict_header).lower(), **(extra or {})}


def read_stream(
    spark: SparkSession,
    glob: str,
    schema: T.StructType,
    record_source: str = RECORD_SOURCE,
    strict_header: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Incremental scan: each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).options(**_options(strict_header, options))
    return with_audit(reader.csv(glob), record_source)


def read_batch(
    spark: SparkSession,
    glob: str,
    schema: T.StructType,
    record_source: str,
    strict_header: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One-off scan with the load time as a zone-less timestamp, for exploration."""
    reader = spark.read.schema(schema).options(**_options(strict_header, options))
    rows = with_audit(reader.csv(glob), record_source)
    return rows.withColumn("ldts", F.col("ldts").cast("timestamp_ntz"))


def read_inferred(spark: SparkSession, glob: str, header: bool = True) -> DataFrame:
    """Scan with inferred types: costs an extra pass, for exploration only."""
    options = {**CSV_OPTIONS, "header": str(header).lower(), "inferSchema": "true"}
    return spark.read.options(**options).csv(glob)


def raw_stream(
    spark: SparkSession, root: str, table: str, record_source: str = RECORD_SOURCE, batch_bytes: int | None = None
) -> DataFrame:
    """Bronze rows of one known source; `batch_bytes` bounds the files of a micro-batch, which has one at least."""
    options = {"maxBytesPerTrigger": str(batch_bytes)} if batch_bytes else None
    return read_stream(spark, landing_glob(root, table), raw_schema(table), record_source, options=options)
