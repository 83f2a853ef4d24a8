"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.workspace import new_dir, shared_dir, written

__all__ = ["bind", "crc_mod", "docs_of", "new_dir", "release", "row_anti", "row_keys", "row_semi", "semi", "shared_dir", "table", "written"]

# White space of the word rules: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(df: DataFrame) -> DataFrame:
    """The two columns every document operator needs; whatever else the frame holds is dropped."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bind(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def crc_mod(mod: int) -> Column:
    """crc32 of doc_id as text, modulo `mod`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


def _keyed(keys: DataFrame) -> tuple[DataFrame, str]:
    name = f"k_{uuid.uuid4().hex[:8]}"
    return keys.select(F.col("doc_id").alias(name)).distinct(), name


def semi(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id (NULL equals NULL) is among `keys`; columns never clash."""
    known, name = _keyed(keys)
    return docs.join(known, docs["doc_id"].eqNullSafe(known[name]), "left_semi")


NO_ID = -(1 << 63)


def row_keys(k: str = "k", h: str = "h") -> list[Column]:
    """A row's doc_id (one fixed number for NULL) and the hash of its text, NULL being empty."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(k),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(h),
    ]


def _on_rows(docs: DataFrame, keys: DataFrame, how: str, also: tuple[str, ...]) -> DataFrame:
    tag = uuid.uuid4().hex[:8]
    known = keys.select(*[F.col(c).alias(f"{c}_{tag}") for c in ("k", "h", *also)]).distinct()
    k, h = row_keys()
    on = (k == F.col(f"k_{tag}")) & (h == F.col(f"h_{tag}"))
    for c in also:
        on = on & docs[c].eqNullSafe(F.col(f"{c}_{tag}"))
    return docs.join(known, on, how)


def row_semi(docs: DataFrame, keys: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows of `docs` whose doc_id and text (and columns `also`) are among `keys` (k, h, ...); columns never clash."""
    return _on_rows(docs, keys, "left_semi", also)


def row_anti(docs: DataFrame, keys: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows of `docs` whose doc_id and text (and columns `also`) are not among `keys`."""
    return _on_rows(docs, keys, "left_anti", also)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps.

    The cleaner acts when the driver collects garbage, which a driver with little to do puts off; long jobs
    of many written steps would keep every step's shuffle files until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
