"""Corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a frame that
is written as Parquet and read back as the next stage's `docs`. Rows are judged by doc_id and text, so rows
that share a doc_id (or have none) stand or fall each for itself. Columns beside doc_id, text, lang and source pass
through untouched, but for n_chars where a passage was cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm.common import new_dir, row_anti, row_keys, row_semi, table, written
from arenalake.llm.decontaminate import decontaminated
from arenalake.llm.ngram_join import Similarity, jaccard_classes
from arenalake.llm.packing import pack
from arenalake.llm.quality import judged
from arenalake.llm.suffix_dedup import without_repeats
from arenalake.session import tune

# Near copies: Jaccard similarity of at least 0.8 over five-word shingles.
NEAR = Similarity(k=5, num=80, den=100)
# Passages of more words than this are repeats even if they have fewer than 400 bytes.
WORDS = 50


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rule and the adaptive fences of their language and source."""
    return row_anti(docs, judged(docs).filter(~F.col("kept")), ("lang", "source"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of every class of near copies, once; a NULL doc_id is never dropped."""
    named = docs.filter("doc_id IS NOT NULL").select(*row_keys(), "text").withColumn("row", F.xxhash64("k", "h"))
    classes = jaccard_classes(named.select(F.col("row").alias("doc_id"), "text"), NEAR).select(
        F.col("doc_id").alias("of"), F.col("component_id").alias("class")
    )
    rows = named.groupBy("k", "h", "row").agg(F.count(F.lit(1)).alias("c"))
    rows = written(rows.join(classes.distinct(), F.col("row") == F.col("of")).select("k", "h", "c", "class"), "classes")
    first = written(rows.groupBy(F.col("class").alias("led")).agg(F.min(F.struct("k", "h")).alias("first")), "first")
    kept = row_anti(docs, rows.join(first, F.col("class") == F.col("led")).filter(F.struct("k", "h") != F.col("first")))
    again = rows.filter("c > 1").select("k", "h")
    if not again.limit(1).count():
        return kept
    once = row_semi(kept, again).select("*", *row_keys("__k", "__h")).dropDuplicates(["__k", "__h"]).drop("__k", "__h")
    return row_anti(kept, again).union(once)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every repeated passage of 400 bytes or more, or of over 50 words, stays at its first place only."""
    return without_repeats(docs, WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences of 4096 tokens."""
    return pack(docs)


def _tuned(stage):
    return lambda spark, docs, sf_dir: stage(tune(spark), docs, sf_dir)


STAGES = [
    ("quality_rules", _tuned(keep_quality)),
    ("ngram_jaccard_join", _tuned(drop_near_copies)),
    ("suffix_array_dedup", _tuned(cut_repeats)),
    ("benchmark_decontamination", _tuned(drop_leaks)),
    ("best_fit_packing", _tuned(pack_sequences)),
]

# Near-duplicate classes, suffix order and packing cannot be stated as one query; the tests compare
# the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
