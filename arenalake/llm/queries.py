"""The numbered queries of this folder and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm import chat, decontaminate, language, language_model, lexical, licenses, mixing, ngram_join, packing, quality, spelling, suffix_dedup, toxicity
from arenalake.llm.common import crc_mod, table
from arenalake.llm.sql import OP1, OP2, OP4, OP11, OP12, OP13
from arenalake.plans.catalog import Catalog

CATALOG = Catalog()


@CATALOG.query("op1_quality_rules", OP1)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@CATALOG.query("op2_ngram_jaccard", OP2)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), ngram_join.Similarity(3, 90, 100))


@CATALOG.query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@CATALOG.query("op9_license_scans")
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@CATALOG.query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(crc_mod(4) != 2))
    return language.identify(docs, model).select("doc_id", (crc_mod(4) == 2).alias("held_out"), "lang_pred", "score", "spans")


@CATALOG.query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs.filter(crc_mod(3) != 1), table(spark, sf_dir, "labels").filter(crc_mod(3) != 1))
    return toxicity.score(docs, machine).select(
        "doc_id", (crc_mod(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "word"
    )


@CATALOG.query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@CATALOG.query("op4_chat_formatting", OP4)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -7L AS conv_id, t.turn, t.role, t.text FROM VALUES (0L, 'user', :said), (1L, 'assistant', :said) AS t(turn, role, text)", args={"said": said})
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.windows(rows))


@CATALOG.query("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CATALOG.query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_model.train(docs.filter(crc_mod(7) != 2))
    return language_model.score(docs, model).withColumn("held_out", crc_mod(7) == 2)


@CATALOG.query("op13_source_mix", OP13)
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@CATALOG.query("op11_spelling_variants", OP11)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), slips=97)


@CATALOG.query("op12_lexical_search", OP12)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
