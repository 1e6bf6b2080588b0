"""One query for each operator: its whole table in, its full result out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.llm import decontaminate, language, lexical, linededup, mixing, personal, quality, quotes, sharding, simhash, suffixdedup, toxicity, whitening
from flowtally.llm.common import table
from flowtally.llm.oracles import ORACLES as ORACLES


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return places.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "epoch", "block", "slot", "position")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.without_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("clean").cast("bigint").alias("n_chars"), F.md5("clean").alias("clean_md5"))


def op4_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeated_passages(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(docs, model).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = personal.fit(personal.examples(spark))
    return personal.report(personal.find(table(spark, sf_dir, "documents"), model))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_linededup": op3_linededup,
    "op4_suffixdedup": op4_suffixdedup,
    "op5_language": op5_language,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_quotes": op10_quotes,
    "op11_personal": op11_personal,
    "op12_whitening": op12_whitening,
    "op13_search": op13_search,
}
