"""From raw documents to a sharded, mixed training corpus: five stages, each a table.

Toxic documents go, one document of each group of near copies stays, benchmark passages are
cut out, sources are interleaved at their target weights, and the mixture is dealt to shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowtally.llm import decontaminate, mixing, sharding, simhash, toxicity
from flowtally.llm.common import DOCUMENT_COLUMNS, table
from flowtally.session import stage


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Hashing, the classifier and the index have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
