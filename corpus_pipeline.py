"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledger.llm import decontaminate, language_id, mixing, sharding, simhash
from ledger.llm.common import cut, ship, table


#: Languages that stay; None keeps every language that the labelled documents teach.
LANGUAGES: tuple[str, ...] | None = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go: no text, no letter, or no language that scores enough."""
    ship(spark)
    return language_id.keep_identified(docs, LANGUAGES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    ship(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    ship(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    ship(spark)
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard they belong to."""
    ship(spark)
    return sharding.assign_shards(docs)


STAGES = [
    ("language_id", identified),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing_to_weights),
    ("extendible_sharding", shards),
]

#: Fingerprints use XXH64, which the SQL engine lacks; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
