"""The corpus queries, one per operator, over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledger.llm import (
    decontaminate,
    katz,
    language_id,
    mixing,
    page_wrappers,
    periodic_runs,
    sharding,
    simhash,
    spot_signatures,
    sql,
    token_counts,
    token_store,
    url_filter,
    whitening,
)
from ledger.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {
    "op8_source_mixing": sql.MIX,
    "op9_extendible_sharding": sql.SHARDS,
    "op10_url_filter": sql.urls(),
}


def query(run: Query) -> Query:
    @wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)
    QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op3_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "distance", "start_word")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


@query
def op7_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


@query
def op9_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan_shards(table(spark, sf_dir, "documents"))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.with_planted_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.find_runs(planted))


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_wrappers.extract_pages(table(spark, sf_dir, "pages"))
