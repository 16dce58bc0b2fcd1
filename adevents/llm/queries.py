"""The queries of this package: one per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adevents.llm import (
    collocations,
    contamination,
    hadamard_clusters,
    jaccard_join,
    katz,
    mixing,
    quality,
    sharding,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
    wrappers,
)
from adevents.llm.common import read_table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination_digest(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.lm_digest(read_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(read_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_pages(pages))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digest(read_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_digest(read_table(spark, sf_dir, "documents"))


def op11_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extraction_digest(read_table(spark, sf_dir, "pages"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hadamard_clusters.cluster_digest(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_katz_scoring": op4_katz_scoring,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_html_wrappers": op11_html_wrappers,
    "op12_collocations": op12_collocations,
    "op13_hadamard_clusters": op13_hadamard_clusters,
}
