"""A training-corpus pipeline over ``documents``: filter, deduplicate, decontaminate, mix, shard.

Every stage is a function of ``(spark, docs, sf_dir)``; :func:`run` writes each
stage's result as Parquet below the shared checkpoint folder and hands the
table read back to the next one.  All stages but the last return the columns of
``documents``; the last adds ``shard`` and ``slot``.

Cases: every stage keeps the semantics of its operator for null and empty
texts, repeated rows, ties and further columns (see the operators' modules);
an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adevents.llm import contamination, jaccard_join, mixing, quality, sharding
from adevents.llm.common import read_table, saved
from adevents.session import prepare_session


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; texts stay as they are."""
    prepare_session(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare_session(spark)
    return jaccard_join.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    return contamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    prepare_session(spark)
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place in it."""
    prepare_session(spark)
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The mixing stage (a knapsack programme over seeded draws) has no SQL form.
ORACLE_SQL = None
