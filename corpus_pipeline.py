"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage works on all rows that the one before it kept and returns the columns of documents;
the last adds ``shard`` and ``slot``. Rows repeat after mixing where a rate is above one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aprisco.llm import decontaminate, mixing, neardup, quality, queries, sharding
from aprisco.sources.shared import cut_lineage

PULL = 0.05  # of the rates towards one, against the target weights
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    queries.ship(spark)
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles over links."""
    queries.ship(spark)
    return neardup.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than 5 % of their words inside n-grams of the benchmark."""
    return decontaminate.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates say that move the domains towards their target weights.

    The stages before have taken out most of the low domain, so its target could be met only by a
    few documents many times over; the pull keeps rates near one.
    """
    queries.ship(spark)
    return mixing.mix(docs, queries.table(spark, sf_dir, "labels"), pull=PULL)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard and slot."""
    return sharding.shard_uniformly(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", target_weights),
    ("shards", shards),
]

#: Trained models and random draws are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before it has stored."""
    docs = queries.table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
