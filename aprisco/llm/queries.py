"""One query per operator of this subpackage, over whole tables, with their reference SQL."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from aprisco.llm import (
    decontaminate, fim, fmindex, mixing, neardup, oracles, passages, pii, quality, runs, sharding, suffixes, tokens, urls,
)

Query = Callable[[SparkSession, str], DataFrame]
PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Send the package's code to the Python workers, once per application, so that it need not
    be installed on the executors."""
    name = f"{PACKAGE.name}.zip"
    if any(path.endswith(f"/{name}") for path in spark.sparkContext.listFiles):
        return
    archive = os.path.join(SparkFiles.getRootDirectory(), f"source-{name}", name)
    os.makedirs(os.path.dirname(archive), exist_ok=True)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op2_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op3_soft_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.soft_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fmindex.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op5_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_two_tier_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_language_model_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_benchmark_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


def op12_attention_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"))


def shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


PLAIN: tuple[Query, ...] = (
    op2_boosted_candidates, op9_language_model_ratio, op10_benchmark_grams,
)
WITH_PYTHON: tuple[Query, ...] = (
    op1_hypergeometric_shards, op3_soft_membership, op4_fm_index, op5_deep_shallow, op6_superminhash, op7_isolation_forest, op8_two_tier_tokens,
    op11_piece_table, op12_attention_passages, op13_seed_and_extend,
)
QUERIES: dict[str, Query] = {q.__name__: q for q in PLAIN} | {q.__name__: shipped(q) for q in WITH_PYTHON}
ORACLES: dict[str, str] = {
    "op4_fm_index": oracles.OP4,
    "op5_deep_shallow": oracles.OP5,
    "op6_superminhash": oracles.OP6,
    "op10_benchmark_grams": oracles.OP10,
    "op11_piece_table": oracles.OP11,
}
