"""The registered queries of the text operators, and the pipeline, over given tables."""

from __future__ import annotations

import os
import random

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from aprisco.llm import decontaminate, neardup, queries
from testbed.compare import differences, duck
from tests.llm.data import awkward, components
from tests.llm.test_rows import hits

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.LLM_QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in registry.LLM_QUERIES


@given
@pytest.mark.parametrize("name", [*queries.QUERIES])
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    if name in queries.ORACLES:
        n, notes = differences(df, duck(SF_DIR), queries.ORACLES[name])
        assert notes == []
    else:
        n = df.count()
    source = "pages" if name.startswith("op9") else "documents"
    assert n == queries.table(spark, SF_DIR, source).count()


def test_stages_take_effect(spark, tmp_path):
    """Each stage against brute force on what the one before it kept."""
    rng = random.Random(21)
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in awkward(21)]
    bench = [(1, rows[20][1] or "x y"), (2, " ".join(f"b{rng.randrange(99)}" for _ in range(30)))]
    rows.append((9000, f"start {bench[1][1]} end of this document", "en", "src0", 9))
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    marks = [(i, int(k % 3 > 0), int(k % 5 == 0)) for k, (i, *_) in enumerate(rows) if k % 2]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs, kept = queries.table(spark, str(tmp_path), "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, str(tmp_path))
        if name != "shards":
            assert docs.columns == before.columns
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    few = {i for i, t in kept["quality"] if len((t or "").split()) < 10}
    assert not few and kept["quality"]
    groups = components(kept["quality"], 5, 80)
    assert sorted(i for i, _ in kept["near_duplicates"]) == sorted(i for i, c in groups.items() if i == c)
    found = hits(kept["near_duplicates"], bench)
    assert 9000 in found and found[9000][3]
    assert {i for i, _ in kept["decontamination"]} == {i for i, f in found.items() if not f[3]}
    assert {i for i, _ in kept["mixing"]} <= {i for i, _ in kept["decontamination"]} and kept["mixing"]
    assert sorted(kept["shards"]) == sorted(kept["mixing"])
    assert docs.select("shard", "slot").distinct().count() == len(kept["shards"])


def test_stages_bear_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_default_similarity_is_five_words_and_four_fifths():
    assert neardup.near_duplicates.__defaults__ == (5, 80)
    assert decontaminate.contamination.__defaults__[:2] == (13, 5)
