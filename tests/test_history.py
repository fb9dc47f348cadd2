from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException

from aprisco.operators import (
    as_dimension,
    check_snapshot,
    current_versions,
    replay_snapshots,
    snapshot_step,
)

T1, T2, T3 = (datetime(2026, m, 1) for m in (1, 2, 3))
DDL = "id string, tracked string, other int"


def _copy(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def _versions(rows, history):
    return rows(history, "id", "tracked", "other", "dbt_valid_from", "dbt_valid_to")


def test_first_run_opens_everything_at_the_run(spark, rows):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1), ("b", None, 2)), "id", ["tracked"], T1)
    assert _versions(rows, history) == [("a", "x", 1, T1, None), ("b", None, 2, T1, None)]


def test_changes(spark, rows):
    history = check_snapshot(
        None,
        _copy(spark, ("same", "x", 1), ("moved", "x", 1), ("filled", None, 1), ("emptied", "x", 1),
              ("null", None, 1), ("gone", "x", 1)),
        "id", ["tracked"], T1,
    )
    history = check_snapshot(
        history,
        _copy(spark, ("same", "x", 9), ("moved", "y", 9), ("filled", "x", 9), ("emptied", None, 9),
              ("null", None, 9), ("new", "x", 9)),
        "id", ["tracked"], T2,
    )
    assert _versions(rows, history) == sorted(
        [
            ("same", "x", 1, T1, None),  # untracked columns stay as they were
            ("null", None, 1, T1, None),
            ("gone", "x", 1, T1, None),  # a key that vanished stays open
            ("new", "x", 9, T2, None),
            ("moved", "x", 1, T1, T2), ("moved", "y", 9, T2, None),
            ("filled", None, 1, T1, T2), ("filled", "x", 9, T2, None),
            ("emptied", "x", 1, T1, T2), ("emptied", None, 9, T2, None),
        ],
        key=repr,
    )
    assert history.select("dbt_scd_id").distinct().count() == 10


def test_same_copy_adds_nothing(spark, rows):
    copy = _copy(spark, ("a", "x", 1), ("b", None, 2))
    history = check_snapshot(None, copy, "id", ["tracked"], T1)
    again = check_snapshot(history, copy, "id", ["tracked"], T2)
    assert rows(again) == rows(history)


def test_closed_versions_are_left_alone(spark, rows):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1)), "id", ["tracked"], T1)
    history = check_snapshot(history, _copy(spark, ("a", "y", 2)), "id", ["tracked"], T2)
    history = check_snapshot(history, _copy(spark, ("a", "x", 3)), "id", ["tracked"], T3)
    assert _versions(rows, history) == [
        ("a", "x", 1, T1, T2), ("a", "x", 3, T3, None), ("a", "y", 2, T2, T3),
    ]


def test_columns_may_come_and_go(spark, rows):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1), ("b", "x", 1)), "id", ["tracked"], T1)
    wider = spark.createDataFrame([("a", "y", 7.5)], "id string, tracked string, extra double")
    history = check_snapshot(history, wider, "id", ["tracked"], T2)
    assert rows(history, "id", "tracked", "other", "extra") == [
        ("a", "x", 1, None), ("a", "y", None, 7.5), ("b", "x", 1, None),
    ]


@pytest.mark.parametrize("bad", [[("a", "x", 1), ("a", "y", 1)], [(None, "x", 1)]])
def test_repeated_or_null_key_fails(spark, bad):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1)), "id", ["tracked"], T1)
    for before in (None, history):
        with pytest.raises(PySparkException, match="NULL or repeated"):
            check_snapshot(before, _copy(spark, *bad), "id", ["tracked"], T2).collect()


def test_replay_rejects_repeats(spark):
    batches = spark.createDataFrame([("a", "x", T1), ("a", "y", T1)], "id string, tracked string, at timestamp_ntz")
    with pytest.raises(PySparkException, match="NULL or repeated"):
        replay_snapshots(batches, "id", ["tracked"], "at").collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_folded_runs(spark, rows, seed):
    """Random copies in which keys come, go, change, and change back, with NULLs."""
    rng = random.Random(seed)
    stamps = [T1 + timedelta(hours=7 * i) for i in range(5)]
    batches, history = [], None
    for stamp in stamps:
        copy = [
            (f"k{k}", rng.choice(["x", "y", None]), rng.randint(0, 9))
            for k in range(12) if rng.random() < 0.7
        ]
        batches += [(*row, stamp) for row in copy]
        history = check_snapshot(history, _copy(spark, *copy), "id", ["tracked"], stamp)
    bulk = replay_snapshots(
        spark.createDataFrame(batches, DDL + ", at timestamp_ntz"), "id", ["tracked"], "at"
    )
    assert sorted(bulk.columns) == sorted(history.columns)
    assert rows(bulk.select(history.columns)) == rows(history)


def test_dimension_and_current_versions(spark, rows):
    first = spark.createDataFrame([("a", "Activo"), ("b", "Activo")], "id string, estado string")
    history = check_snapshot(None, first, "id", ["estado"], T1)
    second = spark.createDataFrame([("a", "Vendido")], "id string, estado string")
    history = check_snapshot(history, second, "id", ["estado"], T2)
    dimension = as_dimension(history, "sk", {"id": "id_animal", "estado": "estado"})
    assert dimension.columns == [
        "sk", "id_animal", "estado", "vigente_desde", "vigente_hasta", "vigente",
    ]
    assert rows(dimension, "id_animal", "estado", "vigente") == [
        ("a", "Activo", False), ("a", "Vendido", True), ("b", "Activo", True),
    ]
    assert rows(current_versions(dimension), "id_animal") == [("b",)]
    assert rows(current_versions(dimension, None), "id_animal") == [("a",), ("b",)]


def test_step_reads_only_open_versions(spark, rows):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1)), "id", ["tracked"], T1)
    step = snapshot_step(history, _copy(spark, ("a", "y", 1)), "id", ["tracked"], T2)
    assert rows(step, "tracked", "dbt_valid_to") == [("x", T2), ("y", None)]


def test_an_older_run_fails(spark):
    history = check_snapshot(None, _copy(spark, ("a", "x", 1)), "id", ["tracked"], T2)
    for run_ts, value in ((T1, "x"), (T1, "y"), (T2, "y")):
        with pytest.raises(PySparkException, match="not later than an open version"):
            check_snapshot(history, _copy(spark, ("a", value, 1)), "id", ["tracked"], run_ts).collect()
    same = check_snapshot(history, _copy(spark, ("a", "x", 1)), "id", ["tracked"], T2)
    assert same.count() == 1
