from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aprisco.operators import asof_version_join
from tests.test_joins import SHUFFLED, _with

FACTS = "id string, k string, day date"
VERSIONS = "k string, sk string, category string, since timestamp_ntz, until timestamp_ntz"


def _join(spark, facts, versions, **options):
    return asof_version_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS),
        key="k", fact_date="day", fact_id="id", attrs={"category": "category_then"},
        valid_from="since", valid_to="until", version_id="sk", **options,
    )


GOLDEN = [
    ("ins_test_a", "1", "Concentrado", datetime(2026, 1, 1), datetime(2026, 6, 1)),
    ("ins_test_a", "2", "Suplemento", datetime(2026, 6, 1), None),
    ("closed", "3", "first", datetime(2026, 1, 1), datetime(2026, 2, 1)),
    ("closed", "4", "second", datetime(2026, 2, 1), datetime(2026, 3, 1)),
    ("overlap", "5", "older", datetime(2026, 1, 1), datetime(2026, 5, 1)),
    ("overlap", "6", "younger", datetime(2026, 2, 1), None),
    ("within", "7", "morning", datetime(2026, 1, 1, 8), datetime(2026, 1, 1, 20)),
    ("within", "8", "evening", datetime(2026, 1, 1, 20), None),
    ("unborn", "9", "bad", None, None),
    ("unborn", "10", "good", datetime(2026, 1, 1), None),
    ("unborn closed", "11", "bad", None, datetime(2027, 1, 1)),
    ("unborn closed", "12", "good", datetime(2026, 1, 1), None),
]


@pytest.mark.parametrize(
    ("key", "day", "expected"),
    [
        ("ins_test_a", date(2026, 3, 15), "Concentrado"),  # inside the first interval
        ("ins_test_a", date(2025, 1, 1), "Concentrado"),  # before all history
        ("ins_test_a", date(2026, 5, 31), "Concentrado"),
        ("ins_test_a", date(2026, 6, 1), "Suplemento"),  # half open
        ("ins_test_a", None, "Concentrado"),
        ("closed", date(2026, 2, 15), "second"),
        ("closed", date(2026, 4, 1), "first"),  # after a closed last version: the oldest
        ("overlap", date(2026, 3, 1), "older"),
        ("overlap", date(2026, 5, 1), "younger"),
        ("ins_test_a", date(9999, 12, 31), "Suplemento"),  # open has no last day
        ("overlap", date(9999, 12, 31), "younger"),
        ("unborn", date(2026, 3, 1), "good"),
        ("unborn", date(2025, 3, 1), "bad"),  # no version covers it: the oldest
        ("unborn", None, "bad"),
        ("unborn closed", date(2026, 3, 1), "good"),
        ("within", date(2026, 1, 1), "morning"),  # no version covers this midnight
        ("within", date(2026, 1, 2), "evening"),
        ("unknown", date(2026, 1, 1), None),
        (None, date(2026, 1, 1), None),
    ],
)
def test_one_fact(spark, rows, key, day, expected):
    assert rows(_join(spark, [("f", key, day)], GOLDEN)) == [("f", key, day, expected)]


def test_repeated_fact_keeps_the_best_match(spark, rows):
    facts = [
        ("f", "ins_test_a", date(2025, 1, 1)),
        ("f", "ins_test_a", date(2026, 7, 1)),
        ("g", "unknown", date(2026, 7, 1)),
        ("g", "ins_test_a", date(2026, 7, 1)),
    ]
    assert rows(_join(spark, facts, GOLDEN), "id", "category_then") == [
        ("f", "Suplemento"), ("g", "Suplemento"),
    ]
    kept = _join(spark, facts, GOLDEN, unique_facts=True)
    assert rows(kept, "id", "category_then") == sorted(
        [("f", "Concentrado"), ("f", "Suplemento"), ("g", None), ("g", "Suplemento")], key=repr
    )


def test_date_must_be_a_date(spark):
    facts = spark.createDataFrame([("f", "k", datetime(2026, 1, 1))], "id string, k string, day timestamp_ntz")
    with pytest.raises(TypeError):
        asof_version_join(
            facts, spark.createDataFrame(GOLDEN, VERSIONS), key="k", fact_date="day", fact_id="id",
            attrs={"category": "c"}, valid_from="since", valid_to="until",
        )


def _by_hand(fact, versions):
    """All versions of the key, ranked."""
    _, key, day = fact
    midnight = datetime.combine(day, datetime.min.time())
    own = [v for v in versions if v[0] == key]

    def rank(v):
        valid = v[3] <= midnight and (v[4] is None or midnight < v[4])
        return (not valid, v[3], v[1])

    return min(own, key=rank)[2] if own else None


@pytest.mark.parametrize("seed", range(4))
def test_random_versions_overlap_and_leave_gaps(spark, seed):
    rng = random.Random(seed)
    base = datetime(2026, 1, 1)
    versions = []
    for i in range(150):
        since = base + timedelta(hours=rng.choice([0, 6, 12, 24]) * rng.randint(0, 40))
        until = None if rng.random() < 0.1 else since + timedelta(hours=rng.randint(-5, 200))
        versions.append((f"k{rng.randint(0, 9)}", f"s{i:03}", f"c{i}", since, until))
    facts = [
        (f"f{i}", f"k{rng.randint(0, 11)}", date(2025, 12, 25) + timedelta(days=rng.randint(0, 60)))
        for i in range(400)
    ]
    joined = {r["id"]: r["category_then"] for r in _join(spark, facts, versions).collect()}
    assert joined == {f[0]: _by_hand(f, versions) for f in facts}


@pytest.mark.parametrize("unique", [True, False])
def test_hot_key_and_day_is_split(spark, tmp_path, unique):
    """A third of the facts on one key and day: the join is cut there, and no fact is lost."""
    hot = F.col("id") % 3 == 0
    spark.range(0, 40_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("id"),
        F.when(hot, F.lit("k0")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.when(hot, F.lit(date(2026, 1, 5))).otherwise(
            F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 30).cast("int"))).alias("day"),
    ).write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    versions = spark.createDataFrame(
        [(f"k{i}", f"s{i}", f"c{i}", datetime(2026, 1, 1), None) for i in range(400)], VERSIONS
    )

    def run():
        joined = asof_version_join(
            facts, versions, key="k", fact_date="day", fact_id="id", attrs={"category": "then"},
            valid_from="since", valid_to="until", version_id="sk", unique_facts=unique,
        )
        counted = joined.agg(F.count(F.lit(1)), F.count("then"), F.count_if(F.col("then") == "c0"))
        found = tuple(counted.collect()[0])
        joined.collect()
        return found, joined._jdf.queryExecution().executedPlan().toString()

    (n, resolved, of_hot), text = _with(spark, SHUFFLED, run)
    k0 = facts.where("k = 'k0'").count()
    known = facts.where("cast(substring(k, 2) as int) < 400").count()
    assert (n, resolved, of_hot) == (40_000, known, k0)
    assert "skew=true" in text
