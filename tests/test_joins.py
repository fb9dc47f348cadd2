from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from aprisco.functions import date_dimension
from aprisco.operators import daily_rollup, full_outer_merge, join_calendar, star_join


def test_star_join_is_inner_and_keeps_repeats(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, farm string")
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "yy"), (None, "n")], "name string, place string")
    joined = star_join(fact, dim, "farm", "name", {"place": "where"})
    assert joined.columns == ["id", "farm", "where"]
    assert rows(joined) == [(1, "a", "x"), (2, "b", "y"), (2, "b", "yy")]


def test_calendar_drops_what_it_does_not_cover(spark, rows):
    fact = spark.createDataFrame(
        [(1, date(2019, 12, 31)), (2, date(2020, 1, 1)), (3, date(2036, 1, 1)), (4, None)],
        "id int, day date",
    )
    joined = join_calendar(fact, date_dimension(spark), "day", ["estacion"])
    assert rows(joined) == [(2, date(2020, 1, 1), "Seca")]


def _sides(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, 1, 1, 1, 2, 3, 4])
    left = [(pick(), rng.choice(["x", "y", None]), i) for i in range(60)]
    right = [(pick(), rng.choice(["x", "z", None]), i) for i in range(60)]
    return (
        spark.createDataFrame(left, "a int, b string, l int"),
        spark.createDataFrame(right, "a int, b string, r int"),
    )


def test_full_outer_merge_equals_a_full_join(spark, rows):
    for seed in range(3):
        left, right = _sides(spark, seed)
        merged = full_outer_merge(left, right, ["a", "b"])
        expected = left.join(right, ["a", "b"], "full")
        assert rows(merged, "a", "b", "l", "r") == rows(expected, "a", "b", "l", "r")


def test_merge_of_unique_keys(spark, rows):
    left, right = (side.dropDuplicates(["a", "b"]) for side in _sides(spark, 5))
    merged = full_outer_merge(left, right, ["a", "b"], one_row_per_key=True)
    assert merged.columns == full_outer_merge(left, right, ["a", "b"]).columns
    assert rows(merged, "a", "b") == rows(full_outer_merge(left, right, ["a", "b"]), "a", "b")


def test_merge_of_one_empty_side(spark, rows):
    left, right = _sides(spark, 0)
    for a, b in ((left, right.limit(0)), (left.limit(0), right)):
        assert full_outer_merge(a, b, ["a", "b"]).count() == 60


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "8",
}


def _with(spark, conf, action):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return action()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark, path, name, n, hot):
    """Rows of which a part falls on one key, written so that several tasks read them."""
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).alias("key"),
        F.md5(F.col("id").cast("string")).alias(name),
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_key_of_a_merge_is_split(spark, tmp_path):
    """A third of one side on one key: the join is cut there, and nothing is lost."""
    def run():
        left = _hot(spark, str(tmp_path / "l"), "l", 30_000, 1)
        right = spark.range(0, 30_000, 2, 4).select(F.col("id").alias("key"), F.lit("r").alias("r"))
        merged = full_outer_merge(left, right, ["key"])
        found = merged.agg(F.count(F.lit(1)), F.count("l"), F.count("r")).first()
        expected = left.join(right, "key", "full").agg(F.count(F.lit(1)), F.count("l"), F.count("r")).first()
        assert found == expected
        star = star_join(left, left.limit(0).unionByName(right.select("key", F.col("r").alias("l"))), "key", "key", {"l": "r"})
        star.write.format("noop").mode("overwrite").save()
        observed = star.select("key", "l", "r")
        observed.collect()
        return observed._jdf.queryExecution().toString()

    assert "skew=true" in _with(spark, SHUFFLED, run)


def test_merge_shuffles_each_side_once(spark, tmp_path):
    def run():
        left = _hot(spark, str(tmp_path / "l"), "l", 3_000, 1)
        right = _hot(spark, str(tmp_path / "r"), "r", 3_000, 2)
        merged = full_outer_merge(left, right, ["key"])
        merged.collect()
        return merged._jdf.queryExecution().executedPlan().toString()

    plan = _with(spark, SHUFFLED, run).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_rollup(spark, rows):
    fact = spark.createDataFrame(
        [
            ("f1", date(2026, 1, 1), "7", Decimal(2)), ("f1", date(2026, 1, 1), "7", Decimal(3)),
            # Two animals without a tag are one line; a NULL amount still counts.
            ("f1", date(2026, 1, 1), None, Decimal(4)), ("f1", date(2026, 1, 1), None, None),
            ("f2", date(2026, 1, 1), "7", None), ("zz", date(2026, 1, 1), "7", Decimal(9)),
        ],
        "farm string, day date, tag string, litres decimal(38,9)",
    )
    farms = spark.createDataFrame([("f1",), ("f2",)], "name string")

    def roll(dim):
        return rows(daily_rollup(
            fact, dim, fact_key="farm", dim_key="name", dim_name="name", group_by=["day", "tag"],
            amount="litres", total="total", count="n",
        ), "name", "tag", "total", "n")

    assert roll(farms) == sorted(
        [("f1", "7", Decimal(5), 2), ("f1", None, Decimal(4), 2), ("f2", "7", None, 1)], key=repr
    )
    # A repeated dimension name counts its facts twice, as the join before grouping would.
    assert roll(farms.union(farms.where("name = 'f1'"))) == sorted(
        [("f1", "7", Decimal(10), 4), ("f1", None, Decimal(8), 4), ("f2", "7", None, 1)], key=repr
    )
