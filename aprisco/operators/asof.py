"""Point-in-time join of dated facts with type-2 versions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aprisco.functions.columns import ceil_to_date
from aprisco.operators.history import VALID_FROM, VALID_TO
from aprisco.sources.shared import cut_lineage


def _timeline(
    versions: DataFrame,
    key: str,
    attrs: Mapping[str, str],
    valid_from: str,
    valid_to: str,
    version_id: str | None,
) -> DataFrame:
    """Disjoint stretches of days per key, each with the version that wins on those days.

    Facts are dated to the day, so a version matters only through the first midnight it
    covers (``a``) and the first it no longer covers (``b``). Versions with equal (a, b)
    cover the same days and only the oldest of them can win, which leaves at most one row
    per day and key for a regular history, however often a key changes within a day. An open
    version has no ``b``; one that never begins has no ``a``, covers no day and stands in no
    other's way: it may only be the fallback.

    Among versions that cover a day the oldest wins. In order of age, a version therefore
    wins exactly from the later of ``a`` and the largest ``b`` before it, up to ``b``, and
    nothing wins after an older open version has begun.
    """
    payload = F.struct(*[F.col(src).alias(name) for src, name in attrs.items()])
    tie_break = F.col(version_id) if version_id else payload
    start = ceil_to_date(F.col(valid_from))
    # A version without a covered midnight keeps an empty stretch: it may still be the oldest.
    end = F.greatest(start, ceil_to_date(F.col(valid_to)))
    begins, is_open = F.col(valid_from).isNotNull(), F.col(valid_to).isNull()
    end = F.when(begins & ~is_open, end)
    version = F.struct(
        F.col(valid_from).alias("since"), tie_break.alias("tie"), payload.alias("attrs")
    )
    distinct = (
        versions.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k"), start.alias("a"), end.alias("b"))
        .agg(F.min(version).alias("oldest"))
        .select("k", "a", "b", (F.col("a").isNotNull() & F.col("b").isNull()).alias("open"), "oldest.*")
    )
    by_age = Window.partitionBy("k").orderBy("since", "tie")
    older = by_age.rowsBetween(Window.unboundedPreceding, -1)
    ranked = distinct.select(
        "k", "b", "open", "since", "tie", "attrs",
        F.when(F.col("a").isNotNull(), F.greatest("a", F.max("b").over(older))).alias("from_day"),
        F.coalesce(F.max("open").over(older), F.lit(False)).alias("shut_out"),
        (F.row_number().over(by_age) == 1).alias("is_oldest"),
    )
    entry = lambda day, until, is_open: F.struct(
        day.alias("day"),
        F.struct(until.alias("until"), is_open.alias("open"), "since", "tie", "attrs").alias("v"),
    )
    covers = F.col("from_day").isNotNull() & (F.col("open") | (F.col("from_day") < F.col("b")))
    wins = F.when(covers & ~F.col("shut_out"), entry(F.col("from_day"), F.col("b"), F.col("open")))
    # The oldest version also opens the timeline, as the fallback that covers no day.
    no_day = F.lit(None).cast("date")
    fallback = F.when(F.col("is_oldest"), entry(no_day, no_day, F.lit(False)))
    return ranked.select(
        "k", F.inline(F.filter(F.array(fallback, wins), lambda e: e.isNotNull()))
    )


def asof_version_join(
    facts: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    fact_date: str,
    fact_id: str,
    attrs: Mapping[str, str],
    version_key: str | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    version_id: str | None = None,
    unique_facts: bool = False,
) -> DataFrame:
    """Add to each fact the attributes of the version valid at midnight of its date.

    ``attrs`` maps version columns to output names. Of several valid versions the oldest is
    taken; without a valid one the oldest version of the key; without any version the
    attributes are NULL. ``version_id`` breaks ties between versions of equal start. Facts
    that repeat ``fact_id`` collapse to the best match, unless ``unique_facts`` says that
    they cannot. Otherwise ids that repeat are found on that column alone and stored, and only
    facts with such an id are shuffled and ranked.

    No fact is ever paired with all versions of its key. The facts are first reduced to
    their distinct (key, date) pairs, before the shuffle, and only those meet the versions,
    in one window per key that holds at most one row per calendar day and side. The answer
    goes back to the facts by an equi-join with one row per pair, which Spark broadcasts if
    it is small and otherwise splits where a pair is hot.
    """
    if dict(facts.dtypes)[fact_date] != "date":
        raise TypeError(f"{fact_date} must be a DATE column")
    timeline = _timeline(
        versions, version_key or key, attrs, valid_from, valid_to, version_id
    )
    # A NULL date is in no interval. It sorts before all history, as the fallback does.
    probes = (
        facts.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k"), F.col(fact_date).alias("day"))
        .agg(F.lit(True).alias("is_probe"))
    )
    walk = Window.partitionBy("k").orderBy(F.col("day").asc_nulls_first(), F.col("is_probe").asc_nulls_first())
    walk = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.coalesce(F.col("at.open") | (F.col("day") < F.col("at.until")), F.lit(False))
    answer = (
        timeline.unionByName(probes, allowMissingColumns=True)
        .select(
            "k", "day", "is_probe",
            F.last("v", ignorenulls=True).over(walk).alias("at"),
            F.first("v").over(walk).alias("oldest"),
        )
        .where(F.col("is_probe") & F.col("oldest").isNotNull())
        .select(
            F.col("k").alias("__key"), F.col("day").alias("__asked"),
            F.when(valid, 1).otherwise(2).alias("__priority"),
            F.when(valid, F.col("at")).otherwise(F.col("oldest")).alias("__v"),
        )
    )

    def answered(some: DataFrame) -> DataFrame:
        asked = (F.col(key) == F.col("__key")) & F.col(fact_date).eqNullSafe(F.col("__asked"))
        return some.join(answer, asked, "left")

    result = [*facts.columns, *[F.col(f"__v.attrs.{name}").alias(name) for name in attrs.values()]]
    repeated = None if unique_facts else _repeated_ids(facts, fact_id)
    if repeated is None:
        return answered(facts).select(*result)
    again = F.col(fact_id).eqNullSafe(F.col("__id"))
    best = Window.partitionBy(fact_id).orderBy(
        F.coalesce("__priority", F.lit(2)), F.col("__v.since"), F.col("__v.tie")
    )
    ranked = answered(facts.join(repeated, again, "left_semi")).withColumn("__rn", F.row_number().over(best))
    single = answered(facts.join(repeated, again, "left_anti"))
    return single.select(*result).unionByName(ranked.where("__rn = 1").select(*result))


def _repeated_ids(facts: DataFrame, fact_id: str) -> DataFrame | None:
    """The ids of more than one fact, stored, so that their number is known to the plan that
    uses them; None if there are none."""
    ids = facts.groupBy(F.col(fact_id).alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    stored = cut_lineage(ids.where("__n > 1").select("__id"))
    return None if stored.isEmpty() else stored
