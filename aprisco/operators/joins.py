"""Star joins and the merge of two facts. Join strategy is left to the optimizer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Inner join of a fact with a dimension, adding the named dimension columns.

    No hint is given: a dimension whose size statistics are under
    ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is shuffled, and a
    hot fact key is then split at run time.
    """
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    side = dim.select(
        F.col(dim_key).alias("__dim_key"),
        *[F.col(src).alias(name) for src, name in named.items()],
    )
    return fact.join(side, fact[fact_key] == side["__dim_key"], "inner").drop("__dim_key")


def join_calendar(
    fact: DataFrame, calendar: DataFrame, fact_date: str, columns: Sequence[str]
) -> DataFrame:
    """Inner join with a calendar of one row per day; drops dates it does not cover.

    As with any dimension, its size decides whether the optimizer broadcasts it.
    """
    return star_join(fact, calendar, fact_date, "fecha", columns)


def full_outer_merge(
    left: DataFrame, right: DataFrame, on: Sequence[str], one_row_per_key: bool = False
) -> DataFrame:
    """Full outer join of two facts with the key columns coalesced.

    Sides that are aggregated to ``one_row_per_key`` have no hot key and are joined directly.

    Otherwise a key may hold much of a side, and Spark cannot split a key of a full outer
    join. The merge is then put together from an inner join, whose both sides can be split,
    and the unmatched rows of either side, found against the distinct keys of the other. Rows
    with a NULL key match nothing and skip the shuffle. The joins share the exchange of each
    side, but the sides should be stored relations, not long computations.
    """
    on = list(on)
    if one_row_per_key:
        return left.join(right, on, "full")
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    keyed_left, keyed_right = left.where(no_null), right.where(no_null)
    parts = [
        keyed_left.join(keyed_right, on, "inner"),
        keyed_left.join(keyed_right.select(on).distinct(), on, "left_anti"),
        keyed_right.join(keyed_left.select(on).distinct(), on, "left_anti"),
        left.where(~no_null),
        right.where(~no_null),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
