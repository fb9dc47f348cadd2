"""Joins in which one key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aprisco.sources.shared import cut_lineage

HEAVY = 10_000  # keys whose rows stay where they are


def join_by_counts(rows: DataFrame, counted: DataFrame, on: list[str], times: str) -> DataFrame:
    """Inner join of ``rows`` (read twice, so stored or cheap) with ``counted``, which has one short
    row per key and in ``times`` how many rows have it.

    At most HEAVY keys have a HEAVY-th of all rows or more. They are broadcast, so that a key with
    a third of the rows moves none of them; the other keys meet by a shuffle, in which no key is
    larger than that.
    """
    counted = cut_lineage(counted)
    total = counted.agg(F.sum(times)).first()[0] or 0
    heavy = F.col(times) * F.lit(HEAVY) >= F.lit(total)
    few = F.broadcast(counted.where(heavy))
    light = rows.join(F.broadcast(counted.where(heavy).select(*on)), on, "left_anti").join(counted.where(~heavy), on)
    return rows.join(few, on).unionByName(light)
