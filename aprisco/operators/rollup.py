"""Daily rollups of a fact under a dimension name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aprisco.operators.joins import star_join


def daily_rollup(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    dim_name: str,
    group_by: Sequence[str],
    amount: str | Column,
    total: str,
    count: str,
) -> DataFrame:
    """Sum and row count per (dimension name, ``group_by``) of the facts a dimension knows.

    The facts are aggregated by their own key before the join, so a hot key is folded on the
    map side and never reaches the join as raw rows; the join then sees one row per group.
    The second aggregation makes the result exact when several dimension rows share a key or
    a name. The sum skips NULL amounts, the count does not.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    partial = fact.groupBy(fact_key, *group_by).agg(
        F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__rows")
    )
    return (
        star_join(partial, dim, fact_key, dim_key, {dim_name: "__name"})
        .groupBy(F.col("__name").alias(dim_name), *group_by)
        .agg(F.sum("__sum").alias(total), F.sum("__rows").alias(count))
    )
