"""Checks as queries: each returns what breaks the rule, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations of values, that occur more than once. NULLs are ignored."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def not_null_within(
    df: DataFrame, column: str, max_null_fraction: float = 0.0, condition: str | Column | None = None
) -> DataFrame:
    """One row if too large a part of the rows that meet a condition has no value."""
    rows = df if condition is None else df.where(condition)
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_null")
    )
    return counts.select(
        "*", F.round(F.try_divide("n_null", "n_rows"), 6).alias("null_fraction")
    ).where(F.col("n_null") > F.col("n_rows") * F.lit(float(max_null_fraction)))


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their number of rows. NULL passes."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Child values without a parent, with their number of rows. A NULL child passes.

    Both sides are reduced to distinct values before the shuffle, so a value shared by much
    of the child reaches the join once, and the join needs no shuffle of its own.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(field).alias("__known")).distinct()
    return values.join(known, values[column] == known["__known"], "left_anti")


def _row_counts(table: str, df: DataFrame, side: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(table).alias("tabla"), F.lit(side).alias("side"), "n"
    )


def count_reconciliation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Tables whose replica does not have exactly as many rows as the live copy.

    ``pairs`` maps a table name to (replica, live). All tables are counted in one job, and a
    count reads no column.
    """
    counts = [
        _row_counts(table, df, side)
        for table, sides in pairs.items()
        for side, df in zip(("raw", "live"), sides, strict=True)
    ]
    of = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")))
    return (
        reduce(DataFrame.union, counts)
        .groupBy("tabla")
        .agg(of("raw").alias("conteo_raw"), of("live").alias("conteo_operacional"))
        .withColumn("diferencia", F.col("conteo_raw") - F.col("conteo_operacional"))
        .where(F.col("diferencia") != 0)
    )


def ledger_reconciliation(
    catalog: DataFrame,
    ledger: DataFrame,
    *,
    key: str,
    balance: str,
    amount: str,
    ledger_key: str | None = None,
    ledger_total: str = "suma_ledger",
    keep: Sequence[str] = (),
    scale: int = 4,
) -> DataFrame:
    """Catalogue entries whose cached balance differs from the sum of their movements.

    The difference is rounded to ``scale`` decimals first. Entries without movements have
    nothing to reconcile, and a NULL balance is not flagged.
    """
    totals = ledger.groupBy(F.col(ledger_key or key).alias("__key")).agg(
        F.sum(amount).alias(ledger_total)
    )
    difference = F.round(F.col(balance) - F.col(ledger_total), scale).cast(f"decimal(38,{scale})")
    return (
        catalog.select(key, *keep, balance)
        .join(totals, F.col(key) == F.col("__key"), "inner")
        .select(key, *keep, balance, ledger_total, difference.alias("diferencia"))
        .where(F.col("diferencia") != 0)
    )


def judge_freshness(newest: DataFrame, now: datetime) -> DataFrame:
    """Age of ``max_loaded_at`` of each ``tabla`` against its ``warn_days`` and ``error_days``."""
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    older_than = lambda days: (
        F.col("max_loaded_at") + F.make_dt_interval(days=F.col(days)) < at
    )
    return newest.select(
        "tabla",
        "max_loaded_at",
        F.when(F.col("max_loaded_at").isNull(), "not_computable")
        .when(older_than("error_days"), "error")
        .when(older_than("warn_days"), "warn")
        .otherwise("pass")
        .alias("status"),
    )


def freshness(
    sources: Mapping[str, tuple[DataFrame, str, tuple[int, int]]], now: datetime
) -> DataFrame:
    """Age of the newest load stamp of each table, judged against its limits in days.

    ``sources`` maps a table name to (rows, load stamp column, (warn days, error days)). A
    DATE stamp counts as its midnight. A table without a stamp is ``not_computable``.
    """
    newest = [
        df.agg(F.max(F.col(stamp).cast("timestamp_ntz")).alias("max_loaded_at")).select(
            F.lit(table).alias("tabla"), "max_loaded_at",
            F.lit(warn).alias("warn_days"), F.lit(error).alias("error_days"),
        )
        for table, (df, stamp, (warn, error)) in sources.items()
    ]
    return judge_freshness(reduce(DataFrame.union, newest), now)
