"""Runs a set of checks over named relations with few passes over the data."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from aprisco.quality import checks as q

WARN, ERROR = "warn", "error"


@dataclass(frozen=True)
class Check:
    """A rule on a relation. ``kind`` names a function of ``aprisco.quality.checks``."""

    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = ERROR
    values: tuple[str, ...] = ()
    parent: str | None = None
    field: str | None = None
    # Only for ``not_null_within``.
    max_null_fraction: float = 0.0
    condition: str | None = None

    @property
    def id(self) -> str:
        target = f"__{self.parent}_{self.field}" if self.parent else ""
        return f"{self.kind}_{self.table}__{'_'.join(self.columns)}{target}"

    def failing(self, relation: Callable[[str], DataFrame]) -> DataFrame:
        """The rows or values that break the rule."""
        df, first = relation(self.table), self.columns[0]
        if self.kind == "unique":
            return q.unique(df, *self.columns)
        if self.kind == "not_null":
            return q.not_null(df, first)
        if self.kind == "accepted_values":
            return q.accepted_values(df, first, self.values)
        if self.kind == "relationships":
            return q.relationships(df, first, relation(self.parent), self.field)
        if self.kind == "not_null_within":
            return q.not_null_within(df, first, self.max_null_fraction, self.condition)
        raise ValueError(f"unknown kind of check: {self.kind}")


@dataclass(frozen=True)
class Verdict:
    check_id: str
    severity: str
    failures: int
    finding: str | None = None  # what a monitor found, in its own words

    @property
    def status(self) -> str:
        if self.finding:
            return self.finding
        if not self.failures:
            return "pass"
        return "warn" if self.severity == WARN else "fail"


class CheckFailed(RuntimeError):
    """Checks of severity error found offending rows."""

    def __init__(self, verdicts: Sequence[Verdict]):
        self.verdicts = list(verdicts)
        super().__init__(
            "; ".join(f"{v.check_id}: {v.failures}" for v in verdicts if v.status == "fail")
        )


ROW_KINDS = ("not_null", "accepted_values")


def _breaks(rule: Check) -> Column:
    """Whether a row breaks a row-by-row rule."""
    column = F.col(rule.columns[0])
    return column.isNull() if rule.kind == "not_null" else ~column.isin(*rule.values)


def row_counts(rules: Iterable[Check], table: str) -> dict[str, Column]:
    """For each row-by-row rule of a table, by its id, the count of rows that break it."""
    counts = {}
    for rule in rules:
        if rule.table == table and rule.kind in ROW_KINDS:
            counts[rule.id] = F.count_if(_breaks(rule))
    return counts


def watch(df: DataFrame, rules: Iterable[Check], table: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows, and what tells how many of them break each row-by-row rule, once a job has been
    through all of them: a write then pays for its checks without a scan of its own.

    The rows must be counted by the tasks that deliver them, after the last shuffle. A task there
    counts once however often it is tried, which is not true of one that feeds a shuffle.
    """
    counts = row_counts(rules, table)
    if not counts:
        return df, dict
    observation = Observation()
    watched = df.observe(observation, *[c.alias(f"c{i}") for i, c in enumerate(counts.values())])

    def found() -> dict[str, int]:
        seen = observation.get  # empty if there were no rows to be seen
        return {name: int(seen.get(f"c{i}", 0)) for i, name in enumerate(counts)}

    return watched, found


def _row_rules(df: DataFrame, rules: Sequence[Check]) -> DataFrame:
    """Offending rows of all row-by-row rules of a table, counted in one scan."""
    counts = df.agg(*[F.count_if(_breaks(r)).alias(f"c{i}") for i, r in enumerate(rules)])
    found = [F.struct(F.lit(r.id).alias("check_id"), F.col(f"c{i}").alias("failures")) for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*found)))


def _common_type(spark: SparkSession, kinds: Sequence[DataType]) -> DataType:
    """The type in which values of these types are compared."""
    distinct = list(dict.fromkeys(kinds))
    if len(distinct) == 1:
        return distinct[0]
    return spark.range(0).select(F.coalesce(*[F.lit(None).cast(k) for k in distinct])).schema[0].dataType


def _single_column_rules(rules: Sequence[Check], relation: Callable[[str], DataFrame]) -> DataFrame:
    """Offending rows or values of all rules on one column, from one scan per table.

    Every row gives a (rule, value) pair for each of its keys and references, and one for each
    row-by-row rule that it breaks. Pairs are folded on the map side, and one exchange counts them.
    The keys of a parent, read once, go through the same exchange as known values of the rules that
    refer to it, so nothing is joined. A reference and the key that it refers to are cast to their
    common type, as a join does it, and compared as text, which tells the same values of a type apart.
    """
    by_table: dict[str, list[tuple[int, Check]]] = defaultdict(list)
    for number, rule in enumerate(rules):
        by_table[rule.table].append((number, rule))
    parents = list(dict.fromkeys((r.parent, r.field) for r in rules if r.parent))
    common: dict[tuple, DataType] = {}
    for table, key in parents:
        kinds = [relation(table).schema[key].dataType]
        kinds += [relation(r.table).schema[r.columns[0]].dataType for r in rules if (r.parent, r.field) == (table, key)]
        common[table, key] = _common_type(relation(table).sparkSession, kinds)

    def text(rule: Check) -> Column:
        column = F.col(rule.columns[0])
        if rule.kind in ROW_KINDS:
            return F.when(_breaks(rule), F.lit(""))
        return (column.cast(common[rule.parent, rule.field]) if rule.parent else column).cast("string")

    scans = []
    for table, own in by_table.items():
        values = relation(table).select(*[text(r).alias(str(n)) for n, r in own])
        scans.append(values.unpivot([], values.columns, "rule", "value").withColumn("known", F.lit(False)))
    for table, key in parents:
        value = F.col(key).cast(common[table, key]).cast("string")
        referring = [n for n, r in enumerate(rules) if (r.parent, r.field) == (table, key)]
        values = relation(table).select(*[value.alias(str(n)) for n in referring])
        scans.append(values.unpivot([], values.columns, "rule", "value").withColumn("known", F.lit(True)))
    counts = reduce(DataFrame.union, scans).where("value IS NOT NULL").groupBy("rule", "value").agg(
        F.count_if(~F.col("known")).alias("n"), F.max("known").alias("known")
    )
    is_key = F.col("rule").isin([str(n) for n, r in enumerate(rules) if r.kind == "unique"])
    broken = F.when(is_key, F.when(F.col("n") > 1, 1)).when(~F.col("known"), F.col("n"))
    found = counts.groupBy("rule").agg(F.coalesce(F.sum(broken), F.lit(0)).alias("broken"))
    names = [F.struct(F.lit(str(n)).alias("rule"), F.lit(r.id).alias("check_id")) for n, r in enumerate(rules)]
    listed = found.sparkSession.range(1).select(F.inline(F.array(*names)))
    # A rule without any value has no row of its own
    return listed.join(found, "rule", "left").select(
        "check_id", F.coalesce("broken", F.lit(0)).cast("long").alias("failures")
    )


def count_failures(
    rules: Iterable[Check], relation: Callable[[str], DataFrame], one_scan: bool = False
) -> DataFrame:
    """One row per check: its id and how many rows or values break it, as one plan.

    ``not_null`` and ``accepted_values`` of a table share a scan, and so do ``unique`` and
    ``relationships`` on one column; with ``one_scan``, for relations that are plans and made anew by
    every scan, all four share one. Other checks have their own.
    """
    rules = list(rules)
    by_row, single, parts = defaultdict(list), [], []
    for rule in rules:
        if rule.kind in ROW_KINDS and not one_scan:
            by_row[rule.table].append(rule)
        elif rule.kind in ROW_KINDS or (rule.kind in ("unique", "relationships") and len(rule.columns) == 1):
            single.append(rule)
        else:
            parts.append(
                rule.failing(relation)
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(rule.id).alias("check_id"), "failures")
            )
    if single:
        parts.append(_single_column_rules(single, relation))
    parts += [_row_rules(relation(table), own) for table, own in by_row.items()]
    return reduce(DataFrame.union, parts)


def run_checks(
    rules: Iterable[Check], relation: Callable[[str], DataFrame], known: Mapping[str, int] | None = None
) -> list[Verdict]:
    """Verdict of every check. What reaches the driver is one row per check. ``known`` has the
    failures of those that were counted already, by ``watch`` say."""
    rules, found = list(rules), dict(known or {})
    open_ = [r for r in rules if r.id not in found]
    if open_:
        found |= {r["check_id"]: r["failures"] for r in count_failures(open_, relation, one_scan=True).collect()}
    return [Verdict(r.id, r.severity, int(found[r.id])) for r in rules]
