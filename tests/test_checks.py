"""Every check must pass on sound rows and be seen to fail on bad ones."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from aprisco.quality import (
    Check,
    Verdict,
    accepted_values,
    count_reconciliation,
    freshness,
    ledger_reconciliation,
    not_null,
    not_null_within,
    relationships,
    run_checks,
    unique,
)
from aprisco.quality.runner import count_failures


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_unique_ignores_null(spark, rows):
    assert rows(unique(_values(spark, "a", "b", None, None), "v")) == []
    assert rows(unique(_values(spark, "a", "b", "a", "a", None), "v")) == [("a", 3)]


def test_unique_of_several_columns(spark, rows):
    df = spark.createDataFrame(
        [(1, "x"), (1, "y"), (2, "x"), (2, "x"), (3, None), (3, None)], "a int, b string"
    )
    assert rows(unique(df, "a", "b")) == [(2, "x", 2)]


def test_not_null(spark, rows):
    assert rows(not_null(_values(spark, "a"), "v")) == []
    assert rows(not_null(_values(spark, "a", None, None), "v")) == [(None,), (None,)]


def test_not_null_with_tolerance_under_a_condition(spark, rows):
    df = spark.createDataFrame(
        [("old", "x"), ("old", None), ("old", "x"), ("old", "x"), ("young", None)],
        "age string, tag string",
    )
    assert rows(not_null_within(df, "tag", 0.25, "age = 'old'")) == []
    assert rows(not_null_within(df, "tag", 0.2, "age = 'old'")) == [(4, 1, 0.25)]
    assert rows(not_null_within(df, "tag", 0.25)) == [(5, 2, 0.4)]
    assert rows(not_null_within(df, "tag", 0.0, "age = 'nobody'")) == []


def test_accepted_values_pass_null(spark, rows):
    assert rows(accepted_values(_values(spark, "a", None), "v", ["a", "b"])) == []
    assert rows(accepted_values(_values(spark, "a", "z", "z"), "v", ["a", "b"])) == [("z", 2)]


def test_relationships_pass_null(spark, rows):
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert rows(relationships(_values(spark, "a", "a", None), "v", parent, "name")) == []
    assert rows(relationships(_values(spark, "a", "z", "z", None), "v", parent, "name")) == [("z", 2)]
    empty = parent.limit(0)
    assert rows(relationships(_values(spark, "a"), "v", empty, "name")) == [("a", 1)]


def test_count_reconciliation(spark, rows):
    one, two = _values(spark, "a"), _values(spark, "a", "b")
    none = _values(spark, "a").limit(0)
    assert rows(count_reconciliation({"t": (two, two), "e": (none, none)})) == []
    assert rows(count_reconciliation({"t": (one, two), "u": (two, none), "v": (two, two)})) == [
        ("t", 1, 2, -1), ("u", 2, 0, 2),
    ]


def test_ledger(spark, rows):
    catalog = spark.createDataFrame(
        [
            ("exact", Decimal("3")), ("below_scale", Decimal("3.00004")),
            ("off", Decimal("3.00005")), ("no_movements", Decimal("9")), ("no_balance", None),
        ],
        "id string, balance decimal(38,9)",
    )
    moves = [("exact", 5), ("exact", -2), ("below_scale", 3), ("off", 3), ("no_balance", 1)]
    ledger = spark.createDataFrame(
        [(k, Decimal(v)) for k, v in moves], "id string, amount decimal(38,9)"
    )
    found = ledger_reconciliation(catalog, ledger, key="id", balance="balance", amount="amount")
    assert found.columns == ["id", "balance", "suma_ledger", "diferencia"]
    # Half rounds up, away from zero.
    assert rows(found, "id", "diferencia") == [("off", Decimal("0.0001"))]


@pytest.mark.parametrize(
    ("newest", "status"),
    [
        (datetime(2026, 3, 15, 12), "pass"), (datetime(2026, 3, 15, 11, 59), "warn"),
        (datetime(2026, 3, 6, 12), "warn"), (datetime(2026, 3, 6, 11), "error"),
        (None, "not_computable"),
    ],
)
def test_freshness(spark, rows, newest, status):
    now = datetime(2026, 3, 20, 12)
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (newest,)], "at timestamp_ntz")
    if newest is None:
        df = df.limit(0)
    assert rows(freshness({"t": (df, "at", (5, 14))}, now), "tabla", "status") == [("t", status)]


def test_freshness_of_a_date_stamp(spark, rows):
    df = spark.createDataFrame([(date(2026, 3, 6),)], "at date")
    found = freshness({"t": (df, "at", (14, 45))}, datetime(2026, 3, 20, 0, 0, 1))
    assert rows(found) == [("t", datetime(2026, 3, 6), "warn")]


def test_runner_judges_all_checks_of_a_table(spark):
    tables = {
        "child": spark.createDataFrame(
            [(1, "a", "ok"), (1, "z", "bad"), (2, "z", None), (None, None, "ok")],
            "id int, parent string, state string",
        ),
        "parent": _values(spark, "a"),
    }
    rules = [
        Check("unique", "child", ("id",)),
        Check("not_null", "child", ("id",)),
        Check("not_null", "child", ("state",), severity="warn"),
        Check("accepted_values", "child", ("state",), values=("ok",)),
        Check("relationships", "child", ("parent",), parent="parent", field="v"),
        Check("unique", "parent", ("v",)),
        Check("not_null", "parent", ("v",)),
        Check("unique", "child", ("id", "parent")),
        Check("not_null_within", "child", ("state",), max_null_fraction=0.3, condition="id = 2"),
        Check("not_null_within", "child", ("id",), max_null_fraction=0.3),
    ]
    verdicts = run_checks(rules, tables.__getitem__)
    assert [(v.failures, v.status) for v in verdicts] == [
        (1, "fail"), (1, "fail"), (1, "warn"), (1, "fail"), (2, "fail"), (0, "pass"), (0, "pass"),
        (0, "pass"), (1, "fail"), (0, "pass"),
    ]
    with pytest.raises(ValueError, match="unknown kind"):
        run_checks([Check("odd", "child", ("id",))], tables.__getitem__)
    assert run_checks([], tables.__getitem__) == []


def test_verdict_of_a_warning_never_fails():
    assert Verdict("c", "warn", 3).status == "warn"
    assert Verdict("c", "error", 0).status == "pass"


def test_key_checks_read_each_table_once(spark, tmp_path, rows):
    tables = {}
    for name, data in {
        "child": [(1, 1), (1, 2), (2, 9), (3, None), (None, 9)],
        "parent": [(1, 1), (2, 2), (2, 3)],
    }.items():
        spark.createDataFrame(data, "id int, ref int").write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    rules = [
        Check("unique", "child", ("id",)), Check("unique", "parent", ("id",)),
        Check("unique", "parent", ("ref",)),
        Check("relationships", "child", ("ref",), parent="parent", field="id"),
        Check("relationships", "child", ("id",), parent="parent", field="ref"),
    ]
    found = count_failures(rules, tables.__getitem__)
    assert rows(found) == sorted(
        [(rules[0].id, 1), (rules[1].id, 1), (rules[2].id, 0), (rules[3].id, 2), (rules[4].id, 0)], key=repr
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 + 2  # a scan per table for its own rules, one per parent key


def test_rules_of_a_table_share_a_scan_and_an_exchange(spark, tmp_path, rows):
    tables = {}
    for name, data in {"child": [(1, 1), (1, 2), (2, 9), (3, None), (None, 9)], "parent": [(1, 1), (2, 2), (2, 3)]}.items():
        spark.createDataFrame(data, "id int, ref int").write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    rules = [
        Check("unique", "child", ("id",)), Check("not_null", "child", ("id",)), Check("not_null", "child", ("ref",)),
        Check("accepted_values", "child", ("ref",), values=(1, 2)), Check("accepted_values", "parent", ("id",), values=(1, 2)),
        Check("relationships", "child", ("ref",), parent="parent", field="id"),
        Check("relationships", "parent", ("ref",), parent="parent", field="id"),
    ]
    expected = sorted(zip([r.id for r in rules], (1, 1, 1, 2, 0, 2, 1)), key=repr)
    assert rows(count_failures(rules, tables.__getitem__)) == expected
    found = count_failures(rules, tables.__getitem__, one_scan=True)
    assert rows(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 + 1 and plan.count("hashpartitioning(rule") == 2  # values, then rules


def test_references_are_compared_in_their_common_type(spark):
    tables = {
        "child": spark.createDataFrame([(Decimal(1),), (Decimal("2.5"),), (None,)], "k decimal(38,9)"),
        "parent": spark.createDataFrame([(1,), (2,)], "k bigint"),
        "small": spark.createDataFrame([(1,), (7,)], "k int"),
    }
    rules = [Check("relationships", t, ("k",), parent="parent", field="k") for t in ("child", "small")]
    verdicts = {v.check_id: v.failures for v in run_checks(rules, tables.__getitem__)}
    assert [verdicts[r.id] for r in rules] == [1, 1]
    for rule in rules:
        assert rule.failing(tables.__getitem__).count() == 1


def test_rows_are_watched_while_they_are_written(spark, tmp_path):
    from aprisco.quality import watch

    df = spark.createDataFrame([("a", "x"), (None, "y"), (None, None)], "k string, v string").repartition(3)
    rules = [Check("not_null", "t", ("k",)), Check("accepted_values", "t", ("v",), values=("x",)), Check("unique", "t", ("k",))]
    for name, rows, expected in (("some", df, [2, 1]), ("none", df.limit(0), [0, 0])):
        watched, found = watch(rows, rules, "t")
        watched.write.parquet(f"{tmp_path}/{name}")
        assert list(found().values()) == expected and list(found()) == [r.id for r in rules[:2]]
    same, nothing = watch(df, rules, "other")
    assert same is df and nothing() == {}
    known = {rules[0].id: 2, rules[1].id: 1}
    assert [v.failures for v in run_checks(rules, lambda name: df, known)] == [2, 1, 0]
