"""What the physical plans of the registered queries must and must not contain."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as registry
from tests.test_joins import _with

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")

QUERIES = {k: v for k, v in registry.queries().items() if k not in registry.LLM_QUERIES}
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def plan(spark, name, mode="formatted"):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


# Whole refreshes, and what stores many tables first, leave no plan to look at.
STORED = ("layered_refresh", "refresh_verdicts", "raw_profile_sketched", "raw_column_profile")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("suite_") and n not in STORED])
def test_no_cross_joins_and_no_python(spark, name):
    """Even where nothing is small enough to broadcast."""
    text = _with(spark, NO_BROADCAST, lambda: plan(spark, name))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit",
                     "BroadcastHashJoin"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "valid_rows")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in text
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan(spark, "check_unique")
    # A count reads no column; a freshness check reads one.
    assert "ReadSchema: struct<>" in plan(spark, "reconcile_counts")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan(spark, "freshness")
    # Reports read only what they show, through all layers.
    births = plan(spark, "rpt_nacimientos_recientes")
    assert "o_totalprice" not in births and "s_acctbal" not in births


def test_star_joins_broadcast_small_dimensions(spark):
    text = plan(spark, "rpt_nacimientos_recientes")
    assert text.count("BroadcastHashJoin Inner") == 2
    assert "Exchange hashpartitioning" not in text


def test_version_join_reduces_before_the_shuffle(spark):
    text = _with(spark, NO_BROADCAST, lambda: plan(spark, "asof_version", "simple"))
    # Facts meet versions only as distinct (key, day) pairs, folded on the map side.
    scans = re.findall(r"Scan parquet \[(\S+)\]", re.sub(r"#\d+L?", "", text))
    assert sorted(scans) == [
        "c_custkey,c_mktsegment", "event_id,ts,user_id,event_type",
        "event_id,ts,user_id,event_type,value", "ts,user_id,event_type",
    ]
    # Their ids were seen not to repeat, so nothing is ranked.
    assert "WindowGroupLimit" not in text
    assert re.findall(r"SortMergeJoin.*, (\w+)\n", text) == ["LeftOuter", "LeftAnti"]
    unique = _with(spark, NO_BROADCAST, lambda: plan(spark, "asof_overlapping", "simple"))
    assert "WindowGroupLimit" not in unique


def test_history_is_one_shuffle(spark):
    text = plan(spark, "snapshot_replay", "simple")
    # One to reduce the events to daily copies, one for all windows of the replay.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Window [") == 2


def test_anomalies_are_scored_after_the_reduction(spark):
    text = plan(spark, "volume_anomaly", "simple")
    assert text.count("partial_count(1)") == 3
