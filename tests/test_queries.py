"""Every registered query against its reference SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from testbed.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")

# The optional operators on text have their own tests.
QUERIES = {k: v for k, v in registry.queries().items() if k not in registry.LLM_QUERIES}
ORACLES = {k: v for k, v in registry.oracle_sql().items() if k not in registry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_reference_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        n, notes = differences(df, con, ORACLES[name])
        assert notes == []
    else:
        n = df.count()
    assert n > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0
