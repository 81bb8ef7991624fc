"""Every registered query with SQL gives the SQL's values; the others give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect

SLOW = {"model_mlp", "model_comparison", "model_timing"}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query_agrees_with_sql(spark, duck, small, name):
    ok, note = compare(spark, duck, small, name)
    assert ok, note


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_statements_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
