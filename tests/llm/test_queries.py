"""Registered operators and the SQL beside them."""

import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracle import compare, connect
from retailscope.llm.queries import QUERIES, SQL

PER_GROUP = {"op12_source_audit", "op13_nearest_neighbours"}


def test_registered():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) and "pipeline" in queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_row(spark, small, name):
    ok, note = compare(spark, connect(small), small, name)
    assert ok, note
    if name in PER_GROUP:
        return
    table = "pages" if "url" in name else "documents"
    assert queries()[name](spark, small).count() == spark.read.parquet(f"{small}/{table}.parquet").count()
