"""Physical plans: what must and must not appear in them."""

import re

import pytest

from retailscope.operators import features, sequences
from retailscope.plans import feature_table as feature_table_plan
from retailscope.plans.feature_table import customer_rollup, rollup_by_size
from retailscope.queries.inputs import feature_table, history_input, lines, cutoff
from retailscope.operators.reports import customer_lookup
from retailscope.queries import inputs
from retailscope.sources import shared, star_schema
from retailscope.sources.shared import ROWS_PER_PARTITION, partitions_for


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")  # show pushed filters in full
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rollup(spark, small):
    history, moment = history_input(spark, small)
    return plan(customer_rollup(history, moment))


def test_rollup_is_one_scan_and_four_shuffles(rollup):
    assert rollup.count("Exchange hashpartitioning") == 4
    assert len(re.findall(r"FileScan parquet \[invoice", rollup)) == 1


def test_rollup_broadcasts_thresholds_by_measured_size(rollup):
    assert "BroadcastHashJoin" in rollup and "SortMergeJoin" not in rollup


def test_rollup_has_no_python_and_no_global_sort(rollup):
    assert "Python" not in rollup and "Pandas" not in rollup
    assert "SinglePartition" not in rollup and "rangepartitioning" not in rollup


def test_history_filter_reaches_the_written_table(rollup):
    assert re.search(r"PushedFilters: \[.*LessThan\(invoice_date", rollup)


def test_engagement_ranks_without_sorting_all_customers(spark, small):
    text = plan(features.compute_engagement_score(feature_table(spark, small)))
    for window in re.findall(r"Window \[.*?\], \[(.*?)\]", text):
        assert window  # every window is partitioned


def test_day_bounds_reach_the_order_scan(spark, small):
    moment = cutoff(spark, small)
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(o_orderdate", plan(lines(spark, small, until=moment)))


def test_narrow_reads(spark, small):
    text = plan(star_schema.transactions(spark, small, ("quantity", "price")))
    assert "p_name" not in text and "n_name" not in text and "o_totalprice" not in text
    assert "o_orderdate" not in text


def test_lookup_is_pushed_down(spark, small):
    assert "EqualTo(customer_id,12042)" in plan(customer_lookup(feature_table(spark, small), 12042))


def test_rollup_by_size_moves_lines_once(spark, small):
    history, moment = history_input(spark, small)
    assert plan(rollup_by_size(history, moment)).count("Exchange hashpartitioning") == 1


def test_rollup_by_size_spreads_hot_customers(spark, small, monkeypatch):
    history, moment = history_input(spark, small)
    want = sorted(map(tuple, customer_rollup(history, moment).collect()))
    monkeypatch.setattr(feature_table_plan, "HOT_LINES", 25)
    monkeypatch.setattr(feature_table_plan, "HOT_GROUPS", 200)
    mixed = rollup_by_size(history, moment)
    assert plan(mixed).count("Exchange hashpartitioning") == 5  # some customers are hot, the others are not
    got = sorted(map(tuple, mixed.collect()))
    assert [r[:1] for r in got] == [r[:1] for r in want]
    for mine, theirs in zip(got, want):
        assert mine == pytest.approx(theirs, rel=1e-12)


def test_partitions_follow_the_rows(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with partitions_for(spark, 40 * ROWS_PER_PARTITION + 1):
        assert spark.conf.get(name) == "41"
    with partitions_for(spark, 10):
        assert spark.conf.get(name) == before
    assert spark.conf.get(name) == before


def test_sequences_read_written_orders_not_lines(spark, small):
    history, moment = history_input(spark, small)
    text = plan(sequences.purchase_sequences(history, moment))
    assert "FileScan parquet" in text and "stock_code" not in text and "quantity" not in text


def test_cutoff_is_found_in_partitions_sized_by_rows(spark, small, monkeypatch):
    name, seen, found = "spark.sql.shuffle.partitions", [], features.cutoff_date
    monkeypatch.setattr(shared, "ROWS_PER_PARTITION", 500)
    monkeypatch.setattr(inputs, "_cutoffs", {})
    monkeypatch.setattr(features, "cutoff_date", lambda *given: seen.append(int(spark.conf.get(name))) or found(*given))
    assert inputs.cutoff(spark, small) is not None
    assert seen == [-(-inputs.line_count(spark, small) // 500)] and seen[0] > int(spark.conf.get(name))
