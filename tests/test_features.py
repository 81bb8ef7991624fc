"""Hand-built transactions with known answers: leakage, labels, boundaries and odd values."""

from datetime import datetime
from decimal import Decimal

import pytest

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import features as ops
from retailscope.operators.clean import add_row_flags, clean_for_features, clean_transactions
from retailscope.plans.feature_table import customer_features, customer_rollup
from retailscope.queries.inputs import cutoff, lines
from retailscope.schema import TRANSACTION_TYPES
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUTOFF = datetime(2024, 2, 1)
SCHEMA = T.StructType([T.StructField(n, t) for n, t in TRANSACTION_TYPES.items()])

TOY = [
    ("INV1", "A1", "Item A", 2, "2024-01-01", 10.0, 1),
    ("INV2", "A1", "Item A", 1, "2024-01-15", 10.0, 1),
    ("INV3", "A2", "Item B", 3, "2024-01-10", 5.0, 2),
    ("INV4", "A2", "Item B", 1, "2024-02-20", 5.0, 2),
    ("INV5", "A3", "Item C", 1, "2024-01-05", 20.0, 3),
    ("INV6", "A3", "Item C", 1000, "2024-03-01", 999.0, 3),
]


def make(spark, rows):
    typed = [
        (inv, code, text, q, datetime.fromisoformat(ts), None if p is None else Decimal(str(p)), who, "UK")
        for inv, code, text, q, ts, p, who in rows
    ]
    return spark.createDataFrame(typed, SCHEMA)


def by_customer(df):
    return {r["customer_id"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def toy(spark):
    return clean_transactions(make(spark, TOY))


def test_value_excludes_future_purchase(toy):
    assert by_customer(ops.compute_historical_clv(toy, CUTOFF))[3]["historical_clv"] == 20.0


def test_recency_uses_the_past_only(toy):
    assert by_customer(ops.compute_rfm(toy, CUTOFF))[2]["recency_days"] == 22


def test_label_matches_known_behaviour(toy):
    label = {k: v["churned"] for k, v in by_customer(ops.compute_churn_label(toy, CUTOFF)).items()}
    assert label == {1: 1, 2: 0, 3: 0}


def test_table_is_blind_to_the_future(spark, toy):
    whole = by_customer(customer_features(toy, CUTOFF, include_label=False))
    truncated = clean_transactions(make(spark, [r for r in TOY if r[4] < "2024-02-01"]))
    assert whole == by_customer(customer_features(truncated, CUTOFF, include_label=False))


def test_engagement_is_bounded(toy):
    scores = [r["engagement_score"] for r in customer_features(toy, CUTOFF).collect()]
    assert len(scores) == 3 and all(0 <= s <= 100 for s in scores)


def test_returns_are_flagged_not_dropped(toy):
    assert toy.count() == 6 and toy.where("is_return").count() == 0


def test_missing_customer_gives_an_empty_table(spark):
    lines_ = clean_transactions(make(spark, [("INV1", "A1", "Item A", 1, "2024-01-01", 10.0, None)]))
    table = customer_features(lines_, CUTOFF)
    assert table.count() == 0 and set(FEATURE_COLUMNS) <= set(table.columns)


def test_zero_net_spend_has_zero_concentration(spark):
    rows = [("INV1", "A1", "Item A", 1, "2024-01-01", 10.0, 1), ("C-INV1", "A1", "Item A", -1, "2024-01-02", 10.0, 1)]
    assert by_customer(customer_features(clean_transactions(make(spark, rows)), CUTOFF))[1]["seasonal_concentration"] == 0.0


def test_boundaries_of_history_and_window(spark):
    rows = [
        ("A", "P", "x", 1, "2024-01-31T23:59:00", 1.0, 1),
        ("B", "P", "x", 1, "2024-02-01T00:00:00", 1.0, 1),  # exactly at the cutoff: neither side
        ("C", "P", "x", 1, "2024-01-31T00:10:00", 1.0, 2),
        ("D", "POST", "x", -1, "2024-05-01T00:00:00", 0.0, 2),  # last moment of the window still counts
        ("E", "P", "x", 1, "2024-01-30T00:00:00", 1.0, 3),
        ("F", "P", "x", 1, "2024-05-01T00:00:01", 1.0, 3),  # one second too late
    ]
    table = by_customer(customer_features(clean_for_features(make(spark, rows)), CUTOFF))
    assert {k: v["churned"] for k, v in table.items()} == {1: 1, 2: 0, 3: 1}
    assert table[1]["frequency"] == 1
    assert table[2]["recency_days"] == 0  # 23 h 50 min


def test_odd_values(spark):
    rows = [
        ("A", "P", "x", 1, "2023-12-01T10:00:00", 10.0, 1),
        ("A", "P", "x", 2, "2024-01-20T10:00:00", 10.0, 1),  # one invoice in two periods and two months
        ("B", "P", "x", -2, "2024-01-25T10:00:00", 20.0, 1),  # a month with negative spend
        ("C", "Q", "x", 5, "2024-01-01T10:00:00", None, 2),  # no price: counted, adds nothing
        ("D", None, "x", 1, "2024-01-02T10:00:00", 3.0, 2),  # no stock code
        ("E", "Q", "x", None, "2024-01-03T10:00:00", 3.0, 2),  # no quantity
    ]
    lines_ = clean_for_features(make(spark, rows))
    fused = by_customer(customer_rollup(lines_, CUTOFF))
    assert fused[1]["frequency"] == 2 and fused[1]["monetary_total"] == -10.0
    assert fused[1]["seasonal_concentration"] == pytest.approx((10**2 + 20**2) / 10**2)
    # one order in period 2 (A, 61 days back), two in period 0 (A and B): slope (2 - 1) / (0 - -2)
    assert fused[1]["purchase_trend_slope"] == pytest.approx(0.5)
    assert fused[2]["monetary_total"] == 3.0 and fused[2]["return_rate"] == 0.0
    assert fused[2]["monetary_avg"] == 3.0


def test_fused_table_equals_single_operators(spark, small):
    moment = cutoff(spark, small)
    history = lines(spark, small)
    fused = by_customer(customer_features(history, moment))
    rfm = ops.compute_rfm(history, moment)
    for single in (
        rfm, ops.compute_historical_clv(history, moment), ops.compute_basket_size(history, moment),
        ops.compute_purchase_trend(history, moment), ops.compute_purchase_interval_variance(history, moment),
        ops.compute_seasonal_concentration(history, moment), ops.compute_return_rate(history, moment),
        ops.compute_discount_sensitivity(history, moment), ops.compute_engagement_score(rfm),
        ops.compute_churn_label(history, moment),
    ):
        for who, row in by_customer(single).items():
            for name, value in row.items():
                assert fused[who][name] == pytest.approx(value, rel=1e-12, abs=1e-12), (who, name)


def test_result_does_not_depend_on_partitioning(spark, small):
    moment = cutoff(spark, small)
    history = lines(spark, small)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(by_customer(customer_features(history, moment)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0].keys() == seen[1].keys()
    for who, row in seen[0].items():
        assert row == pytest.approx(seen[1][who], rel=1e-12)


def test_one_customer_holding_a_third_of_all_lines(spark):
    """A hot customer, invoice, product and price give the same result as a direct count."""
    hot = (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), F.col("id"))).alias("invoice"),
            F.when(F.col("id") % 3 == 0, "P").otherwise(F.concat(F.lit("P"), F.col("id") % 7)).alias("stock_code"),
            F.lit("x").alias("description"),
            (F.col("id") % 5 + 1).cast("int").alias("quantity"),
            F.expr("TIMESTAMP_NTZ'2023-06-01 00:00:00' + make_dt_interval(CAST(id % 200 AS INT), 0, CAST(id % 60 AS INT), 0)").alias("invoice_date"),
            F.lit(2).cast("decimal(12,2)").alias("price"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("bigint").alias("customer_id"),
            F.lit("UK").alias("country"),
        )
    )
    lines_ = clean_for_features(hot)
    table = by_customer(customer_features(lines_, CUTOFF))
    direct = by_customer(
        lines_.groupBy("customer_id").agg(
            F.countDistinct("invoice").alias("frequency"), F.sum(F.col("quantity") * 2).alias("monetary_total")
        )
    )
    assert {k: (v["frequency"], v["monetary_total"]) for k, v in table.items()} == {
        k: (v["frequency"], float(v["monetary_total"])) for k, v in direct.items()
    }


def test_flags_of_missing_values(spark):
    row = add_row_flags(make(spark, [("A", None, None, None, "2024-01-01", None, None)])).first()
    assert (row["is_missing_customer_id"], row["is_return"], row["is_invalid_price"], row["is_non_product"]) == (
        True, None, False, False,
    )
