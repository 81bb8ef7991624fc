"""Values survive loading, odd rows are kept apart, and nothing is cut on the way."""

import glob
import json
import math
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import clean, features, models, neighbours, score, sequences, validate
from retailscope.plans.feature_table import customer_rollup
from retailscope.queries.inputs import rounded
from retailscope.sources import tables
from retailscope.queries.scores import order_spend_errors
from retailscope.sources.transactions import coerce_types, uncoerced
from retailscope.streaming.scoring import request_stream, score_stream

COLUMNS = ("invoice", "quantity", "invoice_date", "price", "customer_id")
SAMPLE = (12345, 15, 8, 450.0, 56.25, 450.0, 2.5, 0.1, 20.0, 0.3, 0.05, 0.2, 65.0)


def test_coercion_changes_no_value(spark):
    rows = [
        ("A", "3000000000", "12/1/2009 8:26", "0.001", "17.0"),
        ("B", "17.5", "2010-01-05 08:26:00", "1.005", "17.00001"),
        ("C", " 4 ", "1.12.2009 8:26", "20000000000", "17"),
        ("D", "x", "never", "0.0000001", None),
        ("E", "1", "2010-01-05", "0.30000000000000004", "1"), ("F", "1", "2010-01-05", "1e-20", "1"), ("G", "1", "2010-01-05", "10000000000000", "1"),
        ("H", "1", "2010-01-05", "1234567890123.5", "1"), ("I", "1", "2010-01-05", "free", "1"), ("J", "1", "2010-01-05", "-0.0000000001", "1"),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r["invoice"]: r for r in coerce_types(df).collect()}
    assert got["A"]["quantity"] == 3_000_000_000 and got["A"]["price"] == Decimal("0.001") and got["A"]["customer_id"] == 17
    assert got["A"]["invoice_date"] == datetime(2009, 12, 1, 8, 26)
    assert got["B"]["quantity"] is None and got["B"]["price"] == Decimal("1.005") and got["B"]["customer_id"] is None
    assert got["C"]["price"] == 20_000_000_000 and got["C"]["quantity"] == 4
    values = {k: r["price_value"] for k, r in got.items()}
    assert values == {"A": 0.001, "B": 1.005, "C": 2e10, "D": 1e-7, "E": 0.1 + 0.2, "F": 1e-20, "G": 1e13, "H": 1234567890123.5, "I": None, "J": -1e-10}
    assert got["D"]["price"] == 0 and got["E"]["price"] == Decimal("0.3") and got["H"]["price"] == Decimal("1234567890123.5")
    flagged = {r["invoice"]: r["is_invalid_price"] for r in clean.flag_invalid_price(coerce_types(df)).collect()}
    assert flagged == {k: k == "J" for k in values}
    twice = coerce_types(df.unionByName(df.where("invoice = 'F'")).unionByName(df.where("invoice = 'F'").withColumn("price", F.lit("2e-20"))))
    assert clean.deduplicate_transactions(twice, COLUMNS).count() == len(rows) + 1
    as_doubles = coerce_types(spark.createDataFrame([(0.1 + 0.2,), (1e-20,), (1e13,)], "price double"))
    assert [r["price_value"] for r in as_doubles.collect()] == [0.1 + 0.2, 1e-20, 1e13]
    lost = {r["invoice"]: r["lost"] for r in uncoerced(df).collect()}
    assert lost == {"B": ["quantity", "customer_id"], "D": ["quantity", "invoice_date"], "I": ["price"]}


def test_rounding_does_not_saturate(spark):
    values = [9.3e12, 1e13 + 0.25, -5e15, 1.0000005, -2.4999995, 0.0]
    got = [r["v"] for r in rounded(spark.createDataFrame([(v,) for v in values], "v double")).collect()]
    assert got[:3] == pytest.approx(values[:3], rel=1e-15) and got[3:] == [1.000001, -2.5, 0.0]


def history(spark, rows):
    schema = "invoice string, stock_code string, quantity bigint, invoice_date timestamp_ntz, price decimal(18,6), customer_id bigint"
    df = spark.createDataFrame([(i, "P", q, d, Decimal(p), c) for i, q, d, p, c in rows], schema)
    return df.withColumns({
        "is_missing_customer_id": F.lit(False), "is_return": F.col("quantity") < 0,
        "is_invalid_price": F.col("price") <= 0, "is_non_product": F.lit(False),
    })


def test_lines_without_invoice_are_money_but_no_order(spark):
    day = lambda d: datetime(2024, 1, d, 10)
    rows = [
        ("A", 1, day(1), "0.001", 1), ("A", 2, day(1), "1.005", 1), (None, 3, day(9), "2", 1), ("B", 1, day(20), "5", 1),
        ("C", 1, day(25), "1", 1), (None, 1, day(2), "7", 2), (None, 4, day(3), "1", 2), ("D", 3_000_000_000, day(4), "9000.5", 3),
    ]
    lines, cutoff = history(spark, rows), datetime(2024, 2, 1)
    fused = {r["customer_id"]: r for r in customer_rollup(lines, cutoff).collect()}
    single = {c: {} for c in fused}
    for compute in (features.compute_rfm, features.compute_basket_size, features.compute_purchase_trend,
                    features.compute_purchase_interval_variance, features.compute_historical_clv,
                    features.compute_seasonal_concentration, features.compute_return_rate):
        for r in compute(lines, cutoff).collect():
            single[r["customer_id"]].update(r.asDict())
    for customer, row in single.items():
        for name, value in row.items():
            assert fused[customer][name] == pytest.approx(value), (customer, name)
    assert fused[1]["frequency"] == 3 and fused[1]["avg_basket_size"] == pytest.approx(4 / 3)
    assert fused[1]["monetary_total"] == pytest.approx(0.001 + 2.01 + 6 + 5 + 1)
    assert fused[1]["purchase_interval_variance"] == pytest.approx(np.var([19, 5], ddof=1))
    assert fused[2]["frequency"] == 0 and fused[2]["avg_basket_size"] == 0 and fused[2]["recency_days"] == 28
    assert fused[3]["monetary_total"] == 27_001_500_000_000.0


def test_rows_with_extra_fields_are_quarantined(spark, tmp_path):
    path = tmp_path / "rows.csv"
    good = ",".join(map(str, SAMPLE))
    path.write_text(",".join(("customer_id", *FEATURE_COLUMNS)) + f"\n{good}\n{good},8,9\n7,abc{good[8:]}\n")
    rows = tables.read_scoring_csv(spark, str(path))
    assert score.batch_summary(rows).first().asDict() == {"n_scored": 1, "n_failed": 2}
    reasons = [r["reasons"] for r in score.split_valid(rows)[1].collect()]
    assert ["row is malformed"] in reasons


def test_stream_with_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    names = ("customer_id", *FEATURE_COLUMNS)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for run in (1, 2):
        inbox = tmp_path / f"inbox{run}"
        inbox.mkdir()
        (inbox / "1.json").write_text(json.dumps(dict(zip(names, (run,) + SAMPLE[1:]))) + "\n")
        scorer = lambda rows: rows.withColumn("probability", F.lit(0.5))
        score_stream(request_stream(spark, str(inbox)), scorer, "m", out, bad, str(tmp_path / f"state{run}")).awaitTermination()
    assert {r["customer_id"] for r in spark.read.parquet(out).collect()} == {1, 2}
    assert len(glob.glob(f"{out}/query=*")) == 2 and not glob.glob(f"{out}/query=None")


def test_schema_report_counts_values(spark):
    df = spark.createDataFrame([("A", None), ("B", None)], "invoice string, price decimal(18,6)")
    report = {r["rule"]: (r["value"], r["passed"]) for r in validate.validate_schema(df, ["invoice", "price", "country"]).collect()}
    assert report == {"column:invoice": (2.0, True), "column:price": (0.0, False), "column:country": (0.0, False)}


def test_cleaned_files_follow_the_data_not_the_tasks(spark, tmp_path):
    lines = spark.range(4000, numPartitions=16).select(
        F.col("id").cast("string").alias("invoice"),
        F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00' + make_dt_interval(CAST(id % 360 AS INT), 0, 0, 0)").alias("invoice_date"),
    )
    tables.write_cleaned(lines, str(tmp_path / "cleaned"))
    assert len(glob.glob(str(tmp_path / "cleaned/*/*/part-*"))) <= 2 * 12


def test_sequences_are_padded_to_the_longest(spark):
    steps = spark.createDataFrame(
        [(1, s, float(s), 0.0, 0.0, 9.0) for s in range(1, 21)] + [(2, 1, 5.0, 0.0, 0.0, 3.0)],
        "customer_id bigint, step int, amount double, gap_days double, category_code double, target double",
    )
    got = {r["customer_id"]: r for r in sequences.padded_sequences(steps).collect()}
    assert len(got[1]["steps"]) == len(got[2]["steps"]) == 20 and got[1]["length"] == 20
    assert got[1]["steps"][19]["amount"] == 20.0


def test_one_search_covers_every_setting(spark):
    rows = spark.range(200).select(
        F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("churned"), (F.col("id") % 5).cast("int").alias("fold"),
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)) + 50 * (F.col("id") % 2)).cast("double").alias(c) for c in FEATURE_COLUMNS],
    )
    grid = models.settings({"max_depth": [2, None], "min_samples_leaf": [1, 5]})
    _, best, auc = models.fit_classifier(rows, "decision_tree", grid)
    assert best in grid and 0.5 < auc <= 1.0


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_vote_equals_brute_force(spark, weights):
    draw = np.random.default_rng(1)
    points = [(i, *np.round(draw.normal(size=2), 1).tolist(), int(draw.integers(0, 2))) for i in range(300)]
    df = spark.createDataFrame(points, "customer_id bigint, x double, y double, churned int")
    got = neighbours.knn_classify(df.where("customer_id < 40"), df.where("customer_id >= 20"), ["x", "y"], 7, weights)
    for r in got.collect():
        _, x, y, _ = points[r["customer_id"]]
        near = sorted((round(math.dist((x, y), p[1:3]), 9), p[0], p[3]) for p in points[20:])[:7]
        weight = [1.0] * 7
        if weights == "distance":
            weight = [float(d == 0) for d, *_ in near] if near[0][0] == 0 else [1 / d for d, *_ in near]
        assert r["probability"] == pytest.approx(sum(w * n[2] for w, n in zip(weight, near)) / sum(weight))
    searched = neighbours.knn_classify(df.where("customer_id < 40"), df.where("customer_id >= 20"), ["x", "y"], 7, weights, max_train_rows=5)
    small, large = ({r["customer_id"]: r["probability"] for r in t.collect()} for t in (got, searched))
    assert small == pytest.approx(large), "more rows than a task takes: cells are searched, all rows vote"


def test_rounded_prices_are_listed_where_exactness_is_asked_for(spark):
    prices = ["0.001", "0.0000001", "0.30000000000000004", "1e-20", "10000000000000", "1234567890123.5", "free", "0", "12.50", "1e21", None]
    df = spark.createDataFrame([(p,) for p in prices], "price string")
    lost = {r["price"] for r in uncoerced(df, exact=True).collect()}
    assert lost == {"0.0000001", "0.30000000000000004", "1e-20", "free"}


def test_customers_without_an_order_have_no_spend_per_order(spark):
    rows = [(1, 10.0, 2, 5.0, 1.0), (1, 30.0, 3, 4.0, 3.0), (1, 7.0, 0, 7.0, 0.0)]
    got = order_spend_errors(spark.createDataFrame(rows, "churned int, monetary_total double, frequency bigint, monetary_avg double, avg_basket_size double"))
    assert [(r["n_rows"], r["mae"]) for r in got.collect()] == [(2, 1.0)]
