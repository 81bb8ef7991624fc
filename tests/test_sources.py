"""Sources, sinks, the online stream and the end-to-end run."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailscope.config import FALLBACK_MODEL_NAME, FEATURE_COLUMNS, RunConfig, load_config
from retailscope.operators import models, score
from retailscope.plans.run import run
from retailscope.queries import explain as explain_queries
from retailscope.queries.inputs import CONFIG, feature_table, raw
from retailscope.sources import tables
from retailscope.sources.shared import materialize, shared_folder
from retailscope.sources.transactions import load_raw_transactions
from retailscope.streaming.scoring import request_stream, score_stream

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,{},Country\n"
SAMPLE = (12345, 15, 8, 450.0, 56.25, 450.0, 2.5, 0.1, 20.0, 0.3, 0.05, 0.2, 65.0)


@pytest.fixture
def sheets(tmp_path):
    first, second = tmp_path / "first.csv", tmp_path / "second.csv"
    first.write_text(HEADER.format("Customer ID") + 'A1,85123,"MUG, RED",6,2010-01-05 08:26:00,2.55,13085.0,UK\nA2,POST,,x,never,free,,UK\n')
    second.write_text(HEADER.format("CustomerID") + "C3,85123,MUG,-1,2011-02-01 09:00:00,2.5,13085,France\n")
    return {"Year 1": str(first), "Year 2": str(second)}


def test_load_union_of_sheets(spark, sheets):
    rows = {r["invoice"]: r for r in load_raw_transactions(spark, sheets).collect()}
    assert rows["A1"]["customer_id"] == 13085 and rows["A1"]["price"] == Decimal("2.55")
    assert rows["A1"]["invoice_date"] == datetime(2010, 1, 5, 8, 26) and rows["A1"]["source_sheet"] == "Year 1"
    assert rows["A2"]["quantity"] is rows["A2"]["price"] is rows["A2"]["invoice_date"] is rows["A2"]["customer_id"] is None
    assert rows["C3"]["quantity"] == -1 and rows["C3"]["source_sheet"] == "Year 2"


def test_missing_file_and_column(spark, sheets, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw_transactions(spark, {"x": str(tmp_path / "none.csv")})
    short = tmp_path / "short.csv"
    short.write_text("Invoice,StockCode\nA,B\n")
    with pytest.raises(ValueError, match="customer_id"):
        load_raw_transactions(spark, {"x": str(short)})


def test_config_file(tmp_path):
    path = tmp_path / "run.yaml"
    path.write_text("churn_window_days: 30\nnon_product_codes: [POST]\n")
    config = load_config(str(path))
    assert config.churn_window_days == 30 and config.non_product_codes == ("POST",) and config.iqr_multiplier == 1.5


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
    kept = materialize(spark.range(3), "probe")
    assert kept.count() == 3 and shared_folder(spark) in kept.inputFiles()[0]


def test_scoring_csv_isolates_bad_rows(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_scoring_csv(spark, str(tmp_path / "rows.txt"))
    path = tmp_path / "rows.csv"
    good = ",".join(map(str, SAMPLE))
    negative = ",".join(map(str, (12346, -5) + SAMPLE[2:]))
    path.write_text(",".join(("customer_id", *FEATURE_COLUMNS)) + f"\n{good}\n{negative}\n12347\n")
    rows = tables.read_scoring_csv(spark, str(path))
    assert score.batch_summary(rows).first().asDict() == {"n_scored": 1, "n_failed": 2}
    _, bad = score.split_valid(rows)
    reasons = {r["customer_id"]: r["reasons"] for r in bad.collect()}
    assert reasons[12346] == ["recency_days must be at least 0"] and len(reasons[12347]) == len(FEATURE_COLUMNS)


def test_a_column_the_file_lacks_fails_its_rows_only(spark):
    rows = spark.createDataFrame([SAMPLE], ["customer_id", *FEATURE_COLUMNS]).drop("frequency")
    assert score.batch_summary(rows).first()["n_failed"] == 1


def test_features_by_cutoff(spark, small, tmp_path):
    path = str(tmp_path / "features")
    assert tables.read_features(spark, path).count() == 0
    table = feature_table(spark, small)
    for day in (1, 2, 2):
        tables.write_features(table, path, datetime(2001, 5, day))
    back = tables.read_features(spark, path)
    assert back.count() == 2 * table.count() and back.select("cutoff_date").distinct().count() == 2


def test_records_append(spark, tmp_path):
    target = str(tmp_path / "predictions")
    rows = spark.createDataFrame([SAMPLE], ["customer_id", *FEATURE_COLUMNS])
    for _ in range(2):
        tables.append_records(score.score_rows(rows, F.lit(0.7), "m"), target)
    back = spark.read.parquet(target)
    assert back.count() == 2 and back.first()["churn_predicted"] is True and back.first()["predicted_clv"] is None


def test_metadata_and_fallback(spark, tmp_path):
    path = str(tmp_path / "metadata")
    assert tables.model_card(spark, path)["model_name"] == FALLBACK_MODEL_NAME
    for when, name in (("2024-01-02", "b"), ("2024-01-01", "a")):
        tables.append_metadata(spark, path, {"trained_at": when, "best_model": name, "metrics": {"f1": 0.5}})
    card = tables.model_card(spark, path)
    assert card["model_name"] == "b" and card["metrics"] == {"f1": 0.5} and card["feature_columns"] == list(FEATURE_COLUMNS)


def test_online_scoring_stream(spark, small, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    names = ("customer_id", *FEATURE_COLUMNS)
    (inbox / "1.json").write_text(json.dumps(dict(zip(names, SAMPLE))) + "\n" + json.dumps({"customer_id": 7}) + "\n")
    out, bad, state = (str(tmp_path / n) for n in ("out", "bad", "state"))

    def drain():
        scorer = explain_queries.scorer(spark, small)
        query = score_stream(request_stream(spark, str(inbox)), scorer, "scorecard", out, bad, state)
        query.awaitTermination()

    drain()
    (inbox / "2.json").write_text(json.dumps(dict(zip(names, (99,) + SAMPLE[1:]))) + "\n")
    drain()
    scored = {r["customer_id"]: r["churn_probability"] for r in spark.read.parquet(out).collect()}
    assert set(scored) == {12345, 99} and scored[12345] == scored[99] and 0 < scored[99] < 1
    assert [r["customer_id"] for r in spark.read.parquet(bad).collect()] == [7]


@pytest.fixture(scope="module")
def finished(spark, small, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    config = RunConfig(date_min=CONFIG.date_min, date_max=CONFIG.date_max, segment_counts=(2, 3))
    grids = {
        "logistic_regression": models.settings({"C": [0.1, 1.0]}),
        "decision_tree": [{"max_depth": 3, "min_samples_leaf": 5}],
        "knn": None,
    }
    return out, run(raw(spark, small), out, config, grids, n_init=1)


def test_run_writes_every_output(spark, small, finished):
    out, record = finished
    assert record["n_customers"] == feature_table(spark, small).count() and record["kmeans_k"] in (2, 3)
    log = spark.read.csv(f"{out}/model_comparison", header=True)
    assert {r["model"] for r in log.collect()} == {"logistic_regression", "decision_tree", "knn"}
    assert record["best_model"] in ("logistic_regression", "decision_tree")
    assert spark.read.parquet(f"{out}/segments").count() == record["n_customers"]
    assert "business_label" in spark.read.csv(f"{out}/segment_profiles", header=True).columns
    assert tables.model_card(spark, f"{out}/metadata")["model_name"] == record["best_model"]
    expected = feature_table(spark, small).agg(F.sum("monetary_total"), F.sum("churned")).first()
    got = tables.read_features(spark, f"{out}/features").agg(F.sum("monetary_total"), F.sum("churned")).first()
    assert got[0] == pytest.approx(expected[0]) and got[1] == expected[1]


def test_saved_pipeline_scores_raw_features(spark, small, finished):
    """The scaler travels with the model, so a reloaded pipeline takes unscaled rows."""
    out, _ = finished
    model = tables.load_model(f"{out}/models", "logistic_regression")
    scores = models.score_with(model, feature_table(spark, small).select("customer_id", *FEATURE_COLUMNS))
    spread = scores.agg(F.min("probability"), F.max("probability"), F.count("*")).first()
    assert 0 <= spread[0] < spread[1] <= 1 and spread[2] == feature_table(spark, small).count()


def test_models_find_planted_signal(spark):
    rows = spark.range(600).select(
        F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("churned"),
        *[
            (F.when(F.col("id") % 2 == 1, 2.0).otherwise(0.0) + F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 500.0).alias(c)
            for c in FEATURE_COLUMNS
        ],
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int")).alias("split"),
    )
    for name in ("logistic_regression", "decision_tree"):
        _, log = models.train_and_log(rows, name)
        assert log.first()["roc_auc"] > 0.9
