"""A file scored with a saved model."""

import pytest
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import explain, models
from retailscope.operators.prep import stratified_folds, stratified_split
from retailscope.plans.score_file import score_file
from retailscope.queries.inputs import feature_table
from retailscope.sources import tables


@pytest.mark.parametrize("name", ["logistic_regression", "decision_tree"])
def test_score_file(spark, small, tmp_path, name):
    table = feature_table(spark, small)
    rows = stratified_folds(stratified_split(table)).where(F.col("split") == "train")
    model, _, _ = models.fit_classifier(rows, name)
    tables.save_model(model, str(tmp_path / "models"), name)
    background = explain.background_sample(table, FEATURE_COLUMNS, size=5)
    known = [r for r in table.where("customer_id > 0 and monetary_total > 0").orderBy("customer_id").limit(3).collect()]
    lines = [",".join(str(r[c]) for c in ("customer_id", *FEATURE_COLUMNS)) for r in known]
    path = tmp_path / "requests.csv"
    path.write_text("\n".join([",".join(("customer_id", *FEATURE_COLUMNS)), *lines, lines[0], lines[1] + ",1,2", "77,3", lines[2].replace(",", ",x", 1)]) + "\n")
    out = str(tmp_path / "out")
    for round_ in (1, 2):
        summary = score_file(spark, str(path), str(tmp_path / "models"), name, out, background).first()
        assert summary.asDict() == {"n_scored": 4, "n_failed": 3}
        predictions = spark.read.parquet(f"{out}/predictions").collect()
        assert len(predictions) == 4 * round_
    wanted = {r["customer_id"]: r["probability"] for r in models.score_with(model, table).collect()}
    for r in predictions:
        assert r["churn_probability"] == pytest.approx(wanted[r["customer_id"]]) and r["model_name"] == name
        assert r["explanation"].startswith("This customer's churn risk is driven mainly by: ")
    reasons = [r["reasons"] for r in spark.read.parquet(f"{out}/quarantine").collect()]
    assert len(reasons) == 6 and reasons.count("row is malformed") == 2
