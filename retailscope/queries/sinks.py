"""What is written is read back: sinks and scans as queries, and a file scored with a saved model."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS, MODEL_VERSION
from retailscope.operators import clean, models
from retailscope.operators.explain import long_attributions
from retailscope.plans.score_file import score_file as score_csv
from retailscope.queries import features as feature_queries
from retailscope.queries import reports, tables as table_queries
from retailscope.queries.inputs import CONFIG, cutoff, feature_table, raw, rounded, scored, written_once
from retailscope.queries.models import split_rows
from retailscope.queries.sqltext import FEATURE_DOUBLES, rounded_sql, statement
from retailscope.sources import tables
from retailscope.sources.shared import shared_folder

MODEL = "boosted_trees"


def fresh(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/retailscope/{label}-{uuid.uuid4().hex}"


def features_written(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table through its sink, one cutoff written twice and another beside it."""
    path, moment, table = fresh(spark, "features"), cutoff(spark, folder), feature_table(spark, folder)
    for when in (moment.replace(year=moment.year - 1), moment, moment):
        tables.write_features(table, path, when)
    found = tables.read_features(spark, path).where(F.col("cutoff_date").cast("string") == moment.isoformat(sep=" "))
    return rounded(found.select(*table.columns))


def report_written(spark: SparkSession, folder: str) -> DataFrame:
    """A report table through CSV."""
    path, report = fresh(spark, "report"), reports.leaderboard(spark, folder)
    tables.write_csv(report, path)
    return rounded(spark.read.schema(report.schema).csv(path, header=True))


def scoring_file(spark: SparkSession, folder: str) -> str:
    """The feature table as a scoring file."""
    path = fresh(spark, "requests") + ".csv"
    tables.write_csv(feature_table(spark, folder).select("customer_id", *FEATURE_COLUMNS), path)
    return path


def scoring_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A scoring file as it is read: every field in its type, malformed rows kept."""
    return rounded(tables.read_scoring_csv(spark, scoring_file(spark, folder)))


def cleaned_written(spark: SparkSession, folder: str) -> DataFrame:
    return tables.write_cleaned(clean.clean_transactions(raw(spark, folder), CONFIG), fresh(spark, "cleaned"))


def predictions_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Scores appended in two batches."""
    path, rows = fresh(spark, "predictions"), scored(spark, folder).select("customer_id", "split", "churn_probability")
    for low in (True, False):
        tables.append_records(rows.where((F.col("churn_probability") < 0.5) == low), path)
    return rounded(spark.read.parquet(path))


def fitted(spark: SparkSession, folder: str, name: str):
    train = split_rows(spark, folder).where(F.col("split") == "train")
    return models.fit_classifier(train, name)[0]


def model_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Whether saved models score every customer as before they were saved."""
    path, rows, same = fresh(spark, "models"), feature_table(spark, folder), F.lit(True)
    for name in ("logistic_regression", "decision_tree"):
        model = fitted(spark, folder, name)
        tables.save_model(model, path, name)
        for column, own in ((f"{name}_before", model), (f"{name}_after", tables.load_model(path, name))):
            rows = models.score_with(own, rows).withColumnRenamed("probability", column).drop("predicted")
        same = same & (F.col(f"{name}_before") == F.col(f"{name}_after"))
    return rows.select("customer_id", same.alias("same"))


def model_card(spark: SparkSession, folder: str) -> DataFrame:
    """The card of the newest run, beside the number of customers in its metadata."""
    path, n = fresh(spark, "metadata"), feature_table(spark, folder).count()
    for when, name in (("2024-01-02", "random_forest"), ("2024-01-03", MODEL), ("2024-01-01", "decision_tree")):
        tables.append_metadata(spark, path, {"trained_at": when, "n_customers": n, "best_model": name, "metrics": {"roc_auc": 0.5}})
    card, run = tables.model_card(spark, path), tables.latest_metadata(spark, path)
    row = (card["model_name"], card["model_version"], card["trained_at"], card["metrics"]["roc_auc"], len(card["feature_columns"]), run["n_customers"])
    schema = "model_name string, model_version string, trained_at string, roc_auc double, n_columns bigint, n_customers bigint"
    return spark.createDataFrame([row], schema)


def score_file(spark: SparkSession, folder: str) -> DataFrame:
    """A scoring file judged and explained with a saved, fitted model."""
    models_path, output = fresh(spark, "models"), fresh(spark, "scored")
    tables.save_model(fitted(spark, folder, MODEL), models_path, MODEL)
    score_csv(spark, scoring_file(spark, folder), models_path, MODEL, output).collect()
    return rounded(spark.read.parquet(f"{output}/predictions").drop("scored_at"))


def tree_attributions(spark: SparkSession, folder: str) -> DataFrame:
    """Exact attributions of boosted trees' log odds to the features of every customer."""

    def build() -> DataFrame:
        rows = fitted(spark, folder, MODEL).attributions(feature_table(spark, folder))
        return long_attributions(rows, {c: F.col("attributions")[c] for c in FEATURE_COLUMNS})

    return written_once("tree-attributions", spark, folder, build)


QUERIES = {
    "features_written": features_written,
    "report_written": report_written,
    "scoring_rows": scoring_rows,
    "cleaned_written": cleaned_written,
    "predictions_appended": predictions_appended,
    "model_saved": model_saved,
    "model_card": model_card,
    "score_file": score_file,
    "tree_attributions": tree_attributions,
}

AS_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS if c not in FEATURE_DOUBLES)
SQL = {
    "features_written": feature_queries.SQL["customer_features"],
    "report_written": reports.SQL["leaderboard"],
    "scoring_rows": statement(("features",), f"""
        SELECT customer_id, {AS_DOUBLES}, {rounded_sql(FEATURE_DOUBLES)}, CAST(NULL AS VARCHAR) AS corrupt_record FROM features"""),
    "cleaned_written": table_queries.SQL["clean_transactions"],
    "predictions_appended": statement(("scores",), """
        SELECT customer_id, split, round(churn_probability, 6) AS churn_probability FROM scores"""),
    "model_saved": statement(("features",), "SELECT customer_id, true AS same FROM features"),
    "model_card": statement(("features",), f"""
        SELECT '{MODEL}' AS model_name, '{MODEL_VERSION}' AS model_version, '2024-01-03' AS trained_at, CAST(0.5 AS DOUBLE) AS roc_auc,
               CAST({len(FEATURE_COLUMNS)} AS BIGINT) AS n_columns, count(*) AS n_customers FROM features"""),
}
