"""Model queries: fits on the train split, judged on the others."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import DEDUP_COLUMNS, FEATURE_COLUMNS
from retailscope.functions.timeparts import timestamp
from retailscope.operators import clean, metrics, models, sequences
from retailscope.operators.features import currency, line_amount
from retailscope.operators.prep import apply_scaler, fit_scaler, stratified_folds, stratified_split
from retailscope.queries.inputs import CONFIG, cutoff, feature_table, rounded, written_once
from retailscope.queries import segments  # noqa: F401  (defines the split_points piece)
from retailscope.queries.sequences import steps
from retailscope.queries.sqltext import piece, statement
from retailscope.sources import star_schema

TIMING_COLUMNS = (
    "last_amount", "last_gap_days", "last_category", "mean_amount", "mean_gap_days", "max_gap_days", "n_steps",
)
# A bottleneck of four equal-weight feature triples, in feature order.
TRIPLES = tuple(FEATURE_COLUMNS[i : i + 3] for i in range(0, 12, 3))


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        return stratified_folds(stratified_split(feature_table(spark, folder)))

    return written_once("split-features", spark, folder, build)


def whole_grid(name: str) -> list[dict]:
    return models.settings(models.KNN_GRID if name == "knn" else models.CLASSIFIERS[name].grid)


def fitted_log(name: str):
    """A query that searches a model's whole grid over the five folds and returns its log row."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        def build() -> DataFrame:
            return models.train_and_log(split_rows(spark, folder), name, whole_grid(name))[1]

        return written_once(f"log-{name}", spark, folder, build)

    return query


LOGS = {
    "model_lr": fitted_log("logistic_regression"),
    "model_dt": fitted_log("decision_tree"),
    "model_rf": fitted_log("random_forest"),
    "model_gbt": fitted_log("boosted_trees"),
    "model_gbt_b": fitted_log("boosted_trees_by_leaf"),
    "model_knn": fitted_log("knn"),
    "model_mlp": fitted_log("perceptron"),
}


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All models, best first by validation AUC; test figures are only reported.

    The families are trained side by side, so that one's small jobs and last tasks leave no cores idle.
    """
    split_rows(spark, folder)
    with ThreadPoolExecutor(len(LOGS)) as pool:
        rows = list(pool.map(lambda query: query(spark, folder), LOGS.values()))
    log = rows[0]
    for row in rows[1:]:
        log = log.unionByName(row)
    return metrics.rank_models(log, "val_roc_auc").drop("train_time_sec")


model_lr, model_dt = LOGS["model_lr"], LOGS["model_dt"]


def cv_search(spark: SparkSession, folder: str) -> DataFrame:
    """The full grids of logistic regression and the decision tree over the five folds."""
    return model_lr(spark, folder).unionByName(model_dt(spark, folder))


def future_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Spend of each customer in the churn window; absent customers spent nothing."""
    moment = cutoff(spark, folder)
    end = moment + timedelta(days=CONFIG.churn_window_days)
    rows = star_schema.transactions(
        spark, folder, DEDUP_COLUMNS, days_from=moment.date().isoformat(), days_to=end.date().isoformat()
    )
    lines = clean.clean_for_features(rows, CONFIG)
    inside = (F.col("invoice_date") > timestamp(moment)) & (F.col("invoice_date") <= timestamp(end))
    return (
        lines.where(inside & F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(currency(F.sum(line_amount())).alias("future_spend"))
    )


def model_clv(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_rows(spark, folder).join(future_spend(spark, folder), "customer_id", "left")
    return models.train_clv_regressor(rows.fillna(0.0, ["future_spend"]), "future_spend")[1]


def model_timing(spark: SparkSession, folder: str) -> DataFrame:
    """Error in days of the timing regression beside the median baseline, on validation customers."""
    splits = split_rows(spark, folder).select("customer_id", "split")
    rows = sequences.timing_features(steps(spark, folder)).join(splits, "customer_id")
    _, scored = models.timing_regressor(rows, TIMING_COLUMNS)
    fitted = metrics.regression_metrics(scored.where(F.col("split") == "val"), "target", "predicted_days")
    naive = sequences.timing_baseline(sequences.sequence_targets(steps(spark, folder)), splits).drop("median_gap")
    return fitted.withColumn("model", F.lit("boosted_regression")).unionByName(
        naive.withColumn("model", F.lit("median_baseline"))
    )


def train_scaled(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_rows(spark, folder)
    return apply_scaler(rows, fit_scaler(rows.where(F.col("split") == "train"), FEATURE_COLUMNS), FEATURE_COLUMNS)


def anomaly_flags(spark: SparkSession, folder: str) -> DataFrame:
    return models.pca_anomalies(train_scaled(spark, folder), FEATURE_COLUMNS)


def triple_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Reconstruction error through the fixed bottleneck."""
    kept = F.lit(0.0)
    for a, b, c in TRIPLES:
        total = F.col(a) + F.col(b) + F.col(c)
        kept = kept + total * total / 3.0
    return train_scaled(spark, folder).select(
        "customer_id", "split", models.mean_residual(FEATURE_COLUMNS, kept).alias("error")
    )


def anomaly_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(models.anomaly_threshold(triple_errors(spark, folder)))


def anomaly_test_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = models.flag_anomalies(triple_errors(spark, folder)).where(F.col("split") == "test")
    return rounded(flagged.select("customer_id", "error", "is_anomaly"))


QUERIES = {
    **LOGS,
    "model_comparison": model_comparison,
    "cv_search": cv_search,
    "model_clv": model_clv,
    "model_timing": model_timing,
    "anomaly_flags": anomaly_flags,
    "anomaly_threshold": anomaly_threshold,
    "anomaly_test_flags": anomaly_test_flags,
}

NORM = " + ".join(f"z_{c} * z_{c}" for c in FEATURE_COLUMNS)
KEPT = " + ".join("pow({}, 2) / 3.0".format(" + ".join(f"z_{c}" for c in t)) for t in TRIPLES)
piece("residuals", ("split_points",), f"""
    SELECT customer_id, split, greatest({NORM} - ({KEPT}), 0) / {len(FEATURE_COLUMNS)} AS error FROM split_points""")
piece("error_limit", ("residuals",), """
    SELECT quantile_cont(error, 0.95) AS threshold FROM residuals WHERE split = 'val'""")

SQL = {
    "anomaly_threshold": statement(("error_limit",), "SELECT round(threshold, 6) AS threshold FROM error_limit"),
    "anomaly_test_flags": statement(("residuals", "error_limit"), """
        SELECT customer_id, round(error, 6) AS error, error > threshold AS is_anomaly
        FROM residuals, error_limit WHERE split = 'test'"""),
}
