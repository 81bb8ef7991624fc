"""Preparation, scoring and metric queries over the fixed scorecard."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS, FEATURE_RANGES, SCALE_SENSITIVE_COLUMNS
from retailscope.functions import scorecard
from retailscope.operators import metrics, prep, score
from retailscope.queries.inputs import feature_table, rounded, scored, scoring_input
from retailscope.queries.sqltext import (
    auc_sql, edge_sql, probability_sql, range_conditions, standard_sql, statement,
)


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return prep.stratified_split(feature_table(spark, folder)).select("customer_id", "churned", "split")


def cv_folds(spark: SparkSession, folder: str) -> DataFrame:
    return prep.stratified_folds(feature_table(spark, folder)).select("customer_id", "churned", "fold")


def train_scaler(spark: SparkSession, folder: str) -> DataFrame:
    train = prep.stratified_split(feature_table(spark, folder)).where(F.col("split") == "train")
    return prep.fit_scaler(train)


def scaler_params(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prep.scaler_table(train_scaler(spark, folder)))


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    """All customers scaled with the training split's parameters."""
    scaled = prep.apply_scaler(feature_table(spark, folder), train_scaler(spark, folder))
    return rounded(scaled.select("customer_id", *FEATURE_COLUMNS))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prep.class_weights(feature_table(spark, folder)))


def score_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = score.split_valid(feature_table(spark, folder))
    return bad.select("customer_id", F.array_join("reasons", "; ").alias("reasons"))


def batch_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring_input(spark, folder)
    p = scorecard.probability(scorecard.contributions())
    records = score.score_rows(rows, p, "scorecard_full", scored_at=datetime(2000, 1, 1))
    return rounded(records.drop("scored_at", "explanation"))


def batch_summary(spark: SparkSession, folder: str) -> DataFrame:
    return score.batch_summary(feature_table(spark, folder))


def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    predicted = scored(spark, folder).withColumn("predicted", F.col("churn_probability") >= score.THRESHOLD)
    result = metrics.confusion_metrics(predicted, "churned", "predicted", ["split"])
    flat = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    cells = {n: F.col("confusion_matrix")[i][j] for n, (i, j) in flat.items()}
    return rounded(result.withColumns(cells).drop("confusion_matrix"))


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.roc_auc(scored(spark, folder), "churned", "churn_probability", ["split"]))


def scorecard_log(spark: SparkSession, folder: str) -> DataFrame:
    """Experiment log of the scorecard variants: validation AUC per variant, one pass for all."""
    names = list(scorecard.VARIANTS)
    melted = scored(spark, folder).where(F.col("split") == "val").select(
        "churned",
        F.inline(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("probability")) for n in names])),
    )
    return metrics.roc_auc(melted, "churned", "probability", ["model"]).withColumn("status", F.lit("trained"))


def scorecard_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.rank_models(scorecard_log(spark, folder)))


def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.best_model(scorecard_log(spark, folder)))


def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Error of the mean-basket estimate of spend per order against realised spend per order.

    Customers whose lines all lack an invoice have no order to compare and are left out.
    """
    return rounded(order_spend_errors(feature_table(spark, folder)), 4)


def order_spend_errors(table: DataFrame) -> DataFrame:
    rows = table.withColumns({
        "actual": F.try_divide("monetary_total", "frequency"),
        "predicted": F.col("monetary_avg") * F.col("avg_basket_size"),
    })
    return metrics.regression_metrics(rows, "actual", "predicted", ["churned"])


QUERIES = {
    "stratified_split": stratified_split,
    "cv_folds": cv_folds,
    "scaler_params": scaler_params,
    "scaled_features": scaled_features,
    "class_weights": class_weights,
    "score_quarantine": score_quarantine,
    "batch_score": batch_score,
    "batch_summary": batch_summary,
    "confusion_metrics": confusion_metrics,
    "roc_auc": roc_auc,
    "scorecard_comparison": scorecard_comparison,
    "best_model": best_model,
    "regression_metrics": regression_metrics,
}


def reasons_sql() -> str:
    parts = ["CASE WHEN customer_id IS NULL THEN 'customer_id is missing' END",
             "CASE WHEN customer_id <= 0 THEN 'customer_id must be positive' END"]
    for c, (low, high) in FEATURE_RANGES.items():
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c} is missing' END")
        if low is not None:
            parts.append(f"CASE WHEN {c} < {low} THEN '{c} must be at least {low:g}' END")
        if high is not None:
            parts.append(f"CASE WHEN {c} > {high} THEN '{c} must be at most {high:g}' END")
    return f"concat_ws('; ', {', '.join(parts)})"


VARIANT_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS model, churned, {n} AS probability FROM scores WHERE split = 'val'" for n in scorecard.VARIANTS
)
LOG_SQL = f"SELECT model, round(roc_auc, 6) AS roc_auc, 'trained' AS status FROM ({auc_sql('probability', f'({VARIANT_ROWS})', 'model')})"

SQL = {
    "stratified_split": statement(("splits",), "SELECT customer_id, churned, split FROM splits"),
    "cv_folds": statement(("folds",), "SELECT customer_id, churned, fold FROM folds"),
    "scaler_params": statement(("train_scaler",), " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round({c}_mean, 6) AS mean, round({c}_std, 6) AS std FROM train_scaler"
        for c in SCALE_SENSITIVE_COLUMNS)),
    "scaled_features": statement(("features", "train_scaler"), "SELECT customer_id, " + ", ".join(
        f"{edge_sql(standard_sql(c) if c in SCALE_SENSITIVE_COLUMNS else c)} AS {c}"
        for c in FEATURE_COLUMNS) + " FROM features, train_scaler"),
    "class_weights": statement(("features",), """
        SELECT churned, count(*) AS n_rows, round(sum(count(*)) OVER () / (2.0 * count(*)), 6) AS balanced_weight,
               round(sum(count(*)) FILTER (churned = 0) OVER ()
                     / greatest(sum(count(*)) FILTER (churned = 1) OVER (), 1), 6) AS positive_weight
        FROM features GROUP BY churned"""),
    "score_quarantine": statement(("features",), f"""
        SELECT customer_id, {reasons_sql()} AS reasons FROM features WHERE NOT ({range_conditions()})"""),
    "batch_score": statement(("terms",), f"""
        SELECT customer_id, round({probability_sql(FEATURE_COLUMNS)}, 6) AS churn_probability,
               {probability_sql(FEATURE_COLUMNS)} >= 0.5 AS churn_predicted, CAST(NULL AS DOUBLE) AS predicted_clv,
               'scorecard_full' AS model_name, '1.0.0' AS model_version FROM terms"""),
    "batch_summary": statement(("features",), f"""
        SELECT count(*) FILTER ({range_conditions()}) AS n_scored,
               count(*) FILTER (NOT ({range_conditions()})) AS n_failed FROM features"""),
    "confusion_metrics": statement(("scores",), """
        SELECT split, tn, fp, fn, tp, round((tp + tn) / (tn + fp + fn + tp), 6) AS accuracy,
               round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
        FROM (SELECT split, count(*) FILTER (churned = 0 AND churn_probability < 0.5) AS tn,
                     count(*) FILTER (churned = 0 AND churn_probability >= 0.5) AS fp,
                     count(*) FILTER (churned = 1 AND churn_probability < 0.5) AS fn,
                     count(*) FILTER (churned = 1 AND churn_probability >= 0.5) AS tp FROM scores GROUP BY split)"""),
    "roc_auc": statement(("scores",), f"""
        SELECT split, round(roc_auc, 6) AS roc_auc FROM ({auc_sql('churn_probability', 'scores', 'split')})"""),
    "scorecard_comparison": statement(("scores",), LOG_SQL),
    "best_model": statement(("scores",), f"{LOG_SQL} ORDER BY roc_auc DESC, model LIMIT 1"),
    "regression_metrics": statement(("features",), """
        SELECT churned, count(*) AS n_rows, round(avg(abs(p - a)), 4) AS mae, round(sqrt(avg((p - a) * (p - a))), 4) AS rmse,
               round(CASE WHEN var_pop(a) > 0 THEN 1 - avg((p - a) * (p - a)) / var_pop(a) END, 4) AS r2
        FROM (SELECT churned, monetary_total / frequency AS a, monetary_avg * avg_basket_size AS p FROM features)
        GROUP BY churned"""),
}
