"""Model quality as aggregates over a score table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.functions.ranks import cumulative_histogram


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def confusion_metrics(scores: DataFrame, label: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero where undefined) and the confusion matrix."""
    actual, guess = F.col(label) == 1, F.col(predicted).cast("int") == 1
    counted = scores.groupBy(*keys).agg(
        F.count_if(~actual & ~guess).alias("tn"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(actual & guess).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counted.select(
        *keys,
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.array(F.array(tn, fp), F.array(fn, tp)).alias("confusion_matrix"),
    )


def roc_auc(scores: DataFrame, label: str, probability: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve from average ranks of the score histogram; null with one class.

    Equal scores are one histogram row with their positives counted, so a score shared by a third of
    all rows costs nothing extra.
    """
    positives = (F.col(label) == 1).cast("bigint")
    ranked = cumulative_histogram(scores, F.col(probability), keys, {"positives": positives})
    average_rank = F.col("below") + (F.col("n") + 1) / F.lit(2.0)
    sums = ranked.groupBy(*keys).agg(
        F.sum(F.col("positives") * average_rank).alias("rank_sum"),
        F.sum("positives").alias("p"),
        F.sum(F.col("n") - F.col("positives")).alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    area = (F.col("rank_sum") - p * (p + 1) / 2) / (p * q)
    return sums.select(*keys, F.when((p > 0) & (q > 0), area).alias("roc_auc"))


def classification_metrics(
    scores: DataFrame, label: str, predicted: str, probability: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion metrics and ROC AUC together, per key (or one row)."""
    key = list(keys) or ["all_rows"]
    tagged = scores if keys else scores.withColumn("all_rows", F.lit(1))
    both = confusion_metrics(tagged, label, predicted, key).join(roc_auc(tagged, label, probability, key), key)
    return both if keys else both.drop("all_rows")


def regression_metrics(rows: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, root mean squared error and R²; R² is null for a constant target."""
    error = F.col(predicted) - F.col(actual)
    sums = rows.groupBy(*keys).agg(
        F.count(error).alias("n_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.col(actual)).alias("spread"),
    )
    return sums.select(
        *keys, "n_rows", "mae", F.sqrt("mse").alias("rmse"),
        F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread")).alias("r2"),
    )


def rank_models(log: DataFrame, by: str = "roc_auc") -> DataFrame:
    """Trained models of an experiment log, best first; the log has one row per model."""
    return log.where(F.col("status") == "trained").orderBy(F.desc_nulls_last(by), "model")


def best_model(log: DataFrame, by: str = "roc_auc") -> DataFrame:
    return rank_models(log, by).limit(1)
