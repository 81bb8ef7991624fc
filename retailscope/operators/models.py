"""Classifiers and regressors, cross-validated on fixed stratified folds.

Every search shares its work between settings and folds: one forest serves the smaller and shallower ones,
Newton steps of all penalties and folds are sums of the same pass, nearest neighbours are looked up once for
all numbers and weights. Scale-sensitive models carry their scaler, so scoring raw features is always right.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from math import isqrt
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailscope.config import FEATURE_COLUMNS
from retailscope.functions.growth import Boosting, Limits
from retailscope.functions.ranks import exact_quantiles
from retailscope.functions.trees import rmse, roc_auc
from retailscope.operators.logistic import NO_FOLD, LinearModel, held_out_auc, newton
from retailscope.operators.metrics import classification_metrics, regression_metrics
from retailscope.operators.neighbours import knn_classify, knn_grid_scores
from retailscope.operators.prep import apply_scaler, class_weights, fit_scaler, one_row
from retailscope.operators.tree_models import (
    TreeModel, bin_edges, fit_boosted, fit_forest, fit_tree, held_rows, search_boosted, search_trees, training_rows,
)
from retailscope.sources.shared import materialize

Model = PipelineModel | TreeModel | LinearModel
Fitted = tuple[Model, dict[str, Any], float | None]

FOLDS = 5
SEED = 42
LABEL = "churned"

LOG_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("cv_best_roc_auc", T.DoubleType()),
    T.StructField("train_time_sec", T.DoubleType()),
    T.StructField("val_roc_auc", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
])


@dataclass(frozen=True)
class ModelSpec:
    """One classifier: how to fit it, its search grid and the setting used without a search.

    ``fit`` takes weighted training rows and the settings to choose from by ROC AUC over ``fold``.
    """

    fit: Callable[[DataFrame, Sequence[Mapping[str, Any]]], Fitted]
    grid: Mapping[str, Sequence[Any]]
    chosen: Mapping[str, Any]
    weight: str | None = None
    tree_based: bool = field(default=False)


def best_place(scores: Sequence[Sequence[float]], larger: bool = True) -> tuple[int, float]:
    """The setting with the best mean over the folds, the first among equals."""
    means = [sum(own) / len(own) for own in scores]
    at = (max if larger else min)(range(len(means)), key=means.__getitem__)
    return at, means[at]


def _logistic(train: DataFrame, options: Sequence[Mapping[str, Any]]) -> Fitted:
    scaler = fit_scaler(train, FEATURE_COLUMNS).first()  # one row
    means, deviations = zip(*[(float(scaler[f"{c}_mean"]), float(scaler[f"{c}_std"] or 1.0)) for c in FEATURE_COLUMNS])
    scores = [(F.col(c).cast("double") - m) / d for c, m, d in zip(FEATURE_COLUMNS, means, deviations)]
    fold = F.col("fold").cast("int") if "fold" in train.columns else F.lit(0)
    rows = materialize(train.select(F.array(*scores).alias("vector"), F.col(LABEL).cast("double").alias("label"), fold.alias("fold"),
                                    F.xxhash64("customer_id").alias("key"), F.lit(1.0).alias("weight")), "logistic-rows")
    folds = range(FOLDS) if len(options) > 1 else ()
    models = [(o, f) for o in range(len(options)) for f in (NO_FOLD, *folds)]
    found = newton(rows, len(FEATURE_COLUMNS), [1.0 / options[o]["C"] for o, _ in models], [f for _, f in models])
    at, score = 0, None
    if folds:
        by_fold = {place: w for place, w in zip(models, found) if place[1] != NO_FOLD}
        at, score = best_place(held_out_auc(rows, by_fold, len(options), FOLDS))
    weights = found[models.index((at, NO_FOLD))]
    model = LinearModel(tuple(FEATURE_COLUMNS), means, deviations, tuple(weights[:-1].tolist()), float(weights[-1]))
    return model, dict(options[at]), score


def _rows_and_edges(train: DataFrame, label: str = LABEL):
    rows = materialize(training_rows(train, FEATURE_COLUMNS, label, F.col("weight")), "training-rows")
    return rows, bin_edges(rows, len(FEATURE_COLUMNS))


def _tree(train: DataFrame, options: Sequence[Mapping[str, Any]]) -> Fitted:
    rows, edges = _rows_and_edges(train)
    at, score = 0, None
    if len(options) > 1:
        every = held_rows(rows, edges)
        at, score = best_place(search_trees(train.sparkSession, every, options, FOLDS, roc_auc, SEED, bagged=False))
    best = options[at]
    limits = Limits(least_rows=best["min_samples_leaf"], depth=best["max_depth"])
    return fit_tree(rows, FEATURE_COLUMNS, edges, limits), dict(best), score


def _forest(train: DataFrame, options: Sequence[Mapping[str, Any]]) -> Fitted:
    every = held_rows(*_rows_and_edges(train))
    spark, wide, at, score = train.sparkSession, isqrt(len(FEATURE_COLUMNS)), 0, None
    if len(options) > 1:
        at, score = best_place(search_trees(spark, every, options, FOLDS, roc_auc, SEED, wide))
    best = options[at]
    limits = Limits(least_rows=best["min_samples_leaf"], depth=best["max_depth"])
    return fit_forest(spark, every, FEATURE_COLUMNS, best["n_estimators"], limits, SEED, wide), dict(best), score


def boosting(p: Mapping[str, Any]) -> Boosting:
    """The published defaults of both kinds; ``num_leaves`` asks for leaf-wise growth."""
    by_leaf = "num_leaves" in p
    limits = Limits(0.0, 1e-3, 20, leaves=p["num_leaves"]) if by_leaf else Limits(1.0, 1.0, 1, depth=p["max_depth"])
    return Boosting(p["n_estimators"], p["learning_rate"], limits, by_leaf, p.get("subsample", 1.0), p.get("colsample", 1.0), SEED)


def _boosted(train: DataFrame, options: Sequence[Mapping[str, Any]]) -> Fitted:
    rows, edges = _rows_and_edges(train)
    at, score = 0, None
    if len(options) > 1:
        at, score = best_place(search_boosted(train.sparkSession, held_rows(rows, edges), [boosting(o) for o in options], FOLDS))
    return fit_boosted(rows, FEATURE_COLUMNS, edges, boosting(options[at])), dict(options[at]), score


def _perceptron(train: DataFrame, options: Sequence[Mapping[str, Any]]) -> Fitted:
    """One setting; the scaler is a stage of the saved pipeline."""
    p = options[0]
    stages = [scaler_stage(train, FEATURE_COLUMNS), VectorAssembler(inputCols=[f"z_{c}" for c in FEATURE_COLUMNS], outputCol="vector")]
    ready = train
    for stage in stages:
        ready = stage.transform(ready)
    layers = [len(FEATURE_COLUMNS), *p["hidden"], 2]
    fitted = MultilayerPerceptronClassifier(
        labelCol=LABEL, featuresCol="vector", layers=layers, maxIter=p["max_iter"], seed=SEED).fit(ready)
    return PipelineModel(stages=[*stages, fitted]), dict(p), None


# Search grids and the published best settings.
CLASSIFIERS: dict[str, ModelSpec] = {
    "logistic_regression": ModelSpec(_logistic, {"C": [0.01, 0.1, 1.0, 10.0]}, {"C": 1.0}),
    "decision_tree": ModelSpec(
        _tree, {"max_depth": [3, 5, 8, None], "min_samples_leaf": [1, 5, 10]},
        {"max_depth": 3, "min_samples_leaf": 10}, tree_based=True,
    ),
    "random_forest": ModelSpec(
        _forest, {"n_estimators": [200, 400], "max_depth": [5, 10, None], "min_samples_leaf": [1, 5]},
        {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 5}, weight="balanced", tree_based=True,
    ),
    "boosted_trees": ModelSpec(
        _boosted,
        {"learning_rate": [0.05, 0.1], "max_depth": [3, 5], "subsample": [0.8, 1.0], "colsample": [0.8, 1.0],
         "n_estimators": [200]},
        {"learning_rate": 0.05, "max_depth": 3, "n_estimators": 200}, weight="positive", tree_based=True,
    ),
    "boosted_trees_by_leaf": ModelSpec(
        _boosted, {"learning_rate": [0.05, 0.1], "num_leaves": [15, 31], "n_estimators": [200]},
        {"learning_rate": 0.05, "num_leaves": 15, "n_estimators": 200}, weight="balanced", tree_based=True,
    ),
    "perceptron": ModelSpec(_perceptron, {"hidden": [(64, 32)], "max_iter": [200]}, {"hidden": (64, 32), "max_iter": 200}),
}
KNN_GRID = {"n_neighbors": [5, 11, 21], "weights": ["uniform", "distance"]}
KNN_CHOSEN = {"n_neighbors": 21, "weights": "uniform"}
CLV_GRID = {"n_estimators": [200, 400], "max_depth": [5, 10, None]}


def settings(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Every combination of a grid."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def scaler_stage(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    """Population standard scores as a saved pipeline stage; one row of parameters reaches the driver."""
    p = fit_scaler(train, columns).first()
    scores = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - ({p[f'{c}_mean']!r}D)) / ({(p[f'{c}_std'] or 1.0)!r}D) AS `z_{c}`" for c in columns
    )
    return SQLTransformer(statement=f"SELECT *, {scores} FROM __THIS__")


def weighted(train: DataFrame, kind: str | None) -> DataFrame:
    """Add ``weight`` per class; the two weights are read once."""
    if kind is None:
        return train.withColumn("weight", F.lit(1.0))
    by_class = {r[LABEL]: r for r in class_weights(train).collect()}  # two rows
    if kind == "balanced":
        pair = (by_class[0]["balanced_weight"] or 1.0, by_class[1]["balanced_weight"] or 1.0)
    else:
        pair = (1.0, by_class[1]["positive_weight"] or 1.0)
    return train.withColumn("weight", F.when(F.col(LABEL) == 1, float(pair[1])).otherwise(float(pair[0])))


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def fit_classifier(train: DataFrame, name: str, grid: Sequence[Mapping[str, Any]] | None = None) -> Fitted:
    """Fit one classifier; with several settings, search them by ROC AUC over the ``fold`` column.

    Returns the fitted model, the setting used and its cross-validated ROC AUC.
    """
    spec = CLASSIFIERS[name]
    options = [dict(g) for g in (grid if grid is not None else [spec.chosen])]
    return spec.fit(weighted(train, spec.weight), options)


def score_with(model: Model, rows: DataFrame) -> DataFrame:
    """Rows with ``probability`` of churn and the 0.5 decision as ``predicted``."""
    kept = [F.col(c) for c in rows.columns]
    chance = positive_probability() if isinstance(model, PipelineModel) else F.col("probability")
    scored = model.transform(rows).select(*kept, chance.alias("probability"))
    return scored.withColumn("predicted", F.col("probability") >= 0.5)


def _log_row(name: str, best: Mapping[str, Any], cv: float | None, seconds: float, judged: DataFrame) -> tuple:
    """One experiment-log row from scored validation and test rows; two small rows are collected."""
    by_split = {r["split"]: r for r in classification_metrics(judged, LABEL, "predicted", "probability", ["split"]).collect()}
    test, val = by_split.get("test"), by_split.get("val")
    return (
        name, "trained", None, {k: str(v) for k, v in best.items()}, cv, round(seconds, 2),
        val["roc_auc"] if val else None,
        *([test[c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "confusion_matrix")] if test else [None] * 6),
    )


def train_and_log(
    split_rows: DataFrame, name: str, grid: Sequence[Mapping[str, Any]] | None = None
) -> tuple[Model | None, DataFrame]:
    """Train on the train split, judge on val and test, return the model and its log row."""
    train = split_rows.where(F.col("split") == "train")
    held_out = split_rows.where(F.col("split") != "train")
    started = time.time()
    if name == "knn":
        model, best, cv, judged = None, *_fit_knn(train, held_out, grid)
    else:
        model, best, cv = fit_classifier(train, name, grid)
        judged = score_with(model, held_out)
    seconds = time.time() - started
    row = _log_row(name, best, cv, seconds, judged.select("split", LABEL, "predicted", "probability"))
    return model, split_rows.sparkSession.createDataFrame([row], LOG_SCHEMA)


def _fit_knn(train: DataFrame, held_out: DataFrame, grid: Sequence[Mapping[str, Any]] | None):
    """Nearest neighbours have no fit: scale by the training split, optionally search by fold, then vote."""
    scaler = fit_scaler(train, FEATURE_COLUMNS)
    near, asked = (apply_scaler(df, scaler, FEATURE_COLUMNS) for df in (train, held_out))

    def vote(queries: DataFrame, searched: DataFrame, option: Mapping[str, Any]) -> DataFrame:
        found = knn_classify(queries, searched, FEATURE_COLUMNS, option["n_neighbors"], option["weights"])
        return queries.join(found, "customer_id").withColumn("predicted", F.col("probability") >= 0.5)

    options = [dict(g) for g in (grid if grid is not None else [KNN_CHOSEN])]
    best, cv = options[0], None
    if len(options) > 1:
        at, cv = best_place(knn_grid_scores(near, FEATURE_COLUMNS, options, FOLDS))
        best = options[at]
    return best, cv, vote(asked, near, best)


def train_all(
    split_rows: DataFrame, grids: Mapping[str, Sequence[Mapping[str, Any]] | None]
) -> tuple[dict[str, Model], DataFrame]:
    """Train every named model; one that cannot be fitted is logged with the reason and the others go on."""
    models: dict[str, Model] = {}
    log: DataFrame | None = None
    for name, grid in grids.items():
        try:
            model, row = train_and_log(split_rows, name, grid)
            if model is not None:
                models[name] = model
        except Exception as error:  # any family may fail on its own
            empty = [None] * (len(LOG_SCHEMA) - 3)
            status = "skipped" if isinstance(error, ImportError) else "failed"
            row = split_rows.sparkSession.createDataFrame([(name, status, f"{type(error).__name__}: {error}", *empty)], LOG_SCHEMA)
        log = row if log is None else log.unionByName(row)
    return models, log


def full_grids() -> dict[str, list[dict[str, Any]]]:
    """The complete search space of every classical model."""
    grids = {name: settings(spec.grid) for name, spec in CLASSIFIERS.items() if name != "perceptron"}
    grids["knn"] = settings(KNN_GRID)
    return grids


def train_clv_regressor(
    rows: DataFrame, target: str, grid: Sequence[Mapping[str, Any]] | None = None, folds: int = FOLDS
) -> tuple[TreeModel, DataFrame]:
    """Random forest for future spend, searched by RMSE over ``fold``; error on the test split."""
    train = rows.where(F.col("split") == "train").withColumn("weight", F.lit(1.0))
    options = list(grid if grid is not None else settings(CLV_GRID))
    every = held_rows(*_rows_and_edges(train, target))
    best = options[0]
    if len(options) > 1:
        at, _ = best_place(search_trees(rows.sparkSession, every, options, folds, rmse, SEED), larger=False)
        best = options[at]
    model = fit_forest(
        rows.sparkSession, every, FEATURE_COLUMNS, best["n_estimators"], Limits(depth=best["max_depth"]), SEED, link="value")
    judged = model.transform(rows.where(F.col("split") == "test"))
    return model, regression_metrics(judged, target, "prediction")


def timing_regressor(rows: DataFrame, columns: Sequence[str], rounds: int = 50) -> tuple[PipelineModel, DataFrame]:
    """Boosted regression of log1p days to the next order; scored rows carry ``predicted_days``."""
    train = rows.where(F.col("split") == "train").withColumn("log_target", F.log1p("target"))
    assembler = VectorAssembler(inputCols=list(columns), outputCol="vector")
    fitted = GBTRegressor(labelCol="log_target", featuresCol="vector", maxIter=rounds, maxDepth=4, seed=SEED).fit(
        assembler.transform(train)
    )
    model = PipelineModel(stages=[assembler, fitted])
    days = F.greatest(F.expm1("prediction"), F.lit(0.0))
    return model, model.transform(rows).withColumn("predicted_days", days)


def pca_anomalies(scaled: DataFrame, columns: Sequence[str], components: int = 4, quantile: float = 0.95) -> DataFrame:
    """Reconstruction error of a linear bottleneck and whether it exceeds the validation quantile.

    ``scaled`` holds standard scores of the training split and a ``split`` column. With orthonormal
    components the error is what the projection leaves of the squared norm.
    """
    assembled = VectorAssembler(inputCols=list(columns), outputCol="vector").transform(scaled)
    model = PCA(k=components, inputCol="vector", outputCol="projection").fit(assembled.where(F.col("split") == "train"))
    projected = model.transform(assembled).withColumn("kept", vector_to_array("projection"))
    kept = F.aggregate("kept", F.lit(0.0), lambda total, x: total + x * x)
    errors = projected.select("customer_id", "split", mean_residual(columns, kept).alias("error"))
    return flag_anomalies(errors, quantile)


def mean_residual(columns: Sequence[str], kept: Column) -> Column:
    """Mean squared reconstruction error, given the squared norm that the bottleneck keeps."""
    norm = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    return F.greatest(norm - kept, F.lit(0.0)) / len(columns)


def anomaly_threshold(errors: DataFrame, quantile: float = 0.95) -> DataFrame:
    return exact_quantiles(errors.where(F.col("split") == "val"), F.col("error"), {"threshold": quantile})


def flag_anomalies(errors: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Add ``is_anomaly``: an error above the ``quantile`` of validation errors."""
    limit = one_row(anomaly_threshold(errors, quantile))
    return errors.withColumn("threshold", limit.getField("threshold")).withColumn(
        "is_anomaly", F.col("error") > F.col("threshold")
    )
