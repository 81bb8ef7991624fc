"""The end-to-end run: transactions in, features, models, segments and metadata out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailscope.config import RunConfig
from retailscope.operators import features as feature_operators
from retailscope.operators import metrics, models, segment
from retailscope.operators.clean import clean_transactions, duplicate_counts
from retailscope.operators.prep import apply_scaler, feature_columns, fit_scaler, stratified_folds, stratified_split
from retailscope.operators.validate import raise_if_failed, run_validation
from retailscope.plans.feature_table import customer_features
from retailscope.sources import tables


def run(
    raw: DataFrame,
    output: str,
    config: RunConfig = RunConfig(),
    grids: Mapping[str, Sequence[Mapping[str, Any]] | None] | None = None,
    n_init: int = 10,
) -> dict[str, Any]:
    """Run every stage and return the metadata record. ``grids`` defaults to the full search space.

    The cleaned table is written by month and every later stage reads it back, so the expensive part of
    the lineage runs once and lost executors repeat one stage at most.
    """
    spark = raw.sparkSession
    raise_if_failed(run_validation(raw, config))
    cleaned = tables.write_cleaned(clean_transactions(raw, config), f"{output}/cleaned")
    removed = duplicate_counts(raw, config.dedup_columns)
    tables.write_csv(removed, f"{output}/duplicates")

    cutoff = feature_operators.cutoff_date(cleaned, config.churn_window_days).first()["cutoff_date"]
    history = tables.read_cleaned(spark, f"{output}/cleaned", until=cutoff)
    returning = feature_operators.future_customers(cleaned, cutoff, config.churn_window_days)
    tables.write_features(customer_features(history, cutoff, config, returning), f"{output}/features", cutoff)
    table = tables.read_features(spark, f"{output}/features").where(
        F.col("cutoff_date").cast("string") == cutoff.isoformat(sep=" ")
    ).drop("cutoff_date")
    feature_operators.require_both_classes(feature_operators.class_balance(table))

    split = stratified_folds(stratified_split(table, config=config), config=config)
    split.write.mode("overwrite").parquet(f"{output}/split")
    split = spark.read.parquet(f"{output}/split")
    fitted, log = models.train_all(split, models.full_grids() if grids is None else grids)
    for name, model in fitted.items():
        tables.save_model(model, f"{output}/models", name)
    tables.write_csv(metrics.rank_models(log, "val_roc_auc"), f"{output}/model_comparison")
    # nearest neighbours keep no artefact, so they cannot be the serving model
    best = metrics.best_model(log.where(F.col("model").isin(list(fitted))), "val_roc_auc").first()

    k, profiles = segment_customers(history, table, cutoff, output, config, n_init)
    tables.write_csv(profiles, f"{output}/segment_profiles")

    record = {
        "trained_at": datetime.now(timezone.utc).isoformat(),
        "n_customers": table.count(),
        "cutoff_date": str(cutoff),
        "best_model": best["model"] if best else None,
        "kmeans_k": k,
        "metrics": {c: best[c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc")} if best else {},
    }
    tables.append_metadata(spark, f"{output}/metadata", record)
    return record


def segment_customers(
    history: DataFrame, table: DataFrame, cutoff: datetime, output: str, config: RunConfig, n_init: int
) -> tuple[int, DataFrame]:
    """Cluster on features and affinities; append the assignments; return k and the profiles."""
    shares = feature_operators.affinity_pivot(history, cutoff, config.top_products)
    names = [c for c in shares.columns if c != "customer_id"]
    wide = table.join(shares, "customer_id", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in names})
    wide.write.mode("overwrite").parquet(f"{output}/segmentation_input")
    wide = table.sparkSession.read.parquet(f"{output}/segmentation_input")
    columns = feature_columns(wide, ("customer_id", "churned"))
    scaled = apply_scaler(wide, fit_scaler(wide, columns), columns)
    diagnostics = segment.find_optimal_k(scaled, columns, config.segment_counts, n_init, config.seed)
    k = diagnostics.where("is_best").first()["k"]
    clusters = segment.run_kmeans(scaled, columns, k, n_init, config.seed).select("customer_id", "cluster")
    labelled = table.join(clusters, "customer_id")
    profiles = segment.profile_segments(labelled)
    tables.append_records(segment.segment_assignments(labelled, profiles, "kmeans"), f"{output}/segments")
    return k, profiles
