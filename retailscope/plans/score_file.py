"""Scoring a file with a saved model: score and explain good rows, set bad ones apart, append both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators.explain import plain_language, sampled_attributions
from retailscope.operators.logistic import LinearModel
from retailscope.operators.models import Model, score_with
from retailscope.operators.score import batch_summary, score_rows, split_valid
from retailscope.sources import tables
from retailscope.operators.tree_models import TreeModel
from retailscope.sources.shared import materialize

REASONS_SEPARATOR = "; "


def explained(good: DataFrame, model: Model, background: Sequence[Sequence[float]]) -> tuple[DataFrame, dict[str, Column]]:
    """Scored rows, and each feature's share of a row's score as a column.

    Trees and linear models explain themselves exactly while they score, in one pass; any other model is
    explained by walks from ``background`` rows.
    """
    if isinstance(model, TreeModel):
        return model.attributions(score_with(model, good)), {c: F.col("attributions")[c] for c in FEATURE_COLUMNS}
    if isinstance(model, LinearModel):
        return score_with(model, good), model.terms()

    def scorer(table: DataFrame) -> DataFrame:
        return score_with(model, table).drop("predicted")

    asked = good.select(F.col("request").alias("customer_id"), *FEATURE_COLUMNS)
    shares = sampled_attributions(asked, scorer, FEATURE_COLUMNS, background)
    by_feature = shares.groupBy(F.col("customer_id").alias("request")).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("attribution"))).alias(f"share_{c}") for c in FEATURE_COLUMNS]
    )
    return score_with(model, good).join(by_feature, "request"), {c: F.col(f"share_{c}") for c in FEATURE_COLUMNS}


def score_file(
    spark: SparkSession, path: str, models: str, name: str, output: str, background: Sequence[Sequence[float]] = (),
) -> DataFrame:
    """Score the CSV file at ``path`` with the model ``name`` below ``models``; returns the summary row.

    Predictions with an explaining sentence are appended to ``output/predictions``, rows that are malformed
    or break a rule to ``output/quarantine`` with their reasons. ``background`` are the rows that sampled
    attributions start from, for models without exact ones. A customer listed twice is scored twice.
    """
    rows = materialize(
        tables.read_scoring_csv(spark, path).withColumn("request", F.monotonically_increasing_id()), "scoring-rows"
    )
    good, bad = split_valid(rows)
    scored, shares = explained(good, tables.load_model(models, name), background)
    sentence = plain_language(shares, {c: F.col(c) for c in FEATURE_COLUMNS})
    tables.append_records(score_rows(scored, F.col("probability"), name, sentence), f"{output}/predictions")
    reasons = F.array_join("reasons", REASONS_SEPARATOR).alias("reasons")
    tables.append_records(bad.select("customer_id", "corrupt_record", reasons), f"{output}/quarantine")
    return batch_summary(rows)
