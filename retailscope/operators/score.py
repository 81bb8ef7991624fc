"""Batch scoring: validate each row, quarantine the bad ones with reasons, score the rest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS, FEATURE_RANGES, MODEL_VERSION

THRESHOLD = 0.5


def row_failures() -> Column:
    """Every broken rule of a scoring row as an array of messages; empty for a good row."""

    def message(bad: Column, text: str) -> Column:
        return F.when(bad, F.lit(text))

    checks = [
        message(F.col("customer_id").isNull(), "customer_id is missing"),
        message(F.col("customer_id") <= 0, "customer_id must be positive"),
    ]
    for c in FEATURE_COLUMNS:
        low, high = FEATURE_RANGES[c]
        value = F.col(c).cast("double")
        checks.append(message(value.isNull() | F.isnan(value), f"{c} is missing"))
        if low is not None:
            checks.append(message(value < low, f"{c} must be at least {low:g}"))
        if high is not None:
            checks.append(message((value > high) & ~F.isnan(value), f"{c} must be at most {high:g}"))
    broken = F.filter(F.array(*checks), lambda m: m.isNotNull())
    # a row whose fields all pass can still have had too many of them
    malformed = (F.size(broken) == 0) & F.col("corrupt_record").isNotNull()
    return F.when(malformed, F.array(F.lit("row is malformed"))).otherwise(broken)


def with_missing_columns(rows: DataFrame) -> DataFrame:
    """A column the input lacks is a missing value in every row, not a failed batch."""
    absent = [c for c in ("customer_id", *FEATURE_COLUMNS) if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else rows
    return rows if "corrupt_record" in rows.columns else rows.withColumn("corrupt_record", F.lit(None).cast("string"))


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit to score, rows to quarantine with ``reasons``)."""
    checked = with_missing_columns(rows).withColumn("reasons", row_failures())
    good = checked.where(F.size("reasons") == 0).drop("reasons", "corrupt_record")
    return good, checked.where(F.size("reasons") > 0)


def score_rows(
    rows: DataFrame,
    probability: Column,
    model_name: str,
    explanation: Column | None = None,
    scored_at: datetime | None = None,
) -> DataFrame:
    """The prediction record of every row; no lifetime value is predicted."""
    return rows.select(
        F.col("customer_id"),
        probability.alias("churn_probability"),
        (probability >= THRESHOLD).alias("churn_predicted"),
        F.lit(None).cast("double").alias("predicted_clv"),
        F.lit(model_name).alias("model_name"),
        F.lit(MODEL_VERSION).alias("model_version"),
        (explanation if explanation is not None else F.lit(None).cast("string")).alias("explanation"),
        (F.lit(scored_at) if scored_at else F.current_timestamp()).alias("scored_at"),
    )


def batch_summary(rows: DataFrame) -> DataFrame:
    """One row: how many rows were scored and how many failed. The quarantine table lists the errors."""
    checked = with_missing_columns(rows).select(F.size(row_failures()).alias("n_reasons"))
    return checked.agg(
        F.count_if(F.col("n_reasons") == 0).alias("n_scored"),
        F.count_if(F.col("n_reasons") > 0).alias("n_failed"),
    )
