"""Reporting queries over the feature, score and transaction tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.functions.ranks import percent_ranks
from retailscope.operators.features import history_rows, line_total

LOW_TIER, HIGH_TIER = 200, 1000


def value_tier() -> Column:
    """Low below 200, high above 1000, medium in between with both ends."""
    spend = F.col("monetary_total")
    return (
        F.when(spend < LOW_TIER, "low").when(spend.between(LOW_TIER, HIGH_TIER), "medium").when(spend > HIGH_TIER, "high")
    )


def filter_segment(features: DataFrame, tier: str | None = None, max_recency: int = 730) -> DataFrame:
    """Customers within the recency limit and, if named, in one value tier."""
    kept = features.where(F.col("recency_days") <= max_recency).withColumn("tier", value_tier())
    return kept if tier is None else kept.where(F.col("tier") == tier)


def tier_points(features: DataFrame, tier: str | None = None, max_recency: int = 730) -> DataFrame:
    """The plotted columns of the filtered customers."""
    return filter_segment(features, tier, max_recency).select(
        "customer_id", "tier", "recency_days", "monetary_total", "frequency", "engagement_score"
    )


def tier_counts(features: DataFrame, max_recency: int = 730) -> DataFrame:
    return filter_segment(features, None, max_recency).groupBy("tier").agg(F.count(F.lit(1)).alias("n_customers"))


def churn_leaderboard(features: DataFrame, scores: DataFrame | None = None, top: int = 50) -> DataFrame:
    """The ``top`` customers by half value rank, half churn risk.

    Risk is the churn probability where scores are given, else the recency rank.
    """
    metrics = ["monetary_total"] if scores is not None else ["monetary_total", "recency_days"]
    ranked = features.join(percent_ranks(features, "customer_id", metrics), "customer_id")
    shown = ["customer_id", "recency_days", "frequency", "monetary_total", "engagement_score"]
    if scores is not None:
        ranked = ranked.join(scores.select("customer_id", "churn_probability"), "customer_id", "left")
        risk = F.col("churn_probability")
        shown.append("churn_probability")
    else:
        risk = F.col("recency_days_rank")
    priority = F.col("monetary_total_rank") * 0.5 + risk * 0.5
    return (
        ranked.withColumn("priority_score", priority)
        .select(*shown, "priority_score")
        .orderBy(F.desc_nulls_last("priority_score"), "customer_id")
        .limit(top)
    )


def monthly_revenue(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Revenue of validly priced history lines per calendar month; summed in decimals across customers."""
    return (
        history_rows(lines, cutoff)
        .where(~F.col("is_invalid_price"))
        .groupBy(F.trunc(F.to_date("invoice_date"), "MM").alias("month"))
        .agg(F.sum(line_total()).cast("double").alias("revenue"))
    )


def revenue_forecast(revenue: DataFrame, fit_months: int = 12, ahead: int = 3) -> DataFrame:
    """The last ``fit_months`` months and a straight line through them, ``ahead`` months further."""
    last = revenue.agg(F.max("month")).scalar()
    recent = (
        revenue.withColumn("last_month", last)
        .withColumn("back", F.months_between(F.col("last_month"), F.col("month")).cast("int"))
        .where(F.col("back") < fit_months)
    )
    x = -F.col("back").cast("double")
    line = recent.agg(
        F.max("last_month").alias("last_month"),
        F.coalesce(F.regr_slope("revenue", x), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("revenue", x), F.avg("revenue")).alias("level"),
    )
    future = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("step")).select(
        F.lit("forecast").alias("kind"),
        F.to_date(F.add_months("last_month", F.col("step"))).alias("month"),
        (F.col("level") + F.col("slope") * F.col("step")).alias("revenue"),
    )
    actual = recent.select(F.lit("actual").alias("kind"), "month", "revenue")
    return actual.unionByName(future)


def customer_lookup(features: DataFrame, customer_id: int) -> DataFrame:
    """The feature row of one customer; the filter reaches the Parquet scan. Empty when unknown."""
    return features.where(F.col("customer_id") == customer_id)
