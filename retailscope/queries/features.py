"""Point-in-time feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import features, validate
from retailscope.queries.inputs import (
    CONFIG, build_features, feature_table, history_input, returning, rounded,
)
from retailscope.queries.sqltext import AFFINITY_COLUMNS, FEATURE_DOUBLES, rounded_sql, statement
from retailscope.sources import star_schema


def over_history(operator):
    """A query that applies a feature operator to the history lines."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        history, moment = history_input(spark, folder)
        return rounded(operator(history, moment))

    return query


def cutoff_date(spark: SparkSession, folder: str) -> DataFrame:
    return features.cutoff_date(star_schema.invoice_dates(spark, folder), CONFIG.churn_window_days)


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return features.top_products(history, moment, CONFIG.top_products).select(
        F.col("rank").cast("bigint").alias("rank"), "stock_code", F.col("spend").cast("double").alias("spend")
    )


def affinity_long(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    shares = features.affinity_long(history, moment, CONFIG.top_products)
    return rounded(shares.withColumn("rank", F.col("rank").cast("bigint")))


def engagement_score(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return rounded(features.compute_engagement_score(features.compute_rfm(history, moment)))


def churn_label(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    customers = features.history_rows(history, moment).select("customer_id").distinct()
    return features.label_churn(customers, returning(spark, folder, moment))


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(build_features(spark, folder))


def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.class_balance(feature_table(spark, folder)))


def feature_sanity(spark: SparkSession, folder: str) -> DataFrame:
    return validate.feature_sanity(feature_table(spark, folder), FEATURE_COLUMNS)


QUERIES = {
    "cutoff_date": cutoff_date,
    "history_rows": over_history(features.history_rows),
    "rfm": over_history(features.compute_rfm),
    "historical_clv": over_history(features.compute_historical_clv),
    "basket_size": over_history(features.compute_basket_size),
    "purchase_trend": over_history(features.compute_purchase_trend),
    "interval_variance": over_history(features.compute_purchase_interval_variance),
    "seasonal_concentration": over_history(features.compute_seasonal_concentration),
    "top_products": top_products,
    "affinity_long": affinity_long,
    "affinity_pivot": over_history(features.affinity_pivot),
    "return_rate": over_history(features.compute_return_rate),
    "discount_sensitivity": over_history(features.compute_discount_sensitivity),
    "engagement_score": engagement_score,
    "churn_label": churn_label,
    "customer_features": customer_features,
    "class_balance": class_balance,
    "feature_sanity": feature_sanity,
}


def one_feature(source: str, *columns: str) -> str:
    return statement((source,), f"SELECT customer_id, {rounded_sql(columns)} FROM {source}")


SQL = {
    "cutoff_date": statement(("cut",), "SELECT cutoff AS cutoff_date FROM cut"),
    "history_rows": statement(("history",), "SELECT * EXCLUDE (cutoff, amount) FROM history"),
    "rfm": statement(("rfm",), f"""
        SELECT customer_id, CAST(recency_days AS BIGINT) AS recency_days, frequency,
               {rounded_sql(("monetary_total", "monetary_avg"))} FROM rfm"""),
    "historical_clv": one_feature("clv", "historical_clv"),
    "basket_size": one_feature("basket", "avg_basket_size"),
    "purchase_trend": one_feature("trend", "purchase_trend_slope"),
    "interval_variance": one_feature("intervals", "purchase_interval_variance"),
    "seasonal_concentration": one_feature("seasonal", "seasonal_concentration"),
    "top_products": statement(("top",), "SELECT rank, stock_code, CAST(spend AS DOUBLE) AS spend FROM top"),
    "affinity_long": statement(("affinity",), """
        SELECT customer_id, rank, stock_code, round(share, 6) AS share FROM affinity"""),
    "affinity_pivot": one_feature("affinity_wide", *AFFINITY_COLUMNS),
    "return_rate": one_feature("returns", "return_rate"),
    "discount_sensitivity": one_feature("discount", "discount_sensitivity"),
    "engagement_score": one_feature("engaged", "engagement_score"),
    "churn_label": statement(("label",), "SELECT customer_id, churned FROM label"),
    "customer_features": statement(("features",), f"""
        SELECT customer_id, recency_days, frequency, {rounded_sql(FEATURE_DOUBLES)}, churned FROM features"""),
    "class_balance": statement(("features",), """
        SELECT churned, count(*) AS n_customers, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM features GROUP BY churned"""),
    "feature_sanity": statement(("features",), " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (isinf(CAST({c} AS DOUBLE))) AS n_infinite, "
        f"count(*) FILTER ({c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS n_missing FROM features"
        for c in FEATURE_COLUMNS
    )),
}
