"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import reports
from retailscope.queries.inputs import feature_table, history_input, rounded, scored
from retailscope.queries.sqltext import FEATURE_DOUBLES, percent_rank_sql, piece, rounded_sql, statement

MAX_RECENCY = 365
LOOKUP_ID = 12042


def tier_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.tier_points(feature_table(spark, folder), max_recency=MAX_RECENCY))


def tier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.tier_counts(feature_table(spark, folder), MAX_RECENCY)


def leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.churn_leaderboard(feature_table(spark, folder), scored(spark, folder)))


def leaderboard_by_recency(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.churn_leaderboard(feature_table(spark, folder)))


def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return rounded(reports.monthly_revenue(history, moment), 2)


def revenue_forecast(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return rounded(reports.revenue_forecast(reports.monthly_revenue(history, moment)), 2)


def customer_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.customer_lookup(feature_table(spark, folder), LOOKUP_ID))


QUERIES = {
    "tier_filter": tier_filter,
    "tier_counts": tier_counts,
    "leaderboard": leaderboard,
    "leaderboard_by_recency": leaderboard_by_recency,
    "monthly_revenue": monthly_revenue,
    "revenue_forecast": revenue_forecast,
    "customer_lookup": customer_lookup,
}

TIER = """CASE WHEN monetary_total < 200 THEN 'low' WHEN monetary_total BETWEEN 200 AND 1000 THEN 'medium'
               WHEN monetary_total > 1000 THEN 'high' END"""
piece("revenue", ("history",), """
    SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS revenue
    FROM history WHERE NOT is_invalid_price GROUP BY 1""")
piece("recent", ("revenue",), """
    SELECT month, revenue, date_diff('month', (SELECT max(month) FROM revenue), month) AS x,
           (SELECT max(month) FROM revenue) AS last_month FROM revenue
    WHERE date_diff('month', month, (SELECT max(month) FROM revenue)) < 12""")
SHOWN = "customer_id, recency_days, frequency, round(monetary_total, 6) AS monetary_total, round(engagement_score, 6) AS engagement_score"

SQL = {
    "tier_filter": statement(("features",), f"""
        SELECT customer_id, {TIER} AS tier, recency_days, round(monetary_total, 6) AS monetary_total, frequency,
               round(engagement_score, 6) AS engagement_score FROM features WHERE recency_days <= {MAX_RECENCY}"""),
    "tier_counts": statement(("features",), f"""
        SELECT {TIER} AS tier, count(*) AS n_customers FROM features WHERE recency_days <= {MAX_RECENCY} GROUP BY 1"""),
    "leaderboard": statement(("features", "scores"), f"""
        SELECT {SHOWN}, round(churn_probability, 6) AS churn_probability, round(priority_score, 6) AS priority_score
        FROM (SELECT features.*, churn_probability,
                     {percent_rank_sql('monetary_total')} * 0.5 + churn_probability * 0.5 AS priority_score
              FROM features LEFT JOIN (SELECT customer_id, churn_probability FROM scores) USING (customer_id)) AS ranked
        ORDER BY ranked.priority_score DESC NULLS LAST, customer_id LIMIT 50"""),
    "leaderboard_by_recency": statement(("features",), f"""
        SELECT {SHOWN}, round(priority_score, 6) AS priority_score
        FROM (SELECT *, {percent_rank_sql('monetary_total')} * 0.5 + {percent_rank_sql('recency_days')} * 0.5
                     AS priority_score FROM features) AS ranked
        ORDER BY ranked.priority_score DESC NULLS LAST, customer_id LIMIT 50"""),
    "monthly_revenue": statement(("revenue",), "SELECT month, round(revenue, 2) AS revenue FROM revenue"),
    "revenue_forecast": statement(("recent",), """
        SELECT 'actual' AS kind, month, round(revenue, 2) AS revenue FROM recent
        UNION ALL
        SELECT 'forecast', CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE), round(level + slope * step, 2)
        FROM (SELECT any_value(last_month) AS last_month, regr_slope(revenue, CAST(x AS DOUBLE)) AS slope,
                     regr_intercept(revenue, CAST(x AS DOUBLE)) AS level FROM recent), range(1, 4) AS s(step)"""),
    "customer_lookup": statement(("features",), f"""
        SELECT customer_id, recency_days, frequency, {rounded_sql(FEATURE_DOUBLES)}, churned
        FROM features WHERE customer_id = {LOOKUP_ID}"""),
}
