"""Explanation queries over the fixed scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.functions import scorecard
from retailscope.operators import explain
from retailscope.operators import local_rules as rules
from retailscope.operators.prep import fit_scaler
from retailscope.operators.score import split_valid
from retailscope.queries.inputs import feature_table, rounded, scored, scoring_input
from retailscope.queries.sqltext import WEIGHTS, edge_sql, probability_sql, range_conditions, standard_sql, statement

PDP_FEATURES = FEATURE_COLUMNS
GRID_POINTS = 100


def scorer(spark: SparkSession, folder: str):
    """The scorecard as a function from raw feature columns to ``probability``."""
    scaler = fit_scaler(feature_table(spark, folder), FEATURE_COLUMNS)

    def score(rows: DataFrame) -> DataFrame:
        keep = [F.col(c) for c in rows.columns if c not in FEATURE_COLUMNS]
        p = scorecard.probability(scorecard.contributions()).alias("probability")
        raw = rows.withColumns({f"raw_{c}": F.col(c) for c in FEATURE_COLUMNS})
        z = scorecard.standard_scores(raw, scaler)
        return z.select(*keep, p, *[F.col(f"raw_{c}").alias(c) for c in FEATURE_COLUMNS])

    return score


def valid_features(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(feature_table(spark, folder))[0]


def linear_shap(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explain.long_attributions(scoring_input(spark, folder), scorecard.contributions()))


def global_importance(spark: SparkSession, folder: str) -> DataFrame:
    terms = scorecard.contributions()
    return rounded(explain.global_importance(explain.long_attributions(scoring_input(spark, folder), terms)))


def representatives(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explain.representatives(scored(spark, folder)))


def explanations(spark: SparkSession, folder: str) -> DataFrame:
    values = {c: F.col(f"raw_{c}") for c in FEATURE_COLUMNS}
    sentence = explain.plain_language(scorecard.contributions(), values)
    return scoring_input(spark, folder).select("customer_id", sentence.alias("explanation"))


def partial_dependence(spark: SparkSession, folder: str) -> DataFrame:
    rows = valid_features(spark, folder).select(*FEATURE_COLUMNS)
    return rounded(explain.partial_dependence(rows, scorer(spark, folder), PDP_FEATURES, GRID_POINTS))


def sampled_shap(spark: SparkSession, folder: str) -> DataFrame:
    rows = valid_features(spark, folder)
    background = explain.background_sample(rows, FEATURE_COLUMNS)
    return explain.sampled_attributions(rows, scorer(spark, folder), FEATURE_COLUMNS, background)


def local_surrogate(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogates around the three representative customers."""
    table = feature_table(spark, folder)
    chosen = explain.representatives(scored(spark, folder)).select("customer_id").distinct()
    instances = table.join(F.broadcast(chosen), "customer_id")  # at most three rows
    return explain.local_surrogate(
        instances, scorer(spark, folder), fit_scaler(table, FEATURE_COLUMNS), FEATURE_COLUMNS
    )


def local_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The conditions that move the scores of the three representative customers."""
    rows = valid_features(spark, folder).select("customer_id", *FEATURE_COLUMNS)
    chosen = explain.representatives(scored(spark, folder)).select("customer_id").distinct()
    instances = rows.join(F.broadcast(chosen), "customer_id")  # at most three rows
    return rules.local_rules(instances, scorer(spark, folder), rows, FEATURE_COLUMNS)


QUERIES = {
    "linear_shap": linear_shap,
    "global_importance": global_importance,
    "representatives": representatives,
    "explanations": explanations,
    "partial_dependence": partial_dependence,
    "sampled_shap": sampled_shap,
    "local_surrogate": local_surrogate,
    "local_rules": local_rules,
}

ATTRIBUTIONS = " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, t_{c} AS attribution FROM terms" for c in FEATURE_COLUMNS
)


def clause_sql(c: str) -> str:
    shown = f"CAST(CAST(CAST({c} AS DECIMAL(24, 6)) AS DECIMAL(22, 2)) AS VARCHAR)"
    return (
        f"SELECT customer_id, '{c}' AS feature, abs(t_{c}) AS strength, '{explain.readable(c)} (' || {shown} || ') ' "
        f"|| CASE WHEN t_{c} > 0 THEN 'increases' ELSE 'decreases' END || ' churn risk' AS clause FROM terms"
    )


def curve_sql(feature: str) -> str:
    def term(c: str) -> str:
        z = standard_sql(c)
        if c == feature:
            z = f"((v - {c}_mean) / CASE WHEN {c}_std = 0 THEN 1 ELSE {c}_std END)"
        return f"CAST({WEIGHTS[c]} AS DOUBLE) * least(greatest({z}, -5.0::DOUBLE), 5.0::DOUBLE)"

    return f"""
        SELECT '{feature}' AS feature, CAST(i AS INTEGER) AS grid_point, round(any_value(v), 6) AS grid_value,
               round(avg({probability_sql(FEATURE_COLUMNS, term)}), 6) AS average_prediction
        FROM good, full_scaler, (
            SELECT i, lo + i * ((hi - lo) / {GRID_POINTS - 1}) AS v
            FROM (SELECT quantile_cont(CAST({feature} AS DOUBLE), 0.05) AS lo,
                         quantile_cont(CAST({feature} AS DOUBLE), 0.95) AS hi FROM good), range({GRID_POINTS}) AS g(i))
        GROUP BY i"""


SQL = {
    "linear_shap": statement(("terms",), f"""
        SELECT customer_id, feature, {edge_sql('attribution')} AS attribution FROM ({ATTRIBUTIONS})"""),
    "global_importance": statement(("terms",), f"""
        SELECT feature, round(avg(abs(attribution)), 6) AS mean_abs_attribution FROM ({ATTRIBUTIONS}) GROUP BY feature"""),
    "representatives": statement(("scores",), " UNION ALL ".join(
        f"(SELECT '{kind}' AS kind, customer_id, round(churn_probability, 6) AS probability FROM scores "
        f"ORDER BY {order}, customer_id LIMIT 1)"
        for kind, order in (("low_risk", "churn_probability"), ("high_risk", "churn_probability DESC"),
                            ("borderline", "abs(churn_probability - 0.5)")))),
    "explanations": statement(("terms",), f"""
        SELECT customer_id, 'This customer''s churn risk is driven mainly by: '
               || string_agg(clause, '; ' ORDER BY strength DESC, feature) || '.' AS explanation
        FROM (SELECT * FROM ({' UNION ALL '.join(clause_sql(c) for c in FEATURE_COLUMNS)})
              QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY strength DESC, feature) <= 3)
        GROUP BY customer_id"""),
    "partial_dependence": statement(("features", "full_scaler"), f"""
        SELECT * FROM (WITH good AS (SELECT * FROM features WHERE {range_conditions()})
        {' UNION ALL '.join(curve_sql(f) for f in PDP_FEATURES)})"""),
}
