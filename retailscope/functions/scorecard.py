"""A fixed logistic scorecard: a scorer whose probability any engine can reproduce.

Downstream operators only see a probability column, so fitted models plug into the same place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators.prep import apply_scaler

# Weights on standard scores clipped to five deviations.
INTERCEPT = 0.3
CLIP = 5.0
WEIGHTS = {
    "recency_days": 0.9,
    "frequency": -0.6,
    "monetary_total": -0.2,
    "monetary_avg": -0.1,
    "historical_clv": -0.1,
    "avg_basket_size": 0.05,
    "purchase_trend_slope": -0.3,
    "purchase_interval_variance": 0.1,
    "seasonal_concentration": 0.2,
    "return_rate": 0.15,
    "discount_sensitivity": 0.1,
    "engagement_score": -0.4,
}

# Scorecards compared with each other: all features, purchase behaviour only, recency only.
VARIANTS = {
    "scorecard_full": WEIGHTS,
    "scorecard_rfm": {c: WEIGHTS[c] for c in ("recency_days", "frequency", "monetary_total")},
    "scorecard_recency": {"recency_days": WEIGHTS["recency_days"]},
}

PROBABILITY_DIGITS = 9


def clipped(score: Column) -> Column:
    return F.least(F.greatest(score, F.lit(-CLIP)), F.lit(CLIP))


def contributions(weights: Mapping[str, float] = WEIGHTS) -> dict[str, Column]:
    """The additive term of every feature, over columns of standard scores."""
    return {c: F.lit(w) * clipped(F.col(c).cast("double")) for c, w in weights.items()}


def probability(terms: Mapping[str, Column]) -> Column:
    """Logistic of the summed terms, rounded so that equal rows rank as exact ties everywhere."""
    score = F.lit(INTERCEPT)
    for term in terms.values():
        score = score + term
    return F.round(1 / (1 + F.exp(-score)), PROBABILITY_DIGITS)


def standard_scores(df: DataFrame, scaler: DataFrame) -> DataFrame:
    return apply_scaler(df, scaler, FEATURE_COLUMNS)
