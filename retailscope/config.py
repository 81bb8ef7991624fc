"""Run parameters and the fixed column lists every module shares."""

from __future__ import annotations

from dataclasses import dataclass, field

# Administrative stock codes that are not products.
NON_PRODUCT_CODES = ("POST", "D", "DOT", "M", "BANK CHARGES", "PADS", "CRUK", "C2")

# The signature of an exact duplicate invoice line.
DEDUP_COLUMNS = ("invoice", "stock_code", "customer_id", "quantity", "invoice_date", "price")

# The model feature columns, in scoring order.
FEATURE_COLUMNS = (
    "recency_days", "frequency", "monetary_total", "monetary_avg", "historical_clv",
    "avg_basket_size", "purchase_trend_slope", "purchase_interval_variance",
    "seasonal_concentration", "return_rate", "discount_sensitivity", "engagement_score",
)

# Every feature but historical_clv is standardised for scale-sensitive models.
SCALE_SENSITIVE_COLUMNS = tuple(c for c in FEATURE_COLUMNS if c != "historical_clv")

# The columns a segment profile summarises.
PROFILE_COLUMNS = (
    "recency_days", "frequency", "monetary_total", "engagement_score",
    "return_rate", "seasonal_concentration",
)

# Accepted range per scoring column; None means unbounded on that side.
FEATURE_RANGES = {
    **{c: (0.0, None) for c in FEATURE_COLUMNS},
    "purchase_trend_slope": (None, None),
    "seasonal_concentration": (0.0, 1.0),
    "return_rate": (0.0, 1.0),
    "discount_sensitivity": (0.0, 1.0),
    "engagement_score": (0.0, 100.0),
}

MODEL_VERSION = "1.0.0"
FALLBACK_MODEL_NAME = "boosted_trees"


@dataclass(frozen=True)
class RunConfig:
    """What a run may vary; the defaults are the published settings."""

    churn_window_days: int = 90
    iqr_multiplier: float = 1.5
    top_products: int = 10
    non_product_codes: tuple[str, ...] = NON_PRODUCT_CODES
    dedup_columns: tuple[str, ...] = DEDUP_COLUMNS
    max_null_rate: dict[str, float] = field(
        default_factory=lambda: {"description": 0.02, "customer_id": 0.30, "invoice_date": 0.0}
    )
    date_min: str = "2009-12-01"
    date_max: str = "2011-12-10"
    train_size: float = 0.70
    val_size: float = 0.15
    seed: int = 42
    segment_counts: tuple[int, ...] = (2, 3, 4, 5, 6, 7)


def load_config(path: str) -> RunConfig:
    """Read a RunConfig from a YAML file holding any subset of its fields."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        given = yaml.safe_load(handle) or {}
    for name in ("non_product_codes", "dedup_columns", "segment_counts"):
        if name in given:
            given[name] = tuple(given[name])
    return RunConfig(**given)
