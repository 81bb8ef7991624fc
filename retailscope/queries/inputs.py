"""Inputs shared by the registered queries, all derived from the tables in the given folder."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import DEDUP_COLUMNS, FEATURE_COLUMNS, RunConfig
from retailscope.functions import scorecard
from retailscope.operators import clean, features
from retailscope.operators.prep import fit_scaler, stratified_split
from retailscope.operators.score import split_valid
from retailscope.plans.feature_table import customer_features
from retailscope.sources import star_schema
from retailscope.sources.shared import materialize, partitions_for

# The rules here plant nulls and dates of their own, so the accepted range differs from the default.
CONFIG = RunConfig(date_min="1995-01-01", date_max="2001-08-02")

_written: dict[tuple[str, str, str], DataFrame] = {}


def written_once(label: str, spark: SparkSession, folder: str, build) -> DataFrame:
    """Build a table once per session and folder and read it back from shared storage afterwards.

    Downstream consumers read the persisted feature table instead of rebuilding it, as a scheduled run
    would. The tables below ``folder`` are taken as fixed for the life of the session.
    """
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _written:
        with partitions_for(spark, line_count(spark, folder)):
            _written[key] = materialize(build(), label)
    return _written[key]


_line_counts: dict[tuple[str, str], int] = {}


def line_count(spark: SparkSession, folder: str) -> int:
    """Rows of the largest table, from the footers of its files."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _line_counts:
        _line_counts[key] = star_schema.read_table(spark, folder, "lineitem").count()
    return _line_counts[key]


_cutoffs: dict[tuple[str, str], datetime] = {}


def cutoff(spark: SparkSession, folder: str) -> datetime:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _cutoffs:
        dates = star_schema.invoice_dates(spark, folder)
        with partitions_for(spark, line_count(spark, folder)):  # orders meet all lines here as well
            _cutoffs[key] = features.cutoff_date(dates, CONFIG.churn_window_days).first()["cutoff_date"]
    return _cutoffs[key]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.transactions(spark, folder)


def lines(spark: SparkSession, folder: str, until: datetime | None = None) -> DataFrame:
    """Deduplicated, flagged lines with the signature columns; ``until`` bounds the scanned days."""
    days_to = until.date().isoformat() if until else None
    rows = star_schema.transactions(spark, folder, DEDUP_COLUMNS, days_to=days_to)
    return clean.clean_for_features(rows, CONFIG)


def history_input(spark: SparkSession, folder: str) -> tuple[DataFrame, datetime]:
    """Cleaned lines up to the cutoff, written once: features read a cleaned table, not raw lines."""
    moment = cutoff(spark, folder)
    cleaned = written_once("cleaned-history", spark, folder, lambda: lines(spark, folder, until=moment))
    return cleaned, moment


def returning(spark: SparkSession, folder: str, moment: datetime) -> DataFrame:
    """Customers seen in the churn window, from a scan bounded to the days around it."""
    end = moment + timedelta(days=CONFIG.churn_window_days)
    window = star_schema.transactions(
        spark, folder, ("customer_id", "invoice_date"),
        days_from=moment.date().isoformat(), days_to=end.date().isoformat(),
    )
    return features.future_customers(window, moment, CONFIG.churn_window_days)


def build_features(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return customer_features(history, moment, CONFIG, returning(spark, folder, moment))


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return written_once("customer-features", spark, folder, lambda: build_features(spark, folder))


def wide_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features plus affinity columns, the segmentation input; customers without affinity get zeros."""

    def build() -> DataFrame:
        history, moment = history_input(spark, folder)
        shares = features.affinity_pivot(history, moment, CONFIG.top_products)
        names = [c for c in shares.columns if c != "customer_id"]
        joined = feature_table(spark, folder).join(shares, "customer_id", "left")
        return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in names})

    return written_once("wide-features", spark, folder, build)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns at the output edge, so equal results compare equal across engines.

    Scales, rounds half away from zero and scales back in doubles, as the checking engine does; rounding
    the decimal text instead would differ on values that end exactly in a half.
    """
    scale = float(10**digits)

    def edge(name: str):
        scaled = F.abs(name) * scale
        # beyond 2 ** 52 a double has no fraction left, and a 64-bit floor would saturate
        steps = F.when(scaled < 2.0**52, F.floor(scaled + 0.5).cast("double")).otherwise(scaled)
        return F.when(F.col(name) < 0, -steps).otherwise(steps) / scale + 0.0

    changed = {n: edge(n) for n, t in df.dtypes if t == "double"}
    return df.withColumns(changed) if changed else df


def scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    """Rows fit to score: standard scores in the feature columns, the original values as ``raw_*``."""
    table = feature_table(spark, folder)
    good, _ = split_valid(table)
    kept = good.withColumns({f"raw_{c}": F.col(c) for c in FEATURE_COLUMNS})
    return scorecard.standard_scores(kept, fit_scaler(table, FEATURE_COLUMNS))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """The scorecard's probability per customer, with label and split, written once per session."""

    def build() -> DataFrame:
        z = scoring_input(spark, folder)
        scores = z.select(
            "customer_id",
            *[
                scorecard.probability(scorecard.contributions(weights)).alias(name)
                for name, weights in scorecard.VARIANTS.items()
            ],
        )
        splits = stratified_split(feature_table(spark, folder)).select("customer_id", "churned", "split")
        return splits.join(scores, "customer_id").withColumn("churn_probability", F.col("scorecard_full"))

    return written_once("scores", spark, folder, build)
