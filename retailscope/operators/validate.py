"""Validation of transaction and feature tables: one aggregate pass, one small report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailscope.config import RunConfig
from retailscope.schema import CANONICAL_COLUMNS

REPORT_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def validate_schema(df: DataFrame, required: Sequence[str] = CANONICAL_COLUMNS) -> DataFrame:
    """One row per required column with its number of values, from one pass.

    A column passes when it is there and, unless the table is empty, holds a value.
    """
    present = [c for c in required if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in present])
    entries = [
        F.struct(
            F.lit(f"column:{c}").alias("rule"),
            (F.col(f"n_{c}") if c in present else F.lit(0)).cast("double").alias("value"),
            F.lit(1.0).alias("threshold"),
            ((F.col(f"n_{c}") >= 1) | (F.col("n_rows") == 0) if c in present else F.lit(False)).alias("passed"),
        )
        for c in required
    ]
    return counts.select(F.inline(F.array(*entries)))


def _null_rate(column: str) -> Column:
    return F.coalesce(F.avg(F.col(column).isNull().cast("double")), F.lit(0.0))


def _rows_outside(column: str, earliest: str, latest: str) -> Column:
    low, high = (F.expr(f"TIMESTAMP_NTZ'{day}'") for day in (earliest, latest))
    return F.count_if((F.col(column) < low) | (F.col(column) > high)).cast("double")


def _report(df: DataFrame, checks: list[tuple[str, Column, float]]) -> DataFrame:
    """Compute all checks in one pass; a check passes when its value does not exceed the threshold."""
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    measured = df.agg(*[value.alias(f"check_{i}") for i, (_, value, _) in enumerate(checks)])
    entries = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(f"check_{i}").alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            (F.col(f"check_{i}") <= threshold).alias("passed"),
        )
        for i, (rule, _, threshold) in enumerate(checks)
    ]
    return measured.select(F.inline(F.array(*entries)))


def _null_checks(df: DataFrame, limits: Mapping[str, float]) -> list[tuple[str, Column, float]]:
    return [(f"null_rate:{c}", _null_rate(c), limit) for c, limit in limits.items() if c in df.columns]


def validate_null_rates(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Null share per listed column; columns the table lacks are skipped."""
    return _report(df, _null_checks(df, limits))


def validate_date_range(df: DataFrame, column: str, earliest: str, latest: str) -> DataFrame:
    """Rows outside the inclusive range; missing dates pass here and are limited as a null rate."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(f"date_column:{column}", 0.0, 1.0, False)], REPORT_SCHEMA)
    return _report(df, [(f"date_range:{column}", _rows_outside(column, earliest, latest), 0.0)])


def run_validation(df: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Schema first; null rates and dates, fused in one pass, only when the schema is intact."""
    if missing_columns(df, CANONICAL_COLUMNS):
        return validate_schema(df)
    checks = _null_checks(df, config.max_null_rate)
    checks.append(("date_range:invoice_date", _rows_outside("invoice_date", config.date_min, config.date_max), 0.0))
    return _report(df, checks)


def raise_if_failed(report: DataFrame) -> None:
    """Raise with every failed rule; the report has one row per configured rule."""
    failed = report.where(~F.col("passed")).orderBy("rule").collect()
    if failed:
        lines = [f"{r['rule']} is {r['value']:g}, allowed {r['threshold']:g}" for r in failed]
        raise ValueError("data validation failed:\n- " + "\n- ".join(lines))


def feature_sanity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinite and missing values per numeric column, from one pass."""
    infinite = float("inf")

    def n_infinite(c: str) -> Column:
        return F.count_if(F.abs(F.col(c).cast("double")) == infinite)

    def n_missing(c: str) -> Column:
        return F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double")))

    measured = df.agg(
        *[n_infinite(c).alias(f"{c}__infinite") for c in columns],
        *[n_missing(c).alias(f"{c}__missing") for c in columns],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__infinite").alias("n_infinite"),
            F.col(f"{c}__missing").alias("n_missing"),
        )
        for c in columns
    ]
    return measured.select(F.inline(F.array(*entries)))


