"""Cleaning: rows are flagged, never dropped, except exact copies of an invoice line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.config import DEDUP_COLUMNS, NON_PRODUCT_CODES, RunConfig
from retailscope.functions.ranks import exact_quantiles
from retailscope.schema import PRICE_VALUE
from retailscope.sources.shared import materialize

OUTLIER_COLUMNS = ("quantity", "price")


def flag_missing_customer_id(df: DataFrame) -> DataFrame:
    return df.withColumn("is_missing_customer_id", F.col("customer_id").isNull())


def flag_returns(df: DataFrame) -> DataFrame:
    return df.withColumn("is_return", F.col("quantity") < 0)


def flag_invalid_price(df: DataFrame) -> DataFrame:
    """A missing price is not an invalid one: it simply adds nothing to sums.

    Where the price is there as a double too, that one tells, as it keeps prices under a millionth.
    """
    price = F.coalesce(F.col(PRICE_VALUE), F.col("price").cast("double")) if PRICE_VALUE in df.columns else F.col("price")
    return df.withColumn("is_invalid_price", F.coalesce(price <= 0, F.lit(False)))


def signature(df: DataFrame, subset: Sequence[str]) -> list[str]:
    """The columns that make two rows copies: a price counts with all its digits where they are there."""
    return [*subset, *([PRICE_VALUE] if "price" in subset and PRICE_VALUE in df.columns else [])]


def flag_non_product_rows(df: DataFrame, codes: Sequence[str] = NON_PRODUCT_CODES) -> DataFrame:
    listed = F.upper("stock_code").isin([c.upper() for c in codes])
    return df.withColumn("is_non_product", F.coalesce(listed, F.lit(False)))


def add_row_flags(df: DataFrame, codes: Sequence[str] = NON_PRODUCT_CODES) -> DataFrame:
    """The four row-local flags."""
    return (
        df.transform(flag_missing_customer_id)
        .transform(flag_returns)
        .transform(flag_invalid_price)
        .transform(flag_non_product_rows, codes)
    )


def iqr_bounds(df: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Quartiles and fences per numeric column, from one scan for all columns."""
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in OUTLIER_COLUMNS])
        ).alias("cell")
    ).select("cell.metric", "cell.value")
    quartiles = exact_quantiles(cells, F.col("value"), {"q1": 0.25, "q3": 0.75}, ["metric"])
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "metric", "q1", "q3",
        (F.col("q1") - multiplier * spread).alias("lower"),
        (F.col("q3") + multiplier * spread).alias("upper"),
    )


def flag_price_quantity_outliers(
    df: DataFrame, multiplier: float = 1.5, bounds: DataFrame | None = None
) -> DataFrame:
    """Flag values outside the global fences; a missing price is no outlier, a missing quantity is unknown.

    ``bounds`` may hold fences taken from another table than ``df``.
    """
    bounds = iqr_bounds(df, multiplier) if bounds is None else bounds
    fences = bounds.agg(
        F.struct(
            *[
                F.max(F.when(F.col("metric") == c, F.col(side))).alias(f"{c}_{side}")
                for c in OUTLIER_COLUMNS for side in ("lower", "upper")
            ]
        )
    ).scalar()

    def outside(c: str) -> Column:
        value = F.col(c).cast("double")
        beyond = (value < F.col(f"fences.{c}_lower")) | (value > F.col(f"fences.{c}_upper"))
        return F.coalesce(beyond, F.lit(False)) if c == "price" else beyond

    flagged = df.withColumn("fences", fences)
    return flagged.withColumns({f"is_{c}_outlier": outside(c) for c in OUTLIER_COLUMNS}).drop("fences")


def tidy_text(text: Column) -> Column:
    """Strip, upper-case and collapse white space, non-breaking spaces included."""
    return F.upper(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def canonical_descriptions(df: DataFrame) -> DataFrame:
    """The most frequent tidy description per stock code; ties go to the alphabetically first.

    Texts are counted as they are first, so tidying runs once per distinct text and a hot stock code
    reaches its pick as distinct texts, not rows.
    """
    known = F.col("stock_code").isNotNull() & F.col("description").isNotNull()
    texts = df.where(known).groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("n"))
    counted = texts.groupBy("stock_code", tidy_text(F.col("description")).alias("text")).agg(F.sum("n").alias("n"))
    return counted.groupBy("stock_code").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("text"))).getField("text").alias("canonical")
    )


def standardize_descriptions(df: DataFrame) -> DataFrame:
    """Replace every description by its stock code's canonical one; missing ones are filled too.

    The catalogue is written first, so its measured size decides whether it is broadcast; if so, the
    lines are never shuffled by product.
    """
    catalogue = materialize(canonical_descriptions(df), "catalogue")
    return (
        df.join(catalogue, "stock_code", "left")
        .withColumn("description", F.coalesce("canonical", tidy_text(F.col("description"))))
        .drop("canonical")
        .select(*df.columns)
    )


def deduplicate_transactions(df: DataFrame, subset: Sequence[str] = DEDUP_COLUMNS) -> DataFrame:
    """Keep one row per signature, nulls being equal.

    Among copies that differ elsewhere the earliest sheet wins, then the smallest remaining values,
    whatever the partitioning.
    Copies collapse before the shuffle, so a signature that holds a third of all rows moves once per task.
    """
    subset = signature(df, subset)
    rest = sorted((c for c in df.columns if c not in subset), key=lambda c: c != "source_sheet")
    if not rest:
        return df.dropDuplicates(list(subset))
    survivor = F.min(F.struct(*rest)).alias("survivor")
    return df.groupBy(*subset).agg(survivor).select(*[c if c in subset else f"survivor.{c}" for c in df.columns])


def duplicate_counts(df: DataFrame, subset: Sequence[str] = DEDUP_COLUMNS) -> DataFrame:
    """One row: rows before, rows kept and rows removed by deduplication."""
    groups = df.groupBy(*signature(df, subset)).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_before"),
        F.count(F.lit(1)).alias("n_kept"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_removed"),
    )


def clean_transactions(df: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Every rule; quartiles and canonical texts are taken before copies are removed.

    The flags depend on the signature columns alone, so they are set on the survivors: the wide shuffle
    of deduplication does not carry them.
    """
    bounds = iqr_bounds(df, config.iqr_multiplier)
    kept = standardize_descriptions(df).transform(deduplicate_transactions, config.dedup_columns)
    flagged = add_row_flags(kept, config.non_product_codes)
    return flag_price_quantity_outliers(flagged, config.iqr_multiplier, bounds)


def clean_for_features(df: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """The part of cleaning that customer features read: signature columns, copies removed, row flags.

    Outlier flags and descriptions feed no feature, so their scans are left out.
    """
    kept = df.select(*signature(df, config.dedup_columns)).dropDuplicates()
    return add_row_flags(kept, config.non_product_codes)
