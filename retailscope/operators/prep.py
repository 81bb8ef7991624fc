"""Splits, folds, scaling and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailscope.config import SCALE_SENSITIVE_COLUMNS, RunConfig
from retailscope.functions.ranks import cumulative_histogram

SPLIT_NAMES = ("train", "val", "test")
HASH_DIGITS = 15  # hexadecimal digits: 60 bits, so a bigint holds them
BUCKET_SHIFT = 4 * HASH_DIGITS - 7


def hash_position(row_id: str, seed: str) -> Column:
    """A uniform 60-bit number per row, the same on any cluster and partitioning."""
    text = F.concat(F.col(row_id).cast("string"), F.lit(f"-{seed}"))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def stratified_parts(
    df: DataFrame, row_id: str, stratum: str, seed: str, cumulative: Sequence[float]
) -> DataFrame:
    """Add ``part``: 0 .. len(cumulative), exact quotas per stratum in hash order.

    The quota boundaries are order statistics of the hash, found through bucket counts, so no stratum is
    ever sorted in one task. The boundary table has one row per class and is broadcast.
    """
    placed = df.withColumn("position", hash_position(row_id, seed))
    ranked = cumulative_histogram(
        placed, F.col("position"), [stratum], bucket=F.shiftright("value", BUCKET_SHIFT)
    )
    bounds = ranked.groupBy(stratum).agg(
        *[
            F.coalesce(
                F.max(F.when(F.col("below") < F.floor(F.lit(share) * F.col("total") + 0.5), F.col("value"))),
                F.lit(-1),
            ).alias(f"bound_{i}")
            for i, share in enumerate(cumulative)
        ]
    )
    passed = [(F.col("position") > F.col(f"bound_{i}")).cast("int") for i in range(len(cumulative))]
    part = sum(passed[1:], passed[0])
    return (
        placed.join(F.broadcast(bounds), stratum)
        .withColumn("part", part)
        .select(*df.columns, "part")
    )


def stratified_split(df: DataFrame, target: str = "churned", config: RunConfig = RunConfig()) -> DataFrame:
    """Add ``split``: train, val or test with the class shares kept in each."""
    cumulative = (config.train_size, config.train_size + config.val_size)
    parts = stratified_parts(df, "customer_id", target, f"split-{config.seed}", cumulative)
    names = F.array(*[F.lit(n) for n in SPLIT_NAMES])
    return parts.withColumn("split", F.element_at(names, F.col("part") + 1)).drop("part")


def stratified_folds(
    df: DataFrame, target: str = "churned", folds: int = 5, config: RunConfig = RunConfig()
) -> DataFrame:
    """Add ``fold``: 0 .. folds-1, equal shares of every class."""
    cumulative = [i / folds for i in range(1, folds)]
    return stratified_parts(df, "customer_id", target, f"fold-{config.seed}", cumulative).withColumnRenamed(
        "part", "fold"
    )


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """The columns of a table that a model may read, in their order."""
    return [c for c in df.columns if c not in exclude]


def fit_scaler(train: DataFrame, columns: Sequence[str] = SCALE_SENSITIVE_COLUMNS) -> DataFrame:
    """One row with the mean and population standard deviation of every column present."""
    present = [c for c in columns if c in train.columns]
    return train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in present], *[F.stddev_pop(c).alias(f"{c}_std") for c in present]
    )


def scaler_table(params: DataFrame) -> DataFrame:
    """The one-row scaler as (feature, mean, std) rows."""
    columns = [c[: -len("_mean")] for c in params.columns if c.endswith("_mean")]
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
        for c in columns
    ]
    return params.select(F.inline(F.array(*entries)))


def one_row(params: DataFrame) -> Column:
    """A one-row table as a scalar struct, evaluated once and shared by every task."""
    return params.agg(F.struct(*[F.max(c).alias(c) for c in params.columns])).scalar()


def apply_scaler(
    df: DataFrame, params: DataFrame, columns: Sequence[str] = SCALE_SENSITIVE_COLUMNS
) -> DataFrame:
    """Replace columns by their standard scores; a constant column is only centred."""
    present = [c for c in columns if c in df.columns]

    def standard(c: str) -> Column:
        deviation = F.col(f"scaler.{c}_std")
        return (F.col(c) - F.col(f"scaler.{c}_mean")) / F.when(deviation == 0, 1.0).otherwise(deviation)

    return df.withColumn("scaler", one_row(params)).withColumns({c: standard(c) for c in present}).drop("scaler")


def class_weights(df: DataFrame, target: str = "churned") -> DataFrame:
    """Balanced weight per class, and the negative-to-positive ratio used as positive-class weight."""
    counts = df.agg(
        F.count_if(F.col(target) == 0).alias("negatives"), F.count_if(F.col(target) == 1).alias("positives")
    )
    whole = F.col("negatives") + F.col("positives")
    entries = [
        F.struct(
            F.lit(label).alias(target),
            F.col(name).alias("n_rows"),
            F.when(F.col(name) > 0, whole / (2 * F.col(name))).alias("balanced_weight"),
            (F.col("negatives") / F.greatest("positives", F.lit(1))).alias("positive_weight"),
        )
        for label, name in ((0, "negatives"), (1, "positives"))
    ]
    return counts.select(F.inline(F.array(*entries)))
