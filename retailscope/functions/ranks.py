"""Exact ranks and quantiles without a global sort.

Everything rests on one table: a histogram of distinct values with the number of rows below each value.
Ties collapse in the map-side aggregate, so a value that holds a third of all rows is one histogram row.
Distinct values are cut into buckets at approximate quantiles; the running count inside a bucket needs
only that bucket's rows, and the counts before a bucket come from at most ``N_BUCKETS`` totals per key.
The cut points only balance the work; the result does not depend on where they fall.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailscope.functions.hotkeys import join_groups
from retailscope.sources.shared import materialize

BUCKET_STEPS = (64, 32, 16, 8, 4, 2, 1)
N_BUCKETS = 2 * BUCKET_STEPS[0]
CUT_ACCURACY = 1000  # ten times finer than a bucket is wide


def cumulative_histogram(
    df: DataFrame,
    value: Column,
    keys: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    bucket: Column | None = None,
    only: Sequence[Column] = (),
) -> DataFrame:
    """One row per distinct ``(keys, value)``: ``n`` rows, ``below`` = rows with a smaller value, ``total``.

    Rows whose value is null count nowhere. ``counts`` adds named sums per value. ``bucket`` replaces
    the quantile cut points by an expression over ``value`` that never decreases with it. ``only`` are
    row positions (from 0, over ``total``): buckets that hold none of them are dropped before ranking.
    """
    keys = list(keys)
    counts = dict(counts or {})
    cells = df.select(*keys, value.alias("value"), *[c.alias(name) for name, c in counts.items()])
    histogram = cells.groupBy(*keys, "value").agg(
        F.count("value").alias("n"), *[F.sum(name).alias(name) for name in counts]
    )
    if bucket is None:
        probabilities = [i / N_BUCKETS for i in range(1, N_BUCKETS)]
        # every histogram column takes part, so this branch and the main one share one shuffle
        shape = histogram.agg(
            F.struct(
                F.percentile_approx("value", probabilities, CUT_ACCURACY).alias("points"),
                F.sum("n"), *[F.sum(name) for name in counts], *[F.max(k) for k in keys],
            ).alias("shape")
        ).scalar()
        placed = count_points_below(histogram.withColumn("shape", shape)).drop("shape")
    else:
        placed = histogram.withColumn("bucket", F.coalesce(bucket.cast("int"), F.lit(0)))

    # one struct column carries the null-safe key, so ranking and the join share one partitioning
    placed = placed.withColumn("slot", F.struct(*keys, "bucket"))
    over_keys = Window.partitionBy(*[f"slot.{k}" for k in keys])
    offsets = (
        placed.groupBy("slot")
        .agg(F.sum("n").alias("bucket_n"), *[F.sum(name) for name in counts])
        .select(
            "slot", "bucket_n",
            F.coalesce(
                F.sum("bucket_n").over(over_keys.orderBy("slot.bucket").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("before"),
            F.sum("bucket_n").over(over_keys).alias("total"),
        )
    )
    if only:
        inside_bucket = [(F.col("before") <= p) & (p < F.col("before") + F.col("bucket_n")) for p in only]
        wanted = inside_bucket[0]
        for other in inside_bucket[1:]:
            wanted = wanted | other
        offsets = offsets.where(wanted)
    offsets = offsets.drop("bucket_n")
    if not keys:
        offsets = F.broadcast(offsets)  # one row per bucket

    in_slot = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(offsets, "slot")
        .withColumn("inside", F.coalesce(F.sum("n").over(in_slot), F.lit(0)))
        .where(F.col("n") > 0)
        .select(*keys, "value", "n", *counts, (F.col("before") + F.col("inside")).alias("below"), "total")
    )


def count_points_below(df: DataFrame) -> DataFrame:
    """Add ``bucket``: how many of the sorted ``shape.points`` lie below ``value``.

    A binary search with one projection per step, which stays in generated code; a null value gets 0.
    """
    df = df.withColumn("bucket", F.lit(0))
    for step in BUCKET_STEPS:
        probe = F.element_at("shape.points", F.col("bucket") + step)
        df = df.withColumn("bucket", F.col("bucket") + F.when(probe < F.col("value"), step).otherwise(0))
    return df


def average_percent_rank() -> Column:
    """Percent rank with ties sharing their average, over a cumulative histogram."""
    return (F.col("below") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total")


def exact_quantiles(
    df: DataFrame,
    value: Column,
    probabilities: Mapping[str, float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per named probability."""
    positions = {name: F.lit(p) * (F.col("total") - 1) for name, p in probabilities.items()}
    edges_wanted = [side(position) for position in positions.values() for side in (F.floor, F.ceil)]
    ranked = cumulative_histogram(df, value.cast("double"), keys, only=edges_wanted)

    def at(position: Column) -> Column:
        hit = (F.col("below") <= position) & (position < F.col("below") + F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    aggregates = []
    for name, position in positions.items():
        aggregates += [
            at(F.floor(position)).alias(f"{name}_low"),
            at(F.ceil(position)).alias(f"{name}_high"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
    edges = ranked.groupBy(*keys).agg(*aggregates)
    return edges.select(
        *keys,
        *[
            (F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_part")).alias(n)
            for n in probabilities
        ],
    )


def percent_ranks(df: DataFrame, row_id: str, metrics: Sequence[str]) -> DataFrame:
    """``row_id`` with the average-tie percent rank of every metric, in one pass over all metrics."""
    melted = df.select(
        row_id,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ).alias("cell"),
    ).select(row_id, "cell.metric", "cell.value")
    ranked = cumulative_histogram(melted, F.col("value"), ["metric"]).select(
        "metric", "value", average_percent_rank().alias("percent_rank"), "n", "total"
    )
    # a third of all rows may share a value, such as one order
    placed = join_groups(melted, materialize(ranked, "percent-ranks"), ["metric", "value"], "n", F.col("total"))
    return (
        placed.groupBy(row_id)
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("percent_rank"))).alias(f"{m}_rank") for m in metrics])
    )
