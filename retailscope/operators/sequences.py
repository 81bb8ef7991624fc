"""Purchase sequences: ordered orders per customer with amount, gap and product category.

Order positions and gaps are built from (customer, minute) and (customer, day) counts, so a customer with
any number of orders is never sorted in one task. Invoices of one calendar day are less than 24 hours
apart and have a zero whole-day gap; only the first of a day looks back to the day before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailscope.functions.ranks import exact_quantiles
from retailscope.functions.timeparts import whole_days
from retailscope.operators.features import history_rows, top_products
from retailscope.operators.metrics import regression_metrics
from retailscope.operators.prep import one_row
from retailscope.sources.shared import materialize

STEP_FIELDS = ("amount", "gap_days", "category_code")


def customer_orders(lines: DataFrame, cutoff: datetime, max_products: int = 10) -> DataFrame:
    """(customer_id, invoice, ts, amount, category_code): one row per invoice of the history.

    Invalid prices count here. The category is the best-seller rank (from 0) of the order's first line,
    ``max_products`` for anything else.
    """
    top = top_products(lines, cutoff, max_products, with_invalid_prices=True).select(
        F.col("stock_code").alias("top_code"), (F.col("rank") - 1).cast("double").alias("category")
    )
    coded = (
        history_rows(lines, cutoff)
        .where(F.col("invoice").isNotNull())
        .join(F.broadcast(top), F.col("stock_code") == F.col("top_code"), "left")  # max_products rows
        .withColumn("category", F.coalesce("category", F.lit(float(max_products))))
    )
    first_line = F.min(F.struct("invoice_date", "stock_code", "category"))
    return coded.groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("ts"),
        F.coalesce(F.sum(F.col("quantity") * F.col("price")).cast("double"), F.lit(0.0)).alias("amount"),
        first_line.getField("category").alias("category_code"),
    )


def ordered_orders(orders: DataFrame) -> DataFrame:
    """Add ``step`` (from 1), ``gap_days`` and the customer's ``n_orders`` and ``last_gap``.

    Orders of a customer rank by timestamp, then invoice.
    """
    timed = orders.withColumn("day", F.to_date("ts")).withColumn("minute", F.date_trunc("minute", "ts"))
    minutes = timed.groupBy("customer_id", "day", "minute").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    days = minutes.groupBy("customer_id", "day").agg(
        F.sum("n").alias("day_n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    by_day = Window.partitionBy("customer_id").orderBy("day")
    before_day = by_day.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("customer_id")
    day_gap = whole_days(F.col("first_ts"), F.lag("last_ts").over(by_day))
    dated = days.select(
        "customer_id", "day", "day_n",
        F.coalesce(F.sum("day_n").over(before_day), F.lit(0)).alias("earlier_days"),
        F.coalesce(day_gap, F.lit(0)).cast("double").alias("day_gap"),
        F.sum("day_n").over(whole).alias("n_orders"),
        F.max("day").over(whole).alias("last_day"),
    )
    last_gap = F.max(
        F.when(F.col("day") == F.col("last_day"), F.when(F.col("day_n") == 1, F.col("day_gap")).otherwise(0.0))
    ).over(whole)
    dated = dated.withColumn("last_gap", last_gap).drop("last_day", "day_n")
    before_minute = Window.partitionBy("customer_id", "day").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    placed = minutes.select(
        "customer_id", "day", "minute",
        F.coalesce(F.sum("n").over(before_minute), F.lit(0)).alias("earlier_minutes"),
    ).join(dated, ["customer_id", "day"])
    inside = F.row_number().over(Window.partitionBy("customer_id", "day", "minute").orderBy("ts", "invoice"))
    in_day = F.col("earlier_minutes") + F.col("inside")
    return (
        timed.withColumn("inside", inside)
        .join(placed, ["customer_id", "day", "minute"])
        .select(
            "customer_id", "invoice", "ts", "amount", "category_code",
            (F.col("earlier_days") + in_day).alias("step"),
            F.when(in_day == 1, F.col("day_gap")).otherwise(0.0).alias("gap_days"),
            "n_orders", "last_gap",
        )
    )


def purchase_sequences(lines: DataFrame, cutoff: datetime, max_products: int = 10) -> DataFrame:
    """One row per step: all but the last order of customers whose last gap is positive; ``target`` is that gap.

    Orders are written first: they are read for their days and for their steps, and lines then move once.
    """
    ordered = ordered_orders(materialize(customer_orders(lines, cutoff, max_products), "orders"))
    return ordered.where(
        (F.col("n_orders") >= 2) & (F.col("last_gap") > 0) & (F.col("step") < F.col("n_orders"))
    ).select("customer_id", "step", *STEP_FIELDS, F.col("last_gap").alias("target"))


def longest(steps: DataFrame) -> int:
    return steps.agg(F.max("step")).first()[0] or 0


def padded_sequences(steps: DataFrame, max_len: int | None = None) -> DataFrame:
    """Steps per customer as an array padded with zero steps to one length, and the real length.

    The length is that of the longest sequence, or ``max_len``: steps beyond it are then cut before they
    are gathered, which bounds the arrays where one customer has far more orders than others.
    """
    max_len = longest(steps) if max_len is None else max_len
    zero = F.struct(*[F.lit(0.0).alias(f) for f in STEP_FIELDS])
    gathered = (
        steps.where(F.col("step") <= max_len)
        .groupBy("customer_id")
        .agg(F.sort_array(F.collect_list(F.struct("step", *STEP_FIELDS))).alias("taken"), F.max("target").alias("target"))
    )
    kept = F.transform("taken", lambda s: F.struct(*[s[f].alias(f) for f in STEP_FIELDS]))
    padding = F.array_repeat(zero, F.lit(max_len) - F.size("taken"))
    return gathered.select(
        "customer_id", F.concat(kept, padding).alias("steps"), F.size("taken").alias("length"), "target"
    )


def timing_features(steps: DataFrame) -> DataFrame:
    """Fixed-width summary of each sequence for a next-gap regression.

    The last step's values, and means over all steps; customers reduce map-side.
    """
    latest = F.max(F.struct("step", *STEP_FIELDS))
    return steps.groupBy("customer_id").agg(
        latest.getField("amount").alias("last_amount"),
        latest.getField("gap_days").alias("last_gap_days"),
        latest.getField("category_code").alias("last_category"),
        F.avg("amount").alias("mean_amount"),
        F.avg("gap_days").alias("mean_gap_days"),
        F.max("gap_days").alias("max_gap_days"),
        F.max("step").cast("double").alias("n_steps"),
        F.max("target").alias("target"),
    )


def timing_baseline(targets: DataFrame, splits: DataFrame) -> DataFrame:
    """Error, in days, of always predicting the training median on the validation customers."""
    tagged = targets.join(splits, "customer_id")
    median = exact_quantiles(tagged.where(F.col("split") == "train"), F.col("target"), {"median_gap": 0.5})
    judged = tagged.where(F.col("split") == "val").withColumn("naive", one_row(median).getField("median_gap"))
    errors = regression_metrics(judged, "target", "naive")
    return errors.withColumn("median_gap", one_row(median).getField("median_gap"))


def days_from_log(prediction: Column) -> Column:
    """Back from log1p space, never below zero days."""
    return F.greatest(F.expm1(prediction), F.lit(0.0))


def sequence_targets(steps: DataFrame) -> DataFrame:
    return steps.where(F.col("step") == 1).select("customer_id", "target")


def flat_steps(padded: DataFrame, fields: Sequence[str] = STEP_FIELDS) -> DataFrame:
    """One row per array position, for sinks without array columns."""
    return padded.select("customer_id", "length", "target", F.posexplode("steps").alias("position", "s")).select(
        "customer_id", "length", "target", "position", *[f"s.{f}" for f in fields]
    )
