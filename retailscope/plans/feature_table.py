"""The customer feature table as one chain of aggregates over the deduplicated history.

lines ──► (customer, invoice, period, month) ──► invoices, invoice-periods and months
      ──► (customer, kind, day | period | month) ──► customer

Lines are partitioned by customer once and the chain runs where they are. Customers too large for a task
go through it with a shuffle of map-side aggregated rows at each step; after the third a customer owns at
most as many rows as the history has days, periods and months, so the last one is safe for a customer of
any size. A single chain also means one scan: separate aggregates would each prune different columns and re-read the lines.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailscope.config import FEATURE_COLUMNS, RunConfig
from retailscope.functions.hotkeys import HOT_GROUPS
from retailscope.functions.timeparts import timestamp, whole_days
from retailscope.operators.features import (
    currency,
    compute_engagement_score,
    concentration,
    future_customers,
    history_rows,
    label_churn,
    line_amount,
    mean_amount,
    period_of,
    sample_variance,
    slope,
    with_markdown_flag,
)
from retailscope.sources.shared import materialize

# Line measures that add up at every level.
SUMS = ("n_lines", "n_flagged", "n_returns", "n_amounts", "n_priced", "n_markdowns", "spend")

# What a row of the chain stands for; the numbers only order the kinds.
BY_INVOICE, BY_PERIOD, BY_MONTH = 3, 1, 6
NO_INVOICE = 15  # the lines of a customer that belong to no invoice: money, but no order

# What the chain reads of a line.
READ = ("customer_id", "invoice", "invoice_date", "quantity", "price", "is_return", "is_invalid_price", "is_markdown")
HOT_LINES = 100_000  # a customer of fewer lines is no burden to one task


def customer_rollup(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """All features but the engagement score, which ranks customers against each other.

    Reads ``lines`` twice, for the price thresholds and for the chain: pass a written table. Safe for a
    customer that holds any share of the lines.
    """
    return rollup_chain(with_markdown_flag(history_rows(lines, cutoff)), cutoff)


def rollup_by_size(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """``customer_rollup`` with one shuffle for all customers but the few that hold a large share of the lines.

    Lines meet by customer, so no later step of the chain moves them again. Customers of more than
    ``HOT_LINES`` lines and a thousandth of all, fewer than ``HOT_GROUPS`` by arithmetic, are left to the
    chain that spreads them. Their approximate counts only balance the work.
    """
    history = history_rows(lines, cutoff)
    heavy = F.expr(f"approx_top_k(customer_id, {HOT_GROUPS}, {10 * HOT_GROUPS})")
    total, counts = history.agg(F.count(F.lit(1)), heavy).first()
    least = max(HOT_LINES, total // HOT_GROUPS)
    hot = [c["item"] for c in counts or () if c["count"] > least]
    marked = with_markdown_flag(history).select(*READ)
    if not hot:
        return rollup_chain(marked.repartition("customer_id"), cutoff)
    spread = F.col("customer_id").isin(hot)
    return rollup_chain(marked.where(~spread).repartition("customer_id"), cutoff).unionByName(
        rollup_chain(marked.where(spread), cutoff)
    )


def rollup_chain(history: DataFrame, cutoff: datetime) -> DataFrame:
    """The chain over marked lines; rows that come partitioned by customer are not shuffled."""
    detail = (
        history.withColumn("period", period_of(cutoff))
        .withColumn("month", F.month("invoice_date"))
        .groupBy("customer_id", "invoice", "period", "month")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count("is_return").alias("n_flagged"),
            F.count_if("is_return").alias("n_returns"),
            F.count(line_amount()).alias("n_amounts"),
            F.count("is_markdown").alias("n_priced"),
            F.count_if("is_markdown").alias("n_markdowns"),
            F.sum(line_amount()).alias("spend"),
            F.min("invoice_date").alias("first_ts"),
            F.max("invoice_date").alias("last_ts"),
        )
    )

    def at(level: int, **kept: Column) -> Column:
        columns = {"invoice": F.lit(None).cast("string"), "period": F.lit(None).cast("bigint"), "month": F.lit(None).cast("int")}
        return F.struct(F.lit(level).alias("level"), *[c.alias(name) for name, c in (columns | kept).items()])

    invoice = F.col("invoice")
    sets = [
        at(BY_INVOICE, invoice=invoice), at(BY_PERIOD, invoice=invoice, period=F.col("period")),
        at(BY_MONTH, month=F.col("month")),
    ]
    # exploding keeps the partitioning by customer, which grouping sets forget
    keys = ("level", "invoice", "period", "month")
    levels = (
        detail.select("customer_id", *SUMS, "first_ts", "last_ts", F.explode(F.array(*sets)).alias("at"))
        .groupBy("customer_id", *[F.col(f"at.{k}").alias(k) for k in keys])
        .agg(*[F.sum(c).alias(c) for c in SUMS], F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    )
    orderless = (F.col("level") == BY_INVOICE) & F.col("invoice").isNull()
    levels = levels.withColumn("level", F.when(orderless, NO_INVOICE).otherwise(F.col("level")))
    slot = (
        F.when(F.col("level") == NO_INVOICE, 0)
        .when(F.col("level") == BY_INVOICE, F.unix_date(F.to_date("first_ts")))
        .when(F.col("level") == BY_PERIOD, F.col("period"))
        .otherwise(F.col("month"))
    )
    slots = levels.groupBy("customer_id", "level", slot.alias("slot")).agg(
        F.count("invoice").alias("n_groups"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.min("first_ts").alias("first_start"),
        F.max("first_ts").alias("last_start"),
        F.max("last_ts").alias("last_ts"),
    )
    in_order = Window.partitionBy("customer_id").orderBy("level", "slot")
    same_level = F.lag("level").over(in_order) == F.col("level")
    gap = whole_days(F.col("first_start"), F.lag("last_start").over(in_order))
    spaced = slots.withColumn("gap", F.when(same_level & (F.col("level") == BY_INVOICE), gap))

    def on(level: int, value: Column) -> Column:
        return F.when(F.col("level") == level, value)

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("level").isin(BY_INVOICE, NO_INVOICE), F.col(name)))

    def invoiced(name: str) -> Column:
        return F.coalesce(F.sum(on(BY_INVOICE, F.col(name))), F.lit(0))

    month_squares = F.sum(on(BY_MONTH, F.pow(F.col("spend").cast("double"), 2)))
    return spaced.groupBy("customer_id").agg(
        whole_days(timestamp(cutoff), F.max("last_ts")).alias("recency_days"),
        invoiced("n_groups").alias("frequency"),
        currency(total("spend")).alias("monetary_total"),
        mean_amount(total("spend"), total("n_amounts")).alias("monetary_avg"),
        currency(total("spend")).alias("historical_clv"),
        share(invoiced("n_lines"), invoiced("n_groups")).alias("avg_basket_size"),
        slope(on(BY_PERIOD, F.col("n_groups")), on(BY_PERIOD, -F.col("slot"))).alias("purchase_trend_slope"),
        sample_variance(
            invoiced("n_groups") - 1, F.sum("gap"), F.sum(F.col("gap") * F.col("gap"))
        ).alias("purchase_interval_variance"),
        concentration(month_squares, total("spend")).alias("seasonal_concentration"),
        share(total("n_returns"), total("n_flagged")).alias("return_rate"),
        share(total("n_markdowns"), total("n_priced")).alias("discount_sensitivity"),
    )


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.when(whole > 0, part / whole), F.lit(0.0))


def customer_features(
    lines: DataFrame,
    cutoff: datetime,
    config: RunConfig = RunConfig(),
    returning: DataFrame | None = None,
    include_label: bool = True,
) -> DataFrame:
    """One row per customer with history: the twelve features and, unless told otherwise, ``churned``.

    The rollup is written to the shared folder once, because ranking reads it again: pruned re-reads of
    a lazy rollup would repeat the whole chain. ``returning`` may supply the future customers from a
    narrower scan than ``lines``.
    """
    rollup = materialize(rollup_by_size(lines, cutoff), "rollup")
    scored = rollup.join(compute_engagement_score(rollup), "customer_id")
    table = scored.select("customer_id", *FEATURE_COLUMNS)
    if not include_label:
        return table
    if returning is None:
        returning = future_customers(lines, cutoff, config.churn_window_days)
    return label_churn(table, returning)
