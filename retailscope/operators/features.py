"""Point-in-time customer features, one operator per feature.

Every operator takes the cleaned lines and a cutoff, and returns ``customer_id`` plus its columns. Only
lines strictly before the cutoff count. Each one first reduces lines to invoices, days, periods or months
in a map-side aggregate, so that a customer holding a third of all lines reaches a single task as a number
of rows bounded by the length of the history.

``plans.feature_table`` computes all of them in one chain; these stand alone and serve as its check.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailscope.functions.ranks import exact_quantiles, percent_ranks
from retailscope.functions.timeparts import timestamp, whole_days
from retailscope.sources.shared import materialize

PERIOD_DAYS = 30
MARKDOWN_QUANTILE = 0.1


def cutoff_date(dates: DataFrame, window_days: int = 90) -> DataFrame:
    """One row: the last invoice timestamp minus the churn window."""
    last = F.max("invoice_date") - F.expr(f"INTERVAL '{window_days}' DAY")
    return dates.agg(last.alias("cutoff_date"))


def history_rows(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Lines of known customers and real products strictly before the cutoff."""
    return lines.where(
        (F.col("invoice_date") < timestamp(cutoff))
        & ~F.col("is_missing_customer_id")
        & ~F.col("is_non_product")
    )


def line_total() -> Column:
    """Exact decimal amount of a line that carries a usable price; null otherwise."""
    return F.when(~F.col("is_invalid_price"), F.col("quantity") * F.col("price"))


def line_amount() -> Column:
    """The exact amount of a validly priced line, in a decimal that holds any sum; null otherwise."""
    return F.when(~F.col("is_invalid_price"), F.col("quantity") * F.col("price")).cast("decimal(38,6)")


def period_of(cutoff: datetime) -> Column:
    return F.floor(whole_days(timestamp(cutoff), F.col("invoice_date")) / PERIOD_DAYS).cast("bigint")


def currency(amount: Column) -> Column:
    return F.coalesce(amount.cast("double"), F.lit(0.0))


def compute_rfm(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Recency and frequency over all history lines, money over validly priced ones."""
    invoices = (
        history_rows(lines, cutoff)
        .groupBy("customer_id", "invoice")
        .agg(
            F.max("invoice_date").alias("last_ts"),
            F.sum(line_amount()).alias("spend"),
            F.count(line_amount()).alias("n_amounts"),
        )
    )
    return invoices.groupBy("customer_id").agg(
        whole_days(timestamp(cutoff), F.max("last_ts")).alias("recency_days"),
        F.count("invoice").alias("frequency"),
        currency(F.sum("spend")).alias("monetary_total"),
        mean_amount(F.sum("spend"), F.sum("n_amounts")).alias("monetary_avg"),
    )


def mean_amount(amount: Column, count: Column) -> Column:
    return F.coalesce(F.when(count > 0, currency(amount) / count), F.lit(0.0))


def compute_historical_clv(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Realised spend; customers without a validly priced line are absent."""
    return (
        history_rows(lines, cutoff)
        .where(~F.col("is_invalid_price"))
        .groupBy("customer_id")
        .agg(currency(F.sum(line_amount())).alias("historical_clv"))
    )


def compute_basket_size(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Mean number of lines per invoice; lines without an invoice belong to none."""
    named = history_rows(lines, cutoff).where(F.col("invoice").isNotNull())
    invoices = named.groupBy("customer_id", "invoice").agg(F.count(F.lit(1)).alias("n_lines"))
    return invoices.groupBy("customer_id").agg(F.avg("n_lines").alias("avg_basket_size"))


def compute_purchase_trend(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Least-squares slope of orders per 30-day period over the periods that have orders."""
    orders = (
        history_rows(lines, cutoff)
        .select("customer_id", "invoice", period_of(cutoff).alias("period"))
        .distinct()
        .groupBy("customer_id", "period")
        .agg(F.count("invoice").alias("orders"))
    )
    return orders.groupBy("customer_id").agg(
        slope(F.col("orders"), -F.col("period")).alias("purchase_trend_slope")
    )


def slope(y: Column, x: Column) -> Column:
    """Least-squares slope of integer columns, from exact integer sums; zero without spread in ``x``."""
    n, sum_x, sum_y = F.count(x), F.sum(x), F.sum(y)
    rise = n * F.sum(x * y) - sum_x * sum_y
    run = n * F.sum(x * x) - sum_x * sum_x
    return F.coalesce(F.when(run != 0, rise / run), F.lit(0.0))


def sample_variance(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance from integer sums; zero below two values."""
    spread = squares.cast("double") - total.cast("double") * total.cast("double") / n
    return F.coalesce(F.when(n > 1, spread / (n - 1)), F.lit(0.0))


def compute_purchase_interval_variance(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Sample variance of the whole-day gaps between consecutive invoices.

    Invoices of one calendar day are less than 24 hours apart, so their gaps are zero and only need
    counting; the window runs over a customer's days, not over its invoices.
    """
    starts = (
        history_rows(lines, cutoff)
        .where(F.col("invoice").isNotNull())
        .groupBy("customer_id", "invoice")
        .agg(F.min("invoice_date").alias("start"))
    )
    days = starts.groupBy("customer_id", F.to_date("start").alias("day")).agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.min("start").alias("first_start"),
        F.max("start").alias("last_start"),
    )
    previous = F.lag("last_start").over(Window.partitionBy("customer_id").orderBy("day"))
    gaps = days.withColumn("gap", whole_days(F.col("first_start"), previous))
    return gaps.groupBy("customer_id").agg(
        sample_variance(
            F.sum("n_invoices") - 1, F.sum("gap"), F.sum(F.col("gap") * F.col("gap"))
        ).alias("purchase_interval_variance")
    )


def compute_seasonal_concentration(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Sum of squared calendar-month shares of spend; zero when net spend is exactly zero."""
    months = (
        history_rows(lines, cutoff)
        .where(~F.col("is_invalid_price"))
        .groupBy("customer_id", F.month("invoice_date").alias("month"))
        .agg(F.sum(line_amount()).alias("spend"))
    )
    return months.groupBy("customer_id").agg(
        concentration(F.sum(F.pow(F.col("spend").cast("double"), 2)), F.sum("spend")).alias("seasonal_concentration")
    )


def concentration(squares: Column, total: Column) -> Column:
    share = squares / F.pow(total.cast("double"), 2)
    return F.coalesce(F.when(total != 0, share), F.lit(0.0))


def top_products(lines: DataFrame, cutoff: datetime, top_n: int = 10, with_invalid_prices: bool = False) -> DataFrame:
    """The ``top_n`` stock codes by spend with their rank; equal spend keeps the smaller code."""
    amount = F.col("quantity") * F.col("price") if with_invalid_prices else line_total()
    rows = history_rows(lines, cutoff)
    if not with_invalid_prices:
        rows = rows.where(~F.col("is_invalid_price"))
    spend = (
        rows.where(F.col("stock_code").isNotNull())
        .groupBy("stock_code")
        .agg(F.coalesce(F.sum(amount), F.lit(0)).alias("spend"))
    )
    best = spend.orderBy(F.desc("spend"), "stock_code").limit(top_n)
    order = Window.orderBy(F.desc("spend"), "stock_code")  # over top_n rows
    return best.select(F.row_number().over(order).alias("rank"), "stock_code", "spend")


def affinity_long(lines: DataFrame, cutoff: datetime, top_n: int = 10) -> DataFrame:
    """Share of a customer's spend on each top product, among the top products only."""
    top = top_products(lines, cutoff, top_n).select("rank", "stock_code")
    bought = (
        history_rows(lines, cutoff)
        .where(~F.col("is_invalid_price"))
        .select("customer_id", "stock_code", line_total().alias("amount"))
        .join(F.broadcast(top), "stock_code")  # top_n rows
        .groupBy("customer_id", "rank", "stock_code")
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("spend"))
    )
    whole = F.sum("spend").over(Window.partitionBy("customer_id"))  # at most top_n rows per customer
    share = F.when(whole != 0, F.col("spend").cast("double") / whole.cast("double")).otherwise(0.0)
    return bought.select("customer_id", "rank", "stock_code", share.alias("share"))


def affinity_pivot(lines: DataFrame, cutoff: datetime, top_n: int = 10) -> DataFrame:
    """Affinity as one fixed column per product rank: ``affinity_1`` is the best seller."""
    shares = affinity_long(lines, cutoff, top_n)
    return shares.groupBy("customer_id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("rank") == r, F.col("share"))), F.lit(0.0)).alias(f"affinity_{r}")
            for r in range(1, top_n + 1)
        ]
    )


def compute_return_rate(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Share of history lines that are returns."""
    return history_rows(lines, cutoff).groupBy("customer_id").agg(
        F.coalesce(F.avg(F.col("is_return").cast("double")), F.lit(0.0)).alias("return_rate")
    )


def markdown_thresholds(history: DataFrame) -> DataFrame:
    """Bottom-decile price per stock code, over validly priced lines."""
    priced = history.where(~F.col("is_invalid_price") & F.col("stock_code").isNotNull())
    return exact_quantiles(priced, F.col("price"), {"markdown_price": MARKDOWN_QUANTILE}, ["stock_code"])


def with_markdown_flag(history: DataFrame) -> DataFrame:
    """Mark lines priced in their product's bottom decile; null where the price is invalid.

    The thresholds are written first: their measured size then decides between a broadcast and a shuffled
    join, and a catalogue that fits a broadcast never costs a shuffle of the lines by product.
    """
    thresholds = materialize(markdown_thresholds(history), "markdown").withColumnRenamed("stock_code", "priced_code")
    at_markdown = F.coalesce(F.col("price").cast("double") <= F.col("markdown_price"), F.lit(False))
    return (
        history.join(thresholds, F.col("stock_code") == F.col("priced_code"), "left")
        .withColumn("is_markdown", F.when(~F.col("is_invalid_price"), at_markdown))
        .drop("priced_code", "markdown_price")
    )


def compute_discount_sensitivity(lines: DataFrame, cutoff: datetime) -> DataFrame:
    """Share of a customer's validly priced lines that are in the product's bottom price decile."""
    marked = with_markdown_flag(history_rows(lines, cutoff))
    return marked.groupBy("customer_id").agg(
        F.coalesce(F.avg(F.col("is_markdown").cast("double")), F.lit(0.0)).alias("discount_sensitivity")
    )


def engagement(recency_rank: Column, frequency_rank: Column, monetary_rank: Column) -> Column:
    return 100 * (0.4 * (1 - recency_rank) + 0.3 * frequency_rank + 0.3 * monetary_rank)


def compute_engagement_score(rfm: DataFrame) -> DataFrame:
    """Composite 0-100 score from percent ranks; recent customers score high."""
    ranks = percent_ranks(rfm, "customer_id", ["recency_days", "frequency", "monetary_total"])
    return ranks.select(
        "customer_id",
        engagement(
            F.col("recency_days_rank"), F.col("frequency_rank"), F.col("monetary_total_rank")
        ).alias("engagement_score"),
    )


def future_customers(lines: DataFrame, cutoff: datetime, window_days: int = 90) -> DataFrame:
    """Customers with any line in ``(cutoff, cutoff + window]``, whatever its product, sign or price."""
    start = timestamp(cutoff)
    end = start + F.expr(f"INTERVAL '{window_days}' DAY")
    return (
        lines.where((F.col("invoice_date") > start) & (F.col("invoice_date") <= end) & F.col("customer_id").isNotNull())
        .select("customer_id")
        .distinct()
    )


def label_churn(customers: DataFrame, returning: DataFrame) -> DataFrame:
    """Add ``churned``: 1 unless the customer is among the returning ones."""
    back = returning.select(F.col("customer_id").alias("returning_id"))
    return (
        customers.join(back, F.col("customer_id") == F.col("returning_id"), "left")
        .withColumn("churned", F.col("returning_id").isNull().cast("int"))
        .drop("returning_id")
    )


def compute_churn_label(lines: DataFrame, cutoff: datetime, window_days: int = 90) -> DataFrame:
    customers = history_rows(lines, cutoff).select("customer_id").distinct()
    return label_churn(customers, future_customers(lines, cutoff, window_days))


def class_balance(features: DataFrame) -> DataFrame:
    """Rows and share per class; training needs both classes."""
    counts = features.groupBy("churned").agg(F.count(F.lit(1)).alias("n_customers"))
    total = F.sum("n_customers").over(Window.partitionBy())  # one row per class
    return counts.select("churned", "n_customers", (F.col("n_customers") / total).alias("share"))


def require_both_classes(balance: DataFrame) -> None:
    if balance.count() < 2:
        raise ValueError("only one churn class is present; check the churn window and the data volume")
