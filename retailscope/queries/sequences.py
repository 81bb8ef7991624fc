"""Purchase-sequence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailscope.operators import sequences
from retailscope.operators.prep import stratified_split
from retailscope.queries.inputs import feature_table, history_input, rounded, written_once
from retailscope.queries.sqltext import piece, statement


def steps(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        history, moment = history_input(spark, folder)
        return sequences.purchase_sequences(history, moment)

    return written_once("purchase-steps", spark, folder, build)


def purchase_sequences(spark: SparkSession, folder: str) -> DataFrame:
    history, moment = history_input(spark, folder)
    return rounded(sequences.purchase_sequences(history, moment))


def padded_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sequences.flat_steps(sequences.padded_sequences(steps(spark, folder))))


def timing_baseline(spark: SparkSession, folder: str) -> DataFrame:
    splits = stratified_split(feature_table(spark, folder)).select("customer_id", "split")
    return rounded(sequences.timing_baseline(sequences.sequence_targets(steps(spark, folder)), splits))


QUERIES = {
    "purchase_sequences": purchase_sequences,
    "padded_sequences": padded_sequences,
    "timing_baseline": timing_baseline,
}

piece("top_all", ("history",), """
    SELECT stock_code, CAST(row_number() OVER (ORDER BY sum(quantity * price) DESC, stock_code) - 1 AS DOUBLE) AS category
    FROM history GROUP BY stock_code QUALIFY category < 10""")
piece("orders_by_customer", ("history", "top_all"), """
    SELECT customer_id, invoice, min(invoice_date) AS ts, CAST(sum(quantity * price) AS DOUBLE) AS amount,
           arg_min(coalesce(category, 10), struct_pack(d := invoice_date, s := stock_code)) AS category_code
    FROM history LEFT JOIN top_all USING (stock_code) WHERE invoice IS NOT NULL GROUP BY customer_id, invoice""")
piece("stepped", ("orders_by_customer",), """
    SELECT *, row_number() OVER w AS step, CAST(coalesce(date_sub('day', lag(ts) OVER w, ts), 0) AS DOUBLE) AS gap_days,
           count(*) OVER (PARTITION BY customer_id) AS n_orders
    FROM orders_by_customer WINDOW w AS (PARTITION BY customer_id ORDER BY ts, invoice)""")
piece("steps", ("stepped",), """
    SELECT customer_id, step, amount, gap_days, category_code, target
    FROM stepped JOIN (SELECT customer_id, gap_days AS target FROM stepped WHERE step = n_orders) USING (customer_id)
    WHERE n_orders >= 2 AND target > 0 AND step < n_orders""")

SQL = {
    "purchase_sequences": statement(("steps",), """
        SELECT customer_id, step, round(amount, 6) + 0.0::DOUBLE AS amount, gap_days, category_code, target FROM steps"""),
    "padded_sequences": statement(("steps",), """
        SELECT c.customer_id, CAST(n AS INTEGER) AS length, target, CAST(p AS INTEGER) AS position,
               round(coalesce(amount, 0), 6) + 0.0::DOUBLE AS amount, coalesce(gap_days, 0) AS gap_days,
               coalesce(category_code, 0) AS category_code
        FROM (SELECT customer_id, count(*) AS n, any_value(target) AS target FROM steps GROUP BY customer_id) AS c
        CROSS JOIN (SELECT unnest(range(max(step))) AS p FROM steps) AS g
        LEFT JOIN (SELECT customer_id, step, amount, gap_days, category_code FROM steps) AS s
             ON s.customer_id = c.customer_id AND s.step = p + 1"""),
    "timing_baseline": statement(("steps", "splits"), """
        SELECT * FROM (
        WITH targets AS (SELECT customer_id, target, split FROM steps JOIN splits USING (customer_id) WHERE step = 1),
             m AS (SELECT quantile_cont(target, 0.5) AS median_gap FROM targets WHERE split = 'train')
        SELECT count(*) AS n_rows, round(avg(abs(median_gap - target)), 6) AS mae,
               round(sqrt(avg((median_gap - target) * (median_gap - target))), 6) AS rmse,
               round(1 - avg((median_gap - target) * (median_gap - target)) / var_pop(target), 6) AS r2,
               round(any_value(median_gap), 6) AS median_gap
        FROM targets, m WHERE split = 'val')"""),
}
