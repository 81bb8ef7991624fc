"""Transactions derived from a star schema of order lines, orders, customers, nations and parts.

Order lines carry none of the flaws that cleaning handles, so fixed arithmetic rules on the keys plant
returns, zero and sub-cent prices, missing invoices and customers, administrative codes, untidy descriptions and exact copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUSTOMER_ID_OFFSET = 12000
SHEET_SPLIT = "1999-01-01"

IS_RETURN = "(l_returnflag = 'R' AND l_orderkey % 5 = 0)"

# Shared attribute rules, by output column, over order lines joined to orders.
LINE_RULES = {
    "invoice": f"CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN {IS_RETURN} THEN concat('C', CAST(l_orderkey AS STRING)) "
               "ELSE CAST(l_orderkey AS STRING) END",
    "stock_code": "CASE WHEN l_linenumber = 7 AND l_partkey % 9 = 0 THEN 'POST' "
                  "WHEN l_linenumber = 7 AND l_partkey % 9 = 1 THEN 'bank charges' "
                  "ELSE concat('P', CAST(l_partkey % 50 AS STRING)) END",
    "quantity": f"CASE WHEN {IS_RETURN} THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END",
    "invoice_date": "o_orderdate + make_dt_interval(0, 0, CAST(l_orderkey % 1440 AS INT), 0)",
    "price": "CAST(CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN 0 "
             "WHEN (l_orderkey + l_linenumber) % 103 = 0 THEN 0.001BD "
             "ELSE (CAST(round(l_extendedprice * 100) AS BIGINT) div CAST(l_quantity AS BIGINT)) * 0.01BD "
             "+ CASE WHEN l_orderkey % 107 = 0 THEN 0.005BD ELSE 0BD END END AS DECIMAL(18, 6))",
    "customer_id": f"CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE o_custkey + {CUSTOMER_ID_OFFSET} END",
}

DESCRIPTION_RULE = (
    "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
    "WHEN l_orderkey % 10 = 1 THEN concat('  ', upper(p_name), '  ') "
    "WHEN l_orderkey % 10 = 2 THEN replace(p_name, ' ', '   ') ELSE p_name END"
)

ALL_COLUMNS = ("invoice", "stock_code", "description", "quantity", "invoice_date", "price",
               "customer_id", "country", "source_sheet")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(
    spark: SparkSession,
    folder: str,
    columns: tuple[str, ...] = ALL_COLUMNS,
    days_from: str | None = None,
    days_to: str | None = None,
) -> DataFrame:
    """Transaction lines with the requested columns.

    Dimension tables are joined only for the columns that need them. ``days_from`` / ``days_to`` are
    inclusive bounds on the order day; they reach the Parquet scan, which a bound on the computed
    ``invoice_date`` cannot, and must contain every row the caller's exact filter keeps.
    """
    lines = read_table(spark, folder, "lineitem")
    copies = "explode(CASE WHEN (l_orderkey + l_partkey) % 200 = 0 THEN array(0, 1) ELSE array(0) END)"
    lines = lines.select("*", F.expr(copies).alias("copy")).drop("copy")
    orders = read_table(spark, folder, "orders")
    if days_from is not None:
        orders = orders.where(F.expr(f"o_orderdate >= TIMESTAMP_NTZ'{days_from}'"))
    if days_to is not None:
        orders = orders.where(F.expr(f"o_orderdate <= TIMESTAMP_NTZ'{days_to}'"))
    rules = {c: F.expr(rule) for c, rule in LINE_RULES.items() if c in columns}
    if "country" in columns:
        # attach homes to orders, not to the far more numerous lines
        nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
        customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        rules["country"] = F.col("n_name")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "description" in columns:
        parts = read_table(spark, folder, "part").select("p_partkey", "p_name")
        joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        rules["description"] = F.expr(DESCRIPTION_RULE)
    if "source_sheet" in columns:
        rules["source_sheet"] = F.expr(
            f"CASE WHEN {LINE_RULES['invoice_date']} < TIMESTAMP_NTZ'{SHEET_SPLIT}' THEN 'A' ELSE 'B' END"
        )
    return joined.select(*[rules[c].alias(c) for c in columns])


def invoice_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice timestamps of orders that have lines: enough to find the last one without line detail."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey")
    orders = read_table(spark, folder, "orders")
    rule = LINE_RULES["invoice_date"].replace("l_orderkey", "o_orderkey")
    return orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(
        F.expr(rule).alias("invoice_date")
    )
