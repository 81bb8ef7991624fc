"""Loading, validation and cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.operators import clean, validate
from retailscope.queries.inputs import CONFIG, raw, rounded
from retailscope.queries.sqltext import piece, statement
from retailscope.sources import star_schema
from retailscope.sources.transactions import coerce_types as coerce
from retailscope.sources.transactions import uncoerced, union_sheets

HEADINGS = {
    "invoice": "Invoice", "stock_code": "StockCode", "description": "Description", "quantity": "Quantity",
    "invoice_date": "InvoiceDate", "price": "Price", "customer_id": "Customer ID", "country": "Country",
}

# Expressions both engines read alike; plain text wins over the planted values.
SHEET_TEXT = {
    "invoice": "CAST(l_orderkey AS {text})",
    "stock_code": "concat('P', CAST(l_partkey % 50 AS {text}))",
    "description": "concat('part ', CAST(l_partkey AS {text}))",
    "quantity": "CASE WHEN l_orderkey % 211 = 0 THEN 'n/a' WHEN l_orderkey % 212 = 0 THEN '3000000000' "
                "WHEN l_orderkey % 214 = 0 THEN '17.5' ELSE CAST(l_quantity AS {text}) END",
    "price": "CASE WHEN l_orderkey % 223 = 0 THEN '' WHEN l_orderkey % 224 = 0 THEN '0.001' WHEN l_orderkey % 225 = 0 THEN '1.005' "
             "WHEN l_orderkey % 226 = 0 THEN '20000000000' WHEN l_orderkey % 229 = 0 THEN '0.0000001' "
             "WHEN l_orderkey % 232 = 0 THEN '0.30000000000000004' WHEN l_orderkey % 233 = 0 THEN '1e-20' "
             "WHEN l_orderkey % 234 = 0 THEN '10000000000000' WHEN l_orderkey % 235 = 0 THEN '1234567890123.5' "
             "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS {text}) END",
    "invoice_date": "CASE WHEN l_orderkey % 227 = 0 THEN 'bad' WHEN l_orderkey % 228 = 0 THEN '12/1/2009 8:26' "
                    "ELSE CAST(l_shipdate AS {text}) END",
    "customer_id": "CASE WHEN l_orderkey % 230 = 0 THEN '17.00001' WHEN l_orderkey % 231 = 0 THEN '17.0' ELSE CAST(l_suppkey AS {text}) END",
    "country": "concat('Land ', CAST(l_linenumber AS {text}))",
}
SHEET_SQL = "SELECT " + ", ".join(f"{rule.format(text='VARCHAR')} AS {name}" for name, rule in SHEET_TEXT.items()) + " FROM lineitem"
SHEET_TEXT = {name: rule.format(text="STRING") for name, rule in SHEET_TEXT.items()}


def exact_sql(column: str, target: str) -> str:
    wide = f"TRY_CAST({column} AS DECIMAL(38, 18))"
    return f"CASE WHEN TRY_CAST({wide} AS {target}) = {wide} THEN TRY_CAST({wide} AS {target}) END"


COERCED_SQL = {
    "quantity": exact_sql("quantity", "BIGINT"), "price": "TRY_CAST(price AS DECIMAL(28, 6))",
    "invoice_date": "coalesce(TRY_CAST(invoice_date AS TIMESTAMP), try_strptime(invoice_date, '%m/%d/%Y %H:%M'))",
    "customer_id": exact_sql("customer_id", "BIGINT"),
}

# A price whose decimal is a rounded one counts as lost as well.
ROUNDED_PRICE = (f"coalesce(TRY_CAST(price AS DECIMAL(38, 18)) <> {COERCED_SQL['price']}, false) "
                 f"OR coalesce({COERCED_SQL['price']} = 0 AND TRY_CAST(price AS DOUBLE) <> 0, false)")
LOST_SQL = {name: f"({rule}) IS NULL" for name, rule in COERCED_SQL.items()}
LOST_SQL["price"] += f" OR {ROUNDED_PRICE}"


def load_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two sheets with source headings, each its own scan, stacked and tagged."""
    columns = tuple(HEADINGS)
    early = star_schema.transactions(spark, folder, columns, days_to="1998-12-31")
    late = star_schema.transactions(spark, folder, columns, days_from=star_schema.SHEET_SPLIT)
    return union_sheets({"A": early.withColumnsRenamed(HEADINGS), "B": late.withColumnsRenamed(HEADINGS)})


def sheet_text(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a sheet of text with values that do not parse, and some that barely fit."""
    return star_schema.read_table(spark, folder, "lineitem").selectExpr(*[f"{rule} AS {name}" for name, rule in SHEET_TEXT.items()])


def coerce_types(spark: SparkSession, folder: str) -> DataFrame:
    return coerce(sheet_text(spark, folder))


def uncoerced_values(spark: SparkSession, folder: str) -> DataFrame:
    lost = uncoerced(sheet_text(spark, folder), exact=True)
    return lost.select("invoice", "quantity", "price", "invoice_date", "customer_id", F.array_join("lost", ",").alias("lost"))


def null_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(validate.validate_null_rates(raw(spark, folder), CONFIG.max_null_rate))


def date_range(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate_date_range(raw(spark, folder), "invoice_date", CONFIG.date_min, "2001-07-31")


def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(validate.run_validation(raw(spark, folder), CONFIG))


def validate_schema(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate_schema(raw(spark, folder))


def clean_flags(spark: SparkSession, folder: str) -> DataFrame:
    return clean.add_row_flags(raw(spark, folder)).select(
        "invoice", "stock_code", "quantity", "price", "customer_id",
        "is_missing_customer_id", "is_return", "is_invalid_price", "is_non_product",
    )


def iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    rows = star_schema.transactions(spark, folder, ("invoice", "stock_code", "quantity", "price"))
    return clean.flag_price_quantity_outliers(rows, CONFIG.iqr_multiplier)


def iqr_fences(spark: SparkSession, folder: str) -> DataFrame:
    rows = star_schema.transactions(spark, folder, ("quantity", "price"))
    return rounded(clean.iqr_bounds(rows, CONFIG.iqr_multiplier))


def canonical_description(spark: SparkSession, folder: str) -> DataFrame:
    return clean.canonical_descriptions(star_schema.transactions(spark, folder, ("stock_code", "description")))


def standardized(spark: SparkSession, folder: str) -> DataFrame:
    rows = star_schema.transactions(spark, folder, ("invoice", "stock_code", "description"))
    return clean.standardize_descriptions(rows)


def dedup(spark: SparkSession, folder: str) -> DataFrame:
    return clean.deduplicate_transactions(raw(spark, folder))


def dedup_count(spark: SparkSession, folder: str) -> DataFrame:
    return clean.duplicate_counts(star_schema.transactions(spark, folder, CONFIG.dedup_columns))


def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_transactions(raw(spark, folder), CONFIG)


piece("fences", ("raw",), """
    SELECT quantile_cont(CAST(quantity AS DOUBLE), 0.25) AS q1q, quantile_cont(CAST(quantity AS DOUBLE), 0.75) AS q3q,
           quantile_cont(CAST(price AS DOUBLE), 0.25) AS q1p, quantile_cont(CAST(price AS DOUBLE), 0.75) AS q3p
    FROM raw""")
piece("canonical", ("raw",), """
    SELECT stock_code, text AS canonical
    FROM (SELECT stock_code, regexp_replace(upper(trim(description)), '\\s+', ' ', 'g') AS text, count(*) AS n
          FROM raw WHERE description IS NOT NULL AND stock_code IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, text) = 1""")

TIDY = "regexp_replace(upper(trim(description)), '\\s+', ' ', 'g')"
OUTLIERS = """
    CAST(quantity AS DOUBLE) < q1q - 1.5 * (q3q - q1q) OR CAST(quantity AS DOUBLE) > q3q + 1.5 * (q3q - q1q)
        AS is_quantity_outlier,
    CAST(price AS DOUBLE) < q1p - 1.5 * (q3p - q1p) OR CAST(price AS DOUBLE) > q3p + 1.5 * (q3p - q1p)
        AS is_price_outlier"""
NULL_RATE_ROWS = """
    SELECT 'null_rate:description' AS rule, round(avg(CAST(description IS NULL AS DOUBLE)), 6) AS value,
           CAST(0.02 AS DOUBLE) AS threshold, avg(CAST(description IS NULL AS DOUBLE)) <= 0.02 AS passed FROM raw
    UNION ALL
    SELECT 'null_rate:customer_id', round(avg(CAST(customer_id IS NULL AS DOUBLE)), 6),
           CAST(0.30 AS DOUBLE), avg(CAST(customer_id IS NULL AS DOUBLE)) <= 0.30 FROM raw
    UNION ALL
    SELECT 'null_rate:invoice_date', round(avg(CAST(invoice_date IS NULL AS DOUBLE)), 6),
           CAST(0.0 AS DOUBLE), avg(CAST(invoice_date IS NULL AS DOUBLE)) <= 0.0 FROM raw"""

SCHEMA_ROWS = " UNION ALL ".join(
    f"SELECT 'column:{c}' AS rule, CAST(count(*) FILTER ({c} IS NOT NULL) AS DOUBLE) AS value, "
    f"CAST(1 AS DOUBLE) AS threshold, count(*) FILTER ({c} IS NOT NULL) >= 1 OR count(*) = 0 AS passed FROM raw" for c in HEADINGS)


def date_rows(latest: str) -> str:
    outside = f"count(*) FILTER (invoice_date < TIMESTAMP '1995-01-01' OR invoice_date > TIMESTAMP '{latest}')"
    return (
        f"SELECT 'date_range:invoice_date' AS rule, CAST({outside} AS DOUBLE) AS value, "
        f"CAST(0 AS DOUBLE) AS threshold, {outside} <= 0 AS passed FROM raw"
    )


QUERIES = {
    "load_union": load_union,
    "coerce_types": coerce_types,
    "uncoerced_values": uncoerced_values,
    "validate_schema": validate_schema,
    "null_rates": null_rates,
    "date_range": date_range,
    "validation_report": validation_report,
    "clean_flags": clean_flags,
    "iqr_outliers": iqr_outliers,
    "iqr_fences": iqr_fences,
    "canonical_description": canonical_description,
    "standardized_descriptions": standardized,
    "dedup": dedup,
    "dedup_count": dedup_count,
    "clean_transactions": clean_transactions,
}

SQL = {
    "load_union": statement(("raw",), """
        SELECT invoice, stock_code, description, quantity, invoice_date, CAST(price AS DECIMAL(28, 6)) AS price,
               CAST(price AS DOUBLE) AS price_value, customer_id, country, source_sheet FROM raw"""),
    "coerce_types": "SELECT invoice, stock_code, description, country, TRY_CAST(price AS DOUBLE) AS price_value, " + ", ".join(
        f"{rule} AS {name}" for name, rule in COERCED_SQL.items()) + f" FROM ({SHEET_SQL})",
    "uncoerced_values": f"""
        SELECT invoice, quantity, price, invoice_date, customer_id, concat_ws(',', """ + ", ".join(
        f"CASE WHEN trim({name}) <> '' AND ({rule}) THEN '{name}' END" for name, rule in LOST_SQL.items()) + f""") AS lost
        FROM ({SHEET_SQL}) WHERE lost <> ''""",
    "validate_schema": statement(("raw",), SCHEMA_ROWS),
    "null_rates": statement(("raw",), NULL_RATE_ROWS),
    "date_range": statement(("raw",), date_rows("2001-07-31")),
    "validation_report": statement(("raw",), NULL_RATE_ROWS + " UNION ALL " + date_rows("2001-08-02")),
    "clean_flags": statement(("flagged",), """
        SELECT invoice, stock_code, quantity, price, customer_id,
               is_missing_customer_id, is_return, is_invalid_price, is_non_product FROM flagged"""),
    "iqr_outliers": statement(("raw", "fences"), f"""
        SELECT invoice, stock_code, quantity, price, {OUTLIERS} FROM raw, fences"""),
    "iqr_fences": statement(("fences",), """
        SELECT 'quantity' AS metric, round(q1q, 6) AS q1, round(q3q, 6) AS q3,
               round(q1q - 1.5 * (q3q - q1q), 6) AS lower, round(q3q + 1.5 * (q3q - q1q), 6) AS upper FROM fences
        UNION ALL
        SELECT 'price', round(q1p, 6), round(q3p, 6),
               round(q1p - 1.5 * (q3p - q1p), 6), round(q3p + 1.5 * (q3p - q1p), 6) FROM fences"""),
    "canonical_description": statement(("canonical",), "SELECT stock_code, canonical FROM canonical"),
    "standardized_descriptions": statement(("raw", "canonical"), f"""
        SELECT invoice, stock_code, coalesce(canonical, {TIDY}) AS description
        FROM raw LEFT JOIN canonical USING (stock_code)"""),
    "dedup": statement(("raw",), """
        SELECT * FROM raw
        QUALIFY row_number() OVER (
            PARTITION BY invoice, stock_code, customer_id, quantity, invoice_date, price
            ORDER BY source_sheet NULLS FIRST, description NULLS FIRST, country NULLS FIRST) = 1"""),
    "dedup_count": statement(("raw",), """
        SELECT CAST(sum(n) AS BIGINT) AS n_before, count(*) AS n_kept, CAST(sum(n - 1) AS BIGINT) AS n_removed
        FROM (SELECT count(*) AS n FROM raw
              GROUP BY invoice, stock_code, customer_id, quantity, invoice_date, price)"""),
    "clean_transactions": statement(("flagged", "fences", "canonical"), f"""
        SELECT * FROM (
            SELECT invoice, stock_code, coalesce(canonical, {TIDY}) AS description, quantity, invoice_date, price,
                   customer_id, country, source_sheet, is_missing_customer_id, is_return, is_invalid_price,
                   is_non_product, {OUTLIERS}
            FROM flagged LEFT JOIN canonical USING (stock_code), fences)
        QUALIFY row_number() OVER (
            PARTITION BY invoice, stock_code, customer_id, quantity, invoice_date, price
            ORDER BY source_sheet NULLS FIRST, description NULLS FIRST, country NULLS FIRST) = 1"""),
}
