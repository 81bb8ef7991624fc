"""Column names and types of the transaction table."""

from __future__ import annotations

from pyspark.sql import types as T

# Source headings and their canonical names.
RAW_TO_CANONICAL = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

CANONICAL_COLUMNS = tuple(dict.fromkeys(RAW_TO_CANONICAL.values()))

PRICE_TYPE = T.DecimalType(28, 6)  # exact money, to a millionth
PRICE_VALUE = "price_value"  # the price as a double, whatever its digits

# Input formats of invoice dates besides ISO 8601, tried in order.
DATE_FORMATS = ("M/d/yyyy H:mm", "d.M.yyyy H:mm")

TRANSACTION_TYPES = {
    "invoice": T.StringType(),
    "stock_code": T.StringType(),
    "description": T.StringType(),
    "quantity": T.LongType(),
    "invoice_date": T.TimestampNTZType(),
    "price": PRICE_TYPE,
    "customer_id": T.LongType(),
    "country": T.StringType(),
}
