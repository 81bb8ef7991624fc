"""Date arithmetic on naive timestamps, independent of the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp(value: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed 24-hour days, not calendar days."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")
