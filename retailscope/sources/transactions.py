"""Reading raw transaction sheets: heading standardisation, exact coercion, union with a source tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailscope.schema import CANONICAL_COLUMNS, DATE_FORMATS, PRICE_VALUE, RAW_TO_CANONICAL, TRANSACTION_TYPES


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename source headings to canonical names; fail when a column is absent."""
    renamed = df.withColumnsRenamed({k: v for k, v in RAW_TO_CANONICAL.items() if k in df.columns})
    missing = sorted(set(CANONICAL_COLUMNS) - set(renamed.columns))
    if missing:
        raise ValueError(f"source is missing expected columns: {missing}")
    return renamed


EXACT = "decimal(38,18)"  # wide enough to see what a narrower type would round away


def coerced(name: str, date_formats: Sequence[str] = DATE_FORMATS) -> Column:
    """One known column in its type; null where the value does not parse or, if a whole number, has a fraction.

    A price is rounded to the nearest millionth; ``price_value`` beside it keeps the value itself.
    """
    target = TRANSACTION_TYPES[name]
    if isinstance(target, T.LongType):
        # spreadsheets export whole numbers as "17.0"; nothing is rounded into a type
        fitted = F.col(name).try_cast(EXACT).try_cast(target)
        return F.when(fitted.cast(EXACT) == F.col(name).try_cast(EXACT), fitted)
    if isinstance(target, T.TimestampNTZType):
        text = F.col(name).cast("string")
        others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in date_formats]
        return F.coalesce(F.col(name).try_cast(target), *others)
    return F.col(name).try_cast(target)


def coerce_types(df: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Give every known column its type without losing a value.

    What does not parse becomes null, as does a fraction where a whole number belongs; ``uncoerced`` lists it.
    A price comes twice: as an exact decimal for sums of money, rounded to a millionth, and as the double
    ``price_value``, which keeps prices of any size and fineness and tells tiny ones from zero.
    """
    typed = {name: coerced(name, date_formats) for name in TRANSACTION_TYPES if name in df.columns}
    return df.withColumns(typed | ({PRICE_VALUE: F.col("price").try_cast("double")} if "price" in typed else {}))


def is_rounded(name: str, date_formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Whether a decimal column holds its value only after rounding."""
    if not isinstance(TRANSACTION_TYPES[name], T.DecimalType):
        return F.lit(False)
    held = coerced(name, date_formats)
    vanished = (held == 0) & (F.col(name).try_cast("double") != 0)  # finer than EXACT tells
    return F.coalesce(held.try_cast(EXACT) != F.col(name).try_cast(EXACT), F.lit(False)) | F.coalesce(vanished, F.lit(False))


def uncoerced(df: DataFrame, date_formats: Sequence[str] = DATE_FORMATS, exact: bool = False) -> DataFrame:
    """Rows of ``df`` with a value that coercion loses, and the names of those columns in ``lost``.

    A price counts as lost if it is no number or too large for money; with ``exact`` also if its decimal,
    which sums of money use, is a rounded one.
    """
    lost = []
    for n in TRANSACTION_TYPES:
        if n in df.columns:
            given = F.col(n).isNotNull() & (F.trim(F.col(n).cast("string")) != "")
            gone = coerced(n, date_formats).isNull()
            lost.append(F.when(given & (gone | is_rounded(n, date_formats) if exact else gone), F.lit(n)))
    return df.withColumn("lost", F.filter(F.array(*lost), lambda name: name.isNotNull())).where(F.size("lost") > 0)


def union_sheets(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Standardise each sheet, tag its rows with the sheet name and stack them by column name.

    Rows keep no global order: a consumer that needs one sorts at its sink.
    """
    tagged = [
        standardize_columns(df).withColumn("source_sheet", F.lit(name)) for name, df in sheets.items()
    ]
    combined = tagged[0]
    for other in tagged[1:]:
        combined = combined.unionByName(other)
    return coerce_types(combined)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def load_raw_transactions(spark: SparkSession, sheets: Mapping[str, str], fmt: str = "csv") -> DataFrame:
    """Load ``{sheet name: path}`` from CSV or Parquet into one typed transaction table."""
    frames = {}
    for name, path in sheets.items():
        if not path_exists(spark, path):
            raise FileNotFoundError(f"raw data set not found at {path}")
        reader = spark.read
        frames[name] = reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)
    return union_sheets(frames)
