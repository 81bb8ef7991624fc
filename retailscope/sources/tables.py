"""Sinks and scans of run outputs: features, logs, scores, segments, models, metadata."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailscope.config import FALLBACK_MODEL_NAME, FEATURE_COLUMNS, MODEL_VERSION
from retailscope.operators.logistic import LinearModel
from retailscope.operators.tree_models import TreeModel
from retailscope.sources.transactions import path_exists

SCORING_SCHEMA = T.StructType(
    [T.StructField("customer_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS]
    + [T.StructField("corrupt_record", T.StringType())]
)

METADATA_SCHEMA = T.StructType([
    T.StructField("trained_at", T.StringType()),
    T.StructField("n_customers", T.LongType()),
    T.StructField("cutoff_date", T.StringType()),
    T.StructField("best_model", T.StringType()),
    T.StructField("kmeans_k", T.IntegerType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def write_cleaned(lines: DataFrame, path: str) -> DataFrame:
    """Write cleaned lines partitioned by year and month, so a cutoff prunes whole folders.

    Rows of a month are brought together first, so files follow from the size of the data and not from
    tasks times months; adaptive execution splits a month that is too large for one task.
    """
    spark = lines.sparkSession
    dated = lines.withColumns({"year": F.year("invoice_date"), "month": F.month("invoice_date")})
    dated.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)
    return read_cleaned(spark, path)


def read_cleaned(spark: SparkSession, path: str, until: datetime | None = None) -> DataFrame:
    """Cleaned lines; ``until`` prunes the month folders after it. Undated lines are kept out by it."""
    rows = spark.read.parquet(path)
    if until is not None:
        rows = rows.where(
            (F.col("year") < until.year) | ((F.col("year") == until.year) & (F.col("month") <= until.month))
        )
    return rows.drop("year", "month")


def write_features(features: DataFrame, path: str, cutoff: datetime) -> None:
    """Write one cutoff's feature table; other cutoffs in ``path`` stay."""
    dated = features.withColumn("cutoff_date", F.lit(cutoff.isoformat(sep=" ")))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cutoff_date").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table, or an empty one when nothing has been written."""
    if not path_exists(spark, path):
        schema = ", ".join(["customer_id bigint", *[f"{c} double" for c in FEATURE_COLUMNS], "churned int"])
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def write_csv(table: DataFrame, path: str) -> None:
    """Write a report table as CSV with a header; maps and arrays become JSON text."""
    nested = {n: F.to_json(n) for n, t in table.dtypes if t.startswith(("map", "array", "struct"))}
    flat = table.withColumns(nested) if nested else table
    flat.write.mode("overwrite").csv(path, header=True)


def append_records(records: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Append predictions or segment assignments to a table; ``fmt='jdbc'`` reaches a database."""
    if fmt == "jdbc":
        options["dbtable"] = target
        records.write.mode("append").format(fmt).options(**options).save()
    else:
        records.write.mode("append").format(fmt).options(**options).save(target)


def read_scoring_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scoring rows from a CSV file.

    Fields that do not parse become null, and rows with too many or too few fields keep their text in
    ``corrupt_record``; scoring quarantines both.
    """
    if not path.endswith(".csv"):
        raise ValueError("only CSV files are accepted")
    header = spark.read.csv(path, header=True).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in header] + [T.StructField("corrupt_record", T.StringType())])
    rows = (
        spark.read.schema(text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "corrupt_record")
        .csv(path, header=True)
    )
    known = {f.name: F.col(f.name).try_cast(f.dataType) for f in SCORING_SCHEMA if f.name in header}
    return rows.select(*[known[f.name].alias(f.name) for f in SCORING_SCHEMA if f.name in known], "corrupt_record")


def save_model(model: PipelineModel | TreeModel | LinearModel, folder: str, name: str) -> str:
    """Write a model: a pipeline in Spark's format, trees and linear models as tables."""
    path = f"{folder}/{name}"
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(SparkSession.active(), path)
    return path


def load_model(folder: str, name: str) -> PipelineModel | TreeModel | LinearModel:
    spark, path = SparkSession.active(), f"{folder}/{name}"
    if path_exists(spark, f"{path}/stages"):
        return PipelineModel.load(path)
    kind = TreeModel if "tree" in spark.read.parquet(path).columns else LinearModel
    return kind.load(spark, path)


def append_metadata(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Append one run's metadata as JSON."""
    row = tuple(record.get(f.name) for f in METADATA_SCHEMA)
    spark.createDataFrame([row], METADATA_SCHEMA).write.mode("append").json(path)


def latest_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    """The newest run's metadata, or an empty dict."""
    if not path_exists(spark, path):
        return {}
    runs = spark.read.schema(METADATA_SCHEMA).json(path)
    newest = runs.agg(F.max_by(F.struct(*runs.columns), "trained_at").alias("run")).first()["run"]
    return newest.asDict() if newest else {}


def model_card(spark: SparkSession, path: str, columns: Sequence[str] = FEATURE_COLUMNS) -> dict[str, Any]:
    """What a caller needs to know about the serving model; a fallback name before the first run."""
    run = latest_metadata(spark, path)
    return {
        "model_name": run.get("best_model") or FALLBACK_MODEL_NAME,
        "model_version": MODEL_VERSION,
        "trained_at": run.get("trained_at"),
        "metrics": run.get("metrics") or {},
        "feature_columns": list(columns),
    }

