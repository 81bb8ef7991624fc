"""Online scoring: the batch scoring rules over a stream of request files.

Validation and scoring are row-local, so the stream needs no state and no watermark. Each micro-batch is
appended under its query's and its own folder, which a retried batch overwrites: results appear exactly
once, and a stream with a new checkpoint never replaces what an earlier one wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators.score import score_rows, split_valid

REQUEST_SCHEMA = T.StructType(
    [T.StructField("customer_id", T.StringType())] + [T.StructField(c, T.StringType()) for c in FEATURE_COLUMNS]
)


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests from JSON files dropped in ``folder``; a field that does not parse is missing."""
    text = spark.readStream.schema(REQUEST_SCHEMA).json(folder)
    return text.select(
        F.col("customer_id").try_cast("bigint").alias("customer_id"),
        *[F.col(c).try_cast("double").alias(c) for c in FEATURE_COLUMNS],
    )


def score_stream(
    requests: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    model_name: str,
    predictions: str,
    quarantine: str,
    checkpoint: str,
) -> StreamingQuery:
    """Score good requests into ``predictions`` and file bad ones, with reasons, in ``quarantine``.

    ``scorer`` adds ``probability`` to a table of feature columns. The query drains what is available.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"query={query}/batch={batch_id}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_valid(batch)
            records = score_rows(scorer(good), F.col("probability"), model_name)
            records.write.mode("overwrite").parquet(f"{predictions}/{place}")
            bad.write.mode("overwrite").parquet(f"{quarantine}/{place}")
        finally:
            batch.unpersist()

    return (
        requests.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
