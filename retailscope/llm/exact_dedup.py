"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by SHA-256 digest, one row per text ever kept. A batch
is reduced to one row per digest, sort-merge anti-joined with the index and the remainder appended; the
index side of that join is read as its buckets lie, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.functions.hotkeys import join_groups
from retailscope.llm.common import fresh_path, only_named, whole_text
from retailscope.sources.shared import materialize
from retailscope.sources.transactions import path_exists

ROWS_PER_BUCKET = 2_000_000


class DigestIndex:
    """The digests of every text kept so far, below ``path`` in shared storage.

    A new folder is made with ``buckets`` buckets; an existing one is opened with the number it was
    made with, also from a later session. Appending is one Spark write: it is there as a whole or not
    at all, and ingesting the same batch again appends nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path
        if path_exists(spark, f"{path}/layout"):
            buckets = spark.read.json(f"{path}/layout").first()["buckets"]
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(f"{path}/layout")
        self.buckets = buckets
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/entries'"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, batch: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Append the new texts of ``batch`` and return the decision on each of its rows.

        Returns (doc_id, keep_id, group_size, kept, text_sha256), one row per input row. Null text counts
        as empty. Of equal texts in the batch the largest id stays; a text the index already holds keeps
        the id it was stored with. ``group_size`` counts the batch's rows with that text. Rows that
        repeat an id and text are decided alike and each counts. Null ids lose against others; a text
        that only has null ids stays under a null ``keep_id``. An empty batch gives no rows.
        """
        rows = only_named(batch, doc_id=id_column, text=text_column).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(whole_text(), 256)).alias("digest")
        )
        rows = materialize(rows, "digests")
        # written out, else the anti-join would move below the grouping and shuffle every copy of a text
        groups = materialize(
            rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups"
        )
        known = self.entries().select("digest").hint("merge")
        fresh = groups.select("digest", "keep_id").join(known, "digest", "left_anti")
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)

        decided = groups.select("digest", "group_size").join(self.entries().hint("merge"), "digest")
        decided = materialize(decided, "digest-decisions")
        return join_groups(rows, decided, "digest", "group_size", rows.count(), "merge").select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def buckets_for(docs: DataFrame) -> int:
    """Enough buckets for tasks of bounded size; counting a Parquet table reads only its footers."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-docs.count() // ROWS_PER_BUCKET))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Deduplicate one table on its own: a new index that takes it in as its first batch."""
    spark = docs.sparkSession
    index = DigestIndex(spark, fresh_path(spark, "digest-index"), buckets_for(docs))
    return index.ingest(docs, id_column, text_column)
