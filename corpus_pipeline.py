"""A training corpus from raw documents: five stages, each applying one operator to all rows it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.functions.hotkeys import join_groups
from retailscope.llm.common import fresh_path, whole_text, without_repeats
from retailscope.llm.decontaminate import decontaminate
from retailscope.llm.langid import UNDECIDED, identify_languages
from retailscope.llm.mixing import mix
from retailscope.llm.simhash import fingerprints, simhash_heads
from retailscope.llm.token_shards import token_shards

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter go."""
    return identify_languages(docs, docs, keep=COLUMNS).where(F.col("lang_pred") != UNDECIDED).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document, that with the smallest id.

    Where an id is null or stands for several rows, its rows are told apart by their fingerprints as well.
    """
    docs = docs.select(*COLUMNS)
    heads, shared = simhash_heads(docs)
    if shared.isEmpty():
        return without_repeats(docs, heads, "doc_id")
    unclear = heads["doc_id"].eqNullSafe(shared["doc_id"])
    plain = without_repeats(docs, heads.join(shared, unclear, "left_anti"), "doc_id")
    several = shared.where("doc_id IS NOT NULL")
    told = docs.where("doc_id IS NULL").unionByName(join_groups(docs, several, "doc_id", "n", docs.count()).drop("n"))
    told = told.withColumn("fp", fingerprints(whole_text()))
    return plain.unionByName(without_repeats(told, heads.join(shared, unclear, "left_semi"), "doc_id", "fp").drop("fp"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any phrase of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark, keep=COLUMNS).where(F.size("spans") == 0).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix holds it."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mix(docs, keep=COLUMNS).select(*COLUMNS, copies.alias("copy")).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary shards in training order, and where each document's tokens lie."""
    return token_shards(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]

# Language prototypes and fingerprints are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written out and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return result
        path = fresh_path(spark, f"pipeline-{number}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
