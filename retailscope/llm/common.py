"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.sources.shared import materialize, shared_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the storage every executor shares."""
    return f"{shared_folder(spark)}/retailscope-llm/{label}-{uuid.uuid4().hex}"


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def only_named(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named input columns, under the operator's own names.

    Whatever else the input holds, clashing names included, stays outside the operator.
    """
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def worker_state(place: str, key: object, build: Callable):
    """An object kept in the Python worker across tasks (vocabularies, caches).

    A worker holds one object: asking for another place or ``key`` lets the old one go first, so a pipeline's
    later stages do not carry what earlier ones remembered.
    """
    holder = sys.modules.setdefault("retailscope_worker_state", types.ModuleType("retailscope_worker_state"))
    kept = holder.__dict__.setdefault("kept", {})
    if (place, key) not in kept:
        kept.clear()
        kept[place, key] = build()
    return kept[place, key]


def without_repeats(docs: DataFrame, ids: DataFrame, *key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is among ``ids``, one for each; null is a value like others.

    Rows that repeat a key are one document, of which any row stays. Documents move once, to meet the ids
    in a sort-merge join, at every size alike.
    """
    counted = materialize(ids.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "kept-ids")
    counted = counted.withColumnsRenamed({k: f"kept_{k}" for k in key})
    same = [F.col(k).eqNullSafe(F.col(f"kept_{k}")) for k in key]

    def among(keys: DataFrame) -> DataFrame:
        return docs.join(keys.hint("merge"), same, "left_semi")

    repeated = counted.where("n > 1")
    once = among(counted.where("n = 1"))
    return once if repeated.isEmpty() else once.unionByName(among(repeated).dropDuplicates([*key]))


def hash_sample(df: DataFrame, most: int, *columns: str) -> DataFrame:
    """At most ``most`` rows in the order of a hash of ``columns``, the same ones whatever the partitioning.

    Of a large table only the rows under a hash threshold, about twice as many as wanted, are sorted, so
    what reaches one place does not grow with the number of partitions. Only a table made of so few
    different rows that the threshold misses too many is sorted as it is.
    """
    draw, span = F.xxhash64(*columns), 1 << 30
    total = df.count()
    if total > 4 * most:
        under = df.where(F.pmod(draw, F.lit(span)) < -(-span * 2 * most // total))
        df = under if under.limit(most).count() == most else df
    return df.orderBy(draw, *columns).limit(most)
