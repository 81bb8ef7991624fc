from helpers import documents

from retailscope.functions.hotkeys import join_groups
from retailscope.llm.common import hash_sample, without_repeats, worker_state
from pyspark.sql import functions as F


def test_hash_sample_is_bounded_and_stable(spark):
    rows = spark.range(20000)
    some = [r["id"] for r in hash_sample(rows, 100, "id").collect()]
    assert len(some) == 100 and some == [r["id"] for r in hash_sample(rows.repartition(7), 100, "id").collect()]
    whole = [r["id"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(100).collect()]
    assert len(set(some) | set(whole)) <= 200
    assert hash_sample(rows.limit(5), 100, "id").count() == 5 and hash_sample(rows.limit(0), 100, "id").count() == 0
    same = rows.select(F.lit(1).alias("id"))
    assert hash_sample(same, 10, "id").count() == 10


def test_join_groups_with_a_hot_key(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    got = join_groups(rows, groups, "k", "n", 6000)
    assert got.count() == 6000 and got.where("n = 2000").count() == 2000
    assert {r["first"] for r in got.where("k = 0").collect()} == {0}


def test_without_repeats(spark):
    docs = documents(spark, [(1, "a", "", ""), (2, "b", "", ""), (2, "b", "", ""), (None, "c", "", ""), (3, "d", "", "")], extra=False)
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "doc_id bigint")
    got = without_repeats(docs, ids, "doc_id")
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == [("1", "a"), ("2", "b"), ("None", "c")]


def test_a_worker_keeps_one_object():
    built = []
    ask = lambda place, key: worker_state(place, key, lambda: built.append((place, key)) or len(built))
    assert [ask("a", 1), ask("a", 1), ask("a", 2), ask("b", 2), ask("b", 2), ask("a", 2)] == [1, 1, 2, 3, 3, 4]
