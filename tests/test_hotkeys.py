"""A key with a third of all rows, adaptive execution switched off."""

import pytest
from pyspark.sql import functions as F

from retailscope.functions.hotkeys import join_groups
from retailscope.functions.ranks import percent_ranks


@pytest.fixture
def no_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_a_hot_key_do_not_move(spark, no_adaptive):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    joined = join_groups(rows, groups, "k", "n", 6000)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    moved = joined.where(F.col("n") * 1000 <= 6000)
    sizes = moved.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert joined.count() == 6000 and joined.where("k = 0").select("first").distinct().collect()[0][0] == 0
    assert sizes < 2000


def test_percent_ranks_with_a_value_of_a_third(spark, no_adaptive):
    values = [1.0] * 100 + [float(i) for i in range(2, 202)] + [None] * 3
    df = spark.createDataFrame(list(enumerate(values)), "customer_id bigint, x double")
    got = {r["customer_id"]: r["x_rank"] for r in percent_ranks(df, "customer_id", ["x"]).collect()}
    assert got[0] == pytest.approx(50.5 / 300) and got[150] == pytest.approx(151 / 300) and got[299] == 1.0
