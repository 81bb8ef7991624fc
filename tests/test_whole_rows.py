"""Fits, searches, votes and silhouettes take all rows, whatever their number."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.functions.growth import Limits
from retailscope.functions.trees import roc_auc
from retailscope.operators import density, models, neighbours, segment, tree_models


@pytest.fixture(scope="module")
def noisy(spark):
    def noise(c):
        return F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 400.0

    rows = spark.range(500).select(
        F.col("id").alias("customer_id"), (F.col("id") % 5).cast("int").alias("fold"), F.lit("train").alias("split"),
        *[noise(c).alias(c) for c in FEATURE_COLUMNS])
    label = F.col("frequency") + F.col("recency_days") + F.pmod(F.xxhash64("customer_id"), F.lit(100)) / 50 > 3.5
    return rows.withColumn("churned", label.cast("int")).withColumn("weight", F.lit(1.0)).withColumn("spend", F.col("frequency")).cache()


def test_neighbour_settings_are_judged_by_all_rows(noisy):
    options = [{"n_neighbors": k, "weights": w} for k in (5, 21) for w in ("uniform", "distance")]
    every, parts = (neighbours.knn_grid_scores(noisy, FEATURE_COLUMNS, options, 5, max_train_rows=n) for n in (10_000, 200))
    assert np.allclose(every, parts, atol=1e-12)


def test_voters_are_read_once_each_and_ids_may_be_missing(spark):
    train = [(1, 0.0, 1), (1, 0.0, 1), (None, 0.0, 0), (2, 1.0, 0), (3, 5.0, 0)]
    asked = [(None, 0.1), (7, 4.9), (7, 4.9), (8, float("nan"))]
    got = neighbours.knn_classify(
        spark.createDataFrame(asked, "customer_id bigint, x double"), spark.createDataFrame(train, "customer_id bigint, x double, churned int"), ["x"], 3)
    found = sorted(((r["customer_id"], r["probability"]) for r in got.collect()), key=str)
    assert [f for f in found if f[0] != 8] == [(7, 1 / 3), (7, 1 / 3), (None, 2 / 3)]
    assert [math.isnan(f[1]) for f in found if f[0] == 8] == [True]


def test_neighbours_are_the_same_in_slices_and_boxes(spark):
    draw = np.random.default_rng(4)
    points = [(i, *p) for i, p in enumerate(np.round(draw.normal(size=(2500, 4)) * [5, 2, 1, 0.1], 1).tolist())]
    df = spark.createDataFrame(points, "customer_id bigint, a double, b double, c double, d double")
    asked = df.where("customer_id % 40 = 0")
    whole, cut = (neighbours.nearest_neighbours(asked, df, "customer_id", ["a", "b", "c", "d"], 9, n).orderBy("id", "rank").collect() for n in (10_000, 900))
    assert whole == cut and len(whole) == 63 * 9
    values = np.array([p[1:] for p in points])
    for r in whole[::50]:
        distances = np.round(np.sqrt(((values - values[r["id"]]) ** 2).sum(axis=1)), 9)
        assert r["neighbour"] == np.lexsort((np.arange(2500), distances))[r["rank"] - 1]


def test_a_row_asks_few_boxes():
    from retailscope.functions import boxes

    draw = np.random.default_rng(8)
    points = draw.normal(size=(40_000, 6)) * [6, 3, 1, 0.5, 0.2, 0.1]
    found = boxes.boxed(points)
    found.pop("order")
    held, asked = boxes.Boxes(**found), points[:500]
    compared = [len(rows) * (at.stop - at.start) for rows, at, _ in held.within(asked, 0.04)]
    assert 0 < sum(compared) < 0.1 * len(asked) * len(points)


def test_density_points_are_not_copied(spark):
    draw = np.random.default_rng(5)
    points = [(i, p.tolist(), 1 + i % 3) for i, p in enumerate(draw.normal(size=(900, 3)))]
    df = spark.createDataFrame(points, "id bigint, vector array<double>, weight bigint")
    counted = density.neighbour_counts(df, 0.5, 250)
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
    values, weights = np.array([p[1] for p in points]), np.array([p[2] for p in points])
    near = ((values[:, None] - values[None]) ** 2).sum(axis=2) <= 0.25
    assert {r["id"]: r["n_neighbours"] for r in counted.collect()} == dict(enumerate((near @ weights).tolist()))
    links = [(r["a"], r["b"]) for r in density.core_links(df, 0.5, 250).collect()]
    assert len(links) < 0.5 * near.sum() and all(a < 900 and b < 900 for a, b in links)
    labels = {r["id"]: r["label"] for r in density.connected_labels(df, density.core_links(df, 0.5, 250)).collect()}
    smallest = np.arange(900)
    for _ in range(900):
        grown = np.where(near, smallest[None], 900).min(axis=1)
        if (grown == smallest).all():
            break
        smallest = grown
    assert labels == dict(enumerate(smallest.tolist()))


def test_silhouette_judges_all_rows(spark):
    draw = np.random.default_rng(6)
    points = draw.normal(size=(4500, 3)) * 0.5 + np.repeat([[0.0], [3.0], [3.5]], 1500, axis=0)
    points[10] = points[11]
    rows = [(i, *map(float, p), i // 1500) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "customer_id bigint, x double, y double, z double, cluster int")
    means = np.stack([np.linalg.norm(points[:, None] - points[None, own : own + 1500], axis=2).sum(axis=1) for own in (0, 1500, 3000)], axis=1)
    own = np.arange(4500) // 1500
    inside, others = means[np.arange(4500), own] / 1499, means / 1500
    others[np.arange(4500), own] = np.inf
    value = ((others.min(axis=1) - inside) / np.maximum(inside, others.min(axis=1))).mean()
    found = segment.euclidean_silhouette(df, ["x", "y", "z"]).first()
    assert found["n_judged"] == 4500 and found["standard_error"] == 0 and found["silhouette"] == pytest.approx(value, abs=1e-11)


def test_silhouettes_are_the_same_in_slices(spark, monkeypatch):
    rows = [(None if i % 9 == 0 else i % 50, float(i * i % 37), float(i % 11), i % 3, i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id bigint, x double, y double, a int, b int")
    whole = segment.silhouettes(df, ["x", "y"], ["a", "b"], "customer_id").orderBy("clustering").collect()
    monkeypatch.setattr(segment, "SLICE_ROWS", 150)
    monkeypatch.setattr(segment, "MANY_CLUSTERS", 2)
    cut = segment.silhouettes(df, ["x", "y"], ["a", "b"], "customer_id").orderBy("clustering").collect()
    assert [r["n_judged"] for r in whole] == [r["n_judged"] for r in cut] == [400, 400]
    for one, other in zip(whole, cut):
        assert one["silhouette"] == pytest.approx(other["silhouette"], abs=1e-12)


class Enough(Exception):
    pass


SHORT = {
    "decision_tree": ("search_trees", [{"max_depth": 2, "min_samples_leaf": 1}, {"max_depth": 3, "min_samples_leaf": 1}]),
    "random_forest": ("search_trees", [{"n_estimators": 3, "max_depth": d, "min_samples_leaf": 1} for d in (2, 3)]),
    "boosted_trees": ("search_boosted", [{"learning_rate": r, "max_depth": 2, "n_estimators": 2} for r in (0.1, 0.3)]),
    "boosted_trees_by_leaf": ("search_boosted", [{"learning_rate": r, "num_leaves": 3, "n_estimators": 2} for r in (0.1, 0.3)]),
}


@pytest.mark.parametrize("name", sorted(SHORT))
def test_searches_read_all_rows(noisy, monkeypatch, name):
    def search(spark, held, *rest, **more):
        raise Enough(len(held.labels))

    monkeypatch.setattr(models, "MAX_SAMPLE_ROWS", 100, raising=False)
    monkeypatch.setattr(models, SHORT[name][0], search)
    with pytest.raises(Enough, match="500"):
        models.CLASSIFIERS[name].fit(noisy, SHORT[name][1])


def test_forests_are_fitted_on_all_rows(noisy, monkeypatch):
    def fit(spark, held, *rest, **more):
        raise Enough(len(held.labels))

    monkeypatch.setattr(models, "MAX_SAMPLE_ROWS", 100, raising=False)
    monkeypatch.setattr(models, "fit_forest", fit)
    with pytest.raises(Enough, match="500"):
        models.CLASSIFIERS["random_forest"].fit(noisy, [{"n_estimators": 3, "max_depth": 2, "min_samples_leaf": 1}])
    with pytest.raises(Enough, match="500"):
        models.train_clv_regressor(noisy, "spend", [{"n_estimators": 3, "max_depth": 2}])


def test_logistic_settings_are_judged_on_all_rows(noisy, monkeypatch):
    monkeypatch.setattr(models, "MAX_SAMPLE_ROWS", 100, raising=False)
    options = [{"C": 0.01}, {"C": 1.0}]
    _, best, score = models.CLASSIFIERS["logistic_regression"].fit(noisy, options)
    held = noisy.toPandas()
    values = held[list(FEATURE_COLUMNS)].to_numpy()
    values = (values - values.mean(axis=0)) / values.std(axis=0)
    own = []
    for fold in range(5):
        inside = (held["fold"] != fold).to_numpy()
        weights = np.zeros(13)
        given = np.concatenate([values, np.ones((500, 1))], axis=1)
        for _ in range(30):
            chance = 1 / (1 + np.exp(-given[inside] @ weights))
            ridge = np.append(np.ones(12), 0) / best["C"]
            slope = given[inside].T @ (chance - held["churned"][inside]) + ridge * weights
            weights -= np.linalg.solve((given[inside] * (chance * (1 - chance))[:, None]).T @ given[inside] + np.diag(ridge) + 1e-12 * np.eye(13), slope)
        own.append(roc_auc(held["churned"][~inside].to_numpy(), given[~inside] @ weights))
    assert score == pytest.approx(np.mean(own), abs=1e-6)


def test_large_forests_are_scored_where_they_are_stored(spark, noisy, monkeypatch):
    rows = tree_models.training_rows(noisy, FEATURE_COLUMNS, "churned", F.lit(1.0))
    held = tree_models.held_rows(rows, tree_models.bin_edges(rows, 12))
    small = tree_models.fit_forest(spark, held, FEATURE_COLUMNS, 25, Limits(), 42, 3)
    monkeypatch.setattr(tree_models, "MAX_NODES", 10)
    monkeypatch.setattr(tree_models, "MAX_TASK_ROWS", 200)
    monkeypatch.setattr(tree_models, "JUDGED_AT_ONCE", 64)
    large = tree_models.fit_forest(spark, held, FEATURE_COLUMNS, 25, Limits(), 42, 3)
    assert type(large) is tree_models.StoredForest and large.__dict__["ensemble"] is None
    twice = noisy.unionByName(noisy.limit(20)).withColumn("customer_id", F.when(F.col("customer_id") > 3, F.col("customer_id")))
    one, many = (np.sort(m.transform(twice).toPandas()["probability"]) for m in (small, large))
    assert len(one) == len(many) == 520 and np.allclose(one, many, atol=1e-12)
    assert large.transform(noisy).columns == small.transform(noisy).columns
    large.save(spark, str(spark.conf.get("spark.checkpoint.dir")) + "/whole-rows-model")


def test_tables_without_rows_or_cores(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0), (2, 5.0, 1.0, 1), (3, 9.0, 2.0, 1)], "customer_id bigint, x double, y double, cluster int")
    alone = density.dbscan(df, ["x", "y"], 0.5, 3).orderBy("customer_id").collect()
    assert [tuple(r) for r in alone] == [(1, 1, False, -1), (2, 1, False, -1), (3, 1, False, -1)]
    every = density.dbscan(df, ["x", "y"], 0.5, 1).orderBy("customer_id").collect()
    assert [r["cluster"] for r in every] == [0, 1, 2]
    none = df.where("customer_id > 5")
    assert density.dbscan(none, ["x", "y"]).collect() == density.dbscan_core(none, ["x", "y"]).collect() == []
    assert tuple(segment.euclidean_silhouette(none, ["x", "y"]).first()) == (None, 0, None)
    assert neighbours.knn_classify(none, df, ["x", "y"], 2, label="cluster").collect() == []
    with pytest.raises(ValueError, match="empty"):
        neighbours.knn_classify(df, none, ["x", "y"], 2, label="cluster")


def test_side_by_side_blocks_keep_the_partitions(spark):
    from retailscope.sources.shared import ROWS_PER_PARTITION, partitions_for

    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    one, two = partitions_for(spark, 50 * ROWS_PER_PARTITION), partitions_for(spark, 70 * ROWS_PER_PARTITION)
    one.__enter__()
    two.__enter__()
    assert spark.conf.get(name) == "70"
    one.__exit__(None, None, None)
    assert spark.conf.get(name) == "70"
    two.__exit__(None, None, None)
    assert spark.conf.get(name) == before
