"""Every model family on data with a planted signal, at small settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.functions.growth import Boosting, Limits, Rows, grow_by_level
from retailscope.functions.trees import LEAF, rmse, roc_auc
from retailscope.operators import metrics, models, neighbours, tree_models
from retailscope.operators.logistic import newton
from retailscope.operators.tree_models import (
    TreeModel, bin_edges, bounded_sample, fit_boosted, fit_forest, fit_tree, search_boosted, search_trees, training_rows,
)

SMALL = {
    "logistic_regression": {"C": 1.0},
    "decision_tree": {"max_depth": 4, "min_samples_leaf": 5},
    "random_forest": {"n_estimators": 20, "max_depth": 5, "min_samples_leaf": 5},
    "boosted_trees": {"learning_rate": 0.1, "max_depth": 3, "n_estimators": 10, "subsample": 0.8, "colsample": 0.8},
    "boosted_trees_by_leaf": {"learning_rate": 0.1, "num_leaves": 15, "n_estimators": 10},
    "perceptron": {"hidden": (8,), "max_iter": 60},
    "knn": {"n_neighbors": 11, "weights": "distance"},
}


@pytest.fixture(scope="module")
def planted(spark):
    def noise(c):
        return F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 400.0

    rows = spark.range(600).select(
        F.col("id").alias("customer_id"), (F.col("id") % 3 == 0).cast("int").alias("churned"), (F.col("id") % 5).cast("int").alias("fold"),
        *[(F.when(F.col("id") % 3 == 0, 1.5).otherwise(0.0) + noise(c)).alias(c) for c in FEATURE_COLUMNS],
        F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int")).alias("split"),
    )
    return rows.withColumn("spend", 10 * F.col("monetary_total") + F.col("frequency")).cache()


@pytest.fixture(scope="module")
def log(planted):
    return models.train_all(planted, {name: [option] for name, option in SMALL.items()})


@pytest.mark.parametrize("name", sorted(SMALL))
def test_model_finds_the_signal(log, name):
    row = log[1].where(F.col("model") == name).first()
    assert row["status"] == "trained" and row["roc_auc"] > 0.9 and row["val_roc_auc"] > 0.9 and row["f1"] > 0.6
    cells = row["confusion_matrix"]
    assert row["accuracy"] == pytest.approx((cells[0][0] + cells[1][1]) / sum(map(sum, cells)))


def test_comparison_ranks_by_validation(log):
    ranked = metrics.rank_models(log[1], "val_roc_auc").collect()
    scores = [r["val_roc_auc"] for r in ranked]
    assert scores == sorted(scores, reverse=True) and len(scores) == len(SMALL)
    assert set(log[0]) == set(SMALL) - {"knn"}


def test_saved_models_score_alike(spark, planted, log, tmp_path):
    from retailscope.sources import tables

    for name, model in log[0].items():
        tables.save_model(model, str(tmp_path), name)
        again = models.score_with(tables.load_model(str(tmp_path), name), planted)
        gap = again.join(models.score_with(model, planted).select("customer_id", F.col("probability").alias("p")), "customer_id")
        assert gap.agg(F.max(F.abs(F.col("p") - F.col("probability")))).first()[0] < 1e-12, name


def test_value_regression_searches_its_grid(planted):
    _, judged = models.train_clv_regressor(planted, "spend", [{"n_estimators": 10, "max_depth": d} for d in (1, 6)])
    assert judged.first()["r2"] > 0.6


@pytest.fixture(scope="module")
def training(planted):
    """Rows whose label follows two features with noise, so that settings differ."""
    noisy = planted.withColumn("churned", (F.col("frequency") + F.col("recency_days") + F.rand(3) * 2 > 3.5).cast("int")).cache()
    rows = training_rows(noisy, FEATURE_COLUMNS, "churned", F.lit(1.0)).cache()
    edges = bin_edges(rows, len(FEATURE_COLUMNS))
    return noisy, rows, edges, bounded_sample(rows, edges, 10_000)


def test_sample_holds_all_rows_or_a_fixed_part(training):
    _, rows, edges, sample = training
    assert len(sample.labels) == rows.count() == 600
    some = bounded_sample(rows, edges, 100)
    assert len(some.labels) == 100 and set(some.keys) < set(sample.keys)
    assert (bounded_sample(rows.repartition(7), edges, 100).keys == some.keys).all()


def test_trees_counted_by_jobs_equal_those_of_one_task(training, monkeypatch):
    _, rows, edges, _ = training
    monkeypatch.setattr(tree_models, "BLOCK_ROWS", 130)
    for how in (Boosting(3, 0.1, Limits(1.0, 1.0, depth=3), row_share=0.8, column_share=0.8),
                Boosting(2, 0.1, Limits(0.0, 1e-3, 20, leaves=6), by_leaf=True)):
        one, many = (fit_boosted(rows, FEATURE_COLUMNS, edges, how, most).ensemble for most in (1000, 100))
        assert abs(one.base - many.base) < 1e-12 and len(one.trees) == len(many.trees) == how.rounds
        for a, b in zip(one.trees, many.trees):
            assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.allclose(a.value, b.value)
        if how.by_leaf:
            assert all((t.feature == LEAF).sum() == 6 for t in one.trees)
    one, many = (fit_tree(rows, FEATURE_COLUMNS, edges, Limits(least_rows=10, depth=4), most).ensemble for most in (1000, 100))
    assert (one.trees[0].feature == many.trees[0].feature).all() and np.allclose(one.trees[0].value, many.trees[0].value)


def test_scores_of_jobs_are_written_every_few_trees(training, monkeypatch):
    _, rows, edges, _ = training
    labels, write = [], tree_models.materialize
    monkeypatch.setattr(tree_models, "materialize", lambda df, label: labels.append(label) or write(df, label))
    monkeypatch.setattr(tree_models, "TREES_UNWRITTEN", 3)
    monkeypatch.setattr(tree_models, "BLOCK_ROWS", 130)
    how = Boosting(7, 0.3, Limits(1.0, 1.0, depth=2), row_share=0.8)
    one, many = (fit_boosted(rows, FEATURE_COLUMNS, edges, how, most).ensemble for most in (1000, 100))
    assert labels == ["fit-blocks"] * 4  # the rows, their first score, and after three and six trees
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.allclose(a.value, b.value)


def test_jobs_spread_the_blocks_of_a_fit(training, monkeypatch):
    _, rows, edges, _ = training
    monkeypatch.setattr(tree_models, "BLOCK_ROWS", 130)
    blocks = tree_models.SparkRows(rows, edges).blocks
    assert blocks.count() == 5 and len(blocks.inputFiles()) == 5


def test_the_root_is_counted_once(training):
    _, _, edges, sample = training

    class Asked(Rows):
        counted = []

        def sums(self, nodes, columns):
            self.counted.append(nodes)
            return super().sums(nodes, columns)

        def splits(self, nodes, columns, limits):
            self.counted.append(nodes)
            return super().splits(nodes, columns, limits)

    parts = np.stack([sample.labels, np.ones(600), np.ones(600)], axis=1)
    grow_by_level(Asked(sample.bins, parts), edges, Limits(depth=2))
    assert Asked.counted == [[0], [1, 2]]


def test_shared_fits_score_like_separate_ones(spark, training):
    _, _, _, sample = training
    options = [{"n_estimators": n, "max_depth": d, "min_samples_leaf": m} for n in (6, 12) for d in (2, 4, None) for m in (1, 5)]
    together = search_trees(spark, sample, options, 5, roc_auc, 42, 3)
    for place in (0, 5, 6, 9):
        assert np.allclose(search_trees(spark, sample, [options[place]], 5, roc_auc, 42, 3)[0], together[place])
    trees = [{"max_depth": d, "min_samples_leaf": m} for d in (1, 3, None) for m in (1, 10)]
    shared = search_trees(spark, sample, trees, 5, roc_auc, 42, bagged=False)
    assert np.allclose(search_trees(spark, sample, [trees[3]], 5, roc_auc, 42, bagged=False)[0], shared[3])
    assert 0.6 < min(map(np.mean, together)) and len({round(np.mean(s), 12) for s in together}) > 6


def test_search_scores_are_those_of_held_out_rows(spark, training):
    _, rows, edges, sample = training
    how = Boosting(5, 0.3, Limits(1.0, 1.0, depth=2))
    scores = search_boosted(spark, sample, [how, Boosting(1, 0.3, Limits(1.0, 1.0, depth=1))], 5)
    model = fit_boosted(rows.where("fold <> 2"), FEATURE_COLUMNS, edges, how)
    held = rows.where("fold = 2").toPandas()
    assert scores[0][2] == pytest.approx(roc_auc(held["label"].to_numpy(), model.ensemble.score(np.stack(held["vector"]))))
    assert np.mean(scores[0]) > np.mean(scores[1])


def test_forest_prefix_is_a_smaller_forest(spark, training):
    _, _, _, sample = training
    long, short = (fit_forest(spark, sample, FEATURE_COLUMNS, n, Limits(least_rows=2, depth=5), 42, 3).ensemble for n in (45, 30))
    for a, b in zip(long.trees, short.trees):
        assert (a.feature == b.feature).all() and (a.value == b.value).all()
    values = fit_forest(spark, sample, FEATURE_COLUMNS, 5, Limits(), 42, link="value")
    assert values.transform(training[0]).agg(F.count("prediction")).first()[0] == 600
    assert rmse(np.array([1.0, 3.0]), np.array([1.0, 1.0])) == pytest.approx(2**0.5)


def test_exact_attributions_add_up_and_survive_saving(spark, training, tmp_path):
    noisy, rows, edges, sample = training
    for model in (
        fit_boosted(rows, FEATURE_COLUMNS, edges, Boosting(20, 0.1, Limits(1.0, 1.0, depth=4))),
        fit_tree(rows, FEATURE_COLUMNS, edges, Limits(least_rows=10, depth=3)),
        fit_forest(spark, sample, FEATURE_COLUMNS, 10, Limits(least_rows=3), 42, 3),
    ):
        found = model.attributions(model.transform(noisy)).toPandas()
        raw = np.log(found["probability"] / (1 - found["probability"])) if model.ensemble.link == "log odds" else found["probability"]
        total = found["attributions"].map(lambda m: sum(m.values())) + found["expected"]
        assert np.allclose(total, raw, atol=1e-9)
        model.save(spark, str(tmp_path / "m"))
        again = TreeModel.load(spark, str(tmp_path / "m"))
        assert again.columns == tuple(FEATURE_COLUMNS)
        assert np.allclose(again.transform(noisy).toPandas()["probability"], found["probability"], atol=0)
        mean = found["attributions"].map(lambda m: abs(m["frequency"])).mean()
        assert mean > 2 * found["attributions"].map(lambda m: abs(m["return_rate"])).mean()


def test_newton_finds_the_penalised_maximum(training):
    noisy, *_ = training
    scaled = noisy.select(
        F.array(*[(F.col(c) - 1.5) / 1.2 for c in FEATURE_COLUMNS]).alias("vector"), F.col("churned").cast("double").alias("label"), "fold").cache()
    penalties, left_out = [100.0, 1.0, 0.1, 1.0], [-1, -1, 3, 3]
    found = newton(scaled, len(FEATURE_COLUMNS), penalties, left_out)
    held = scaled.toPandas()
    vectors = np.concatenate([np.stack(held["vector"]), np.ones((600, 1))], axis=1)
    for weights, penalty, fold in zip(found, penalties, left_out):
        inside = (held["fold"] != fold).to_numpy()
        chance = 1 / (1 + np.exp(-vectors[inside] @ weights))
        slope = vectors[inside].T @ (chance - held["label"].to_numpy()[inside]) + penalty * np.append(weights[:-1], 0)
        assert np.abs(slope).max() < 1e-6
    apart = newton(scaled.repartition(7), len(FEATURE_COLUMNS), [1.0], [-1])
    assert np.allclose(apart[0], found[1], atol=1e-8)


def test_one_look_up_scores_every_neighbour_setting(training):
    noisy, *_ = training
    options = [{"n_neighbors": k, "weights": w} for k in (5, 21) for w in ("uniform", "distance")]
    scores = neighbours.knn_grid_scores(noisy, FEATURE_COLUMNS, options, 5)
    for option, own in zip(options, scores):
        voted = neighbours.knn_classify(noisy.where("fold = 1"), noisy.where("fold <> 1"), FEATURE_COLUMNS, option["n_neighbors"], option["weights"])
        judged = voted.join(noisy.select("customer_id", "churned"), "customer_id").toPandas()
        assert own[1] == pytest.approx(roc_auc(judged["churned"].to_numpy(), judged["probability"].to_numpy()))


def test_a_failing_family_is_logged_and_the_others_go_on(planted):
    fitted, log = models.train_all(planted, {"boosted_trees": [{"learning_rate": "x"}], "logistic_regression": [{"C": 1.0}]})
    rows = {r["model"]: r for r in log.collect()}
    assert rows["boosted_trees"]["status"] == "failed" and "KeyError" in rows["boosted_trees"]["reason"]
    assert rows["logistic_regression"]["status"] == "trained" and set(fitted) == {"logistic_regression"}
