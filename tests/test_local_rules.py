"""Local rules against a plain fit on the same draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailscope.operators import local_rules as L

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def training(spark):
    draw = np.random.default_rng(1)
    rows = [(i, float(draw.normal()), float(draw.integers(0, 2)), float(np.round(draw.exponential(3), 1))) for i in range(400)]
    return spark.createDataFrame(rows, "customer_id bigint, a double, b double, c double").cache()


def score(df):
    kept = [c for c in df.columns if c not in FEATURES]
    return df.select(*kept, *FEATURES, (1 / (1 + F.exp(-(F.col("a") - 0.2 * F.col("c") + 0.1)))).alias("probability"))


def test_bins_are_quartiles(training):
    bins = L.training_bins(training, FEATURES)
    table = training.toPandas()
    for own in bins:
        values = table[own.feature].to_numpy()
        assert own.cuts == pytest.approx(sorted(set(np.percentile(values, [25, 50, 75]).tolist())))
        places = np.searchsorted(own.cuts, values)
        for place in range(len(own.cuts) + 1):
            inside = values[places == place]
            assert own.share[place] == pytest.approx(len(inside) / 400)
            if len(inside):
                assert [own.mean[place], own.deviation[place], own.low[place], own.high[place]] == pytest.approx(
                    [inside.mean(), inside.std(), inside.min(), inside.max()])
    assert bins[0].rule(0) == f"a <= {bins[0].cuts[0]:.2f}" and bins[2].rule(3) == f"c > {bins[2].cuts[2]:.2f}"
    assert " < a <= " in bins[0].rule(1) and len(bins[1].cuts) == 2


def test_draws_stay_in_their_bins(training):
    bins = L.training_bins(training, FEATURES)
    rows, same = L.perturbed(bins, [0.3, 1.0, 2.0], (42, 7, 0), 4000, True)
    assert rows[0].tolist() == [0.3, 1.0, 2.0] and same[0].all()
    for column, (own, value) in enumerate(zip(bins, [0.3, 1.0, 2.0])):
        places = np.searchsorted(own.cuts, rows[1:, column])
        assert ((places == own.of(value)) == same[1:, column]).all()
        assert np.abs(np.bincount(places, minlength=len(own.share)) / 3999 - own.share).max() < 0.04


def test_weights_equal_a_plain_fit_on_the_same_draws(training):
    bins = L.training_bins(training, FEATURES)
    asked = training.where("customer_id < 3")
    got = {}
    for r in L.local_rules(asked.repartition(2), score, training, FEATURES, samples=1200, top_n=2).collect():
        got.setdefault(r["customer_id"], []).append(r)
    for own in asked.collect():
        instance = [own[f] for f in FEATURES]
        parts = [L.perturbed(bins, instance, (42, own["customer_id"], s), min(500, 1200 - s), s == 0) for s in (0, 500, 1000)]
        rows, same = (np.concatenate(p) for p in zip(*parts))
        near = np.exp(-(~same).sum(axis=1) / (0.75**2 * 3)) ** 0.5
        target = 1 / (1 + np.exp(-(rows[:, 0] - 0.2 * rows[:, 2] + 0.1)))

        def ridge(columns, penalty):
            x = same[:, columns].astype(float)
            mean_x, mean_y = near @ x / near.sum(), near @ target / near.sum()
            x, y = x - mean_x, target - mean_y
            return np.linalg.solve((x * near[:, None]).T @ x + penalty * np.eye(len(columns)), (x * near[:, None]).T @ y)

        used = sorted(np.argsort(-np.abs(ridge([0, 1, 2], 0.01)))[:2])
        wanted = sorted(zip(used, ridge(used, 1.0)), key=lambda p: -abs(p[1]))
        found = sorted(got[own["customer_id"]], key=lambda r: r["rank"])
        assert [r["feature"] for r in found] == [FEATURES[f] for f, _ in wanted]
        assert [r["weight"] for r in found] == pytest.approx([w for _, w in wanted], abs=1e-9)
        assert [r["rule"] for r in found] == [bins[f].rule(bins[f].of(instance[f])) for f, _ in wanted]
        assert "b" not in [r["feature"] for r in found], "the score does not read b"


def test_a_constant_feature_makes_no_rule(spark, training):
    flat = training.withColumn("b", F.lit(2.0))
    found = L.local_rules(flat.where("customer_id = 5"), score, flat, FEATURES, samples=600, top_n=3).collect()
    weights = {r["feature"]: r["weight"] for r in found}
    assert weights.get("b", 0.0) == pytest.approx(0.0, abs=1e-6) and np.isfinite(list(weights.values())).all()
