"""Operators against brute force, invariants and hot keys."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.functions import blocks
from retailscope.functions.ranks import average_percent_rank, cumulative_histogram, exact_quantiles, percent_ranks
from retailscope.operators import clean, density, explain, metrics, neighbours, prep, segment, validate
from retailscope.queries import explain as explain_queries
from retailscope.queries.inputs import feature_table, scored


def skewed_values(n=4000):
    """A third of all rows share one value; the rest are spread out, some negative."""
    generator = random.Random(7)
    return [(i, "ab"[i % 2], 5.0 if i % 3 == 0 else round(generator.uniform(-50, 50), 3)) for i in range(n)]


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(skewed_values(), "id bigint, k string, v double").repartition(5)


def test_percent_rank_equals_pandas(skewed):
    frame = pd.DataFrame(skewed_values(), columns=["id", "k", "v"]).set_index("id")
    wanted = frame["v"].rank(pct=True)
    got = percent_ranks(skewed, "id", ["v"]).toPandas().set_index("id")["v_rank"]
    assert (got.sort_index() - wanted.sort_index()).abs().max() == 0.0


def test_keyed_ranks_and_nulls(spark, skewed):
    with_nulls = skewed.withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("v")))
    frame = with_nulls.toPandas()
    frame["r"] = frame.groupby("k")["v"].rank(pct=True)
    ranked = cumulative_histogram(with_nulls, F.col("v"), ["k"]).withColumn("r", average_percent_rank())
    merged = frame.dropna().merge(ranked.toPandas(), left_on=["k", "v"], right_on=["k", "value"], suffixes=("", "_got"))
    assert len(merged) == frame["v"].notna().sum()
    assert (merged["r"] - merged["r_got"]).abs().max() < 1e-15


def test_quantiles_equal_pandas(skewed):
    frame = pd.DataFrame(skewed_values(), columns=["id", "k", "v"])
    got = {r["k"]: r for r in exact_quantiles(skewed, F.col("v"), {"a": 0.1, "b": 0.5, "c": 1.0}, ["k"]).collect()}
    for k, group in frame.groupby("k"):
        for name, p in (("a", 0.1), ("b", 0.5), ("c", 1.0)):
            assert got[k][name] == pytest.approx(group["v"].quantile(p), abs=1e-12)


def test_split_sizes_and_independence_from_partitioning(spark):
    rows = spark.range(10_000).select(F.col("id").alias("customer_id"), (F.col("id") % 4 == 0).cast("int").alias("churned"))
    one = prep.stratified_split(rows.repartition(1))
    seven = prep.stratified_split(rows.repartition(7))
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in seven.collect()}
    sizes = {(r["churned"], r["split"]): r["count"] for r in one.groupBy("churned", "split").count().collect()}
    assert sizes == {(1, "train"): 1750, (1, "val"): 375, (1, "test"): 375, (0, "train"): 5250, (0, "val"): 1125, (0, "test"): 1125}


def test_dedup_is_idempotent_and_order_free(spark):
    rows = spark.range(900).select(
        F.lit("A").alias("invoice"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("stock_code"),
        F.lit(None).cast("bigint").alias("customer_id"), F.lit(1).alias("quantity"),
        F.expr("TIMESTAMP_NTZ'2024-01-01'").alias("invoice_date"), F.lit(1).cast("decimal(12,2)").alias("price"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("source_sheet"), F.col("id").cast("string").alias("country"),
    )
    once = clean.deduplicate_transactions(rows)
    again = clean.deduplicate_transactions(once)
    assert once.count() == 601 and sorted(once.collect()) == sorted(again.collect())
    assert sorted(once.collect()) == sorted(clean.deduplicate_transactions(rows.repartition(9)).collect())
    hot = once.where("stock_code = 'HOT'").first()
    assert (hot["source_sheet"], hot["country"]) == ("A", "0")
    assert clean.duplicate_counts(rows).first().asDict() == {"n_before": 900, "n_kept": 601, "n_removed": 299}


def test_tidy_text_handles_odd_spaces(spark):
    rows = spark.createDataFrame([("  red \t  mug \n",)], "t string")
    assert rows.select(clean.tidy_text(F.col("t"))).first()[0] == "RED MUG"


def test_validation_raises_with_every_failure(spark):
    rows = spark.createDataFrame([(None, None)], "description string, customer_id bigint")
    with pytest.raises(ValueError, match="null_rate:customer_id"):
        validate.raise_if_failed(validate.validate_null_rates(rows, {"description": 0.02, "customer_id": 0.3}))
    with pytest.raises(ValueError, match="column:invoice"):
        validate.raise_if_failed(validate.run_validation(rows))


def test_auc_of_ties_and_single_class(spark):
    rows = spark.createDataFrame([(0, 0.1), (1, 0.1), (0, 0.2), (1, 0.9)], "churned int, p double")
    assert metrics.roc_auc(rows, "churned", "p").first()["roc_auc"] == pytest.approx((0.5 + 0 + 1 + 1) / 4)
    assert metrics.roc_auc(rows.where("churned = 1"), "churned", "p").first()["roc_auc"] is None


def cloud(n=700, seed=3):
    """Two dense blobs, a third of all rows as exact copies of one point, and scattered noise."""
    generator = np.random.default_rng(seed)
    points = np.concatenate([
        np.repeat([[0.1, 0.1, 0.1]], n // 3, axis=0),
        generator.normal(0.0, 0.25, (n // 3, 3)),
        generator.normal(4.0, 0.3, (n // 6, 3)),
        generator.uniform(-8, 8, (n // 6, 3)),
    ])
    return [(i, *map(float, p)) for i, p in enumerate(points)]


def brute_dbscan(rows, eps, min_samples):
    ids = [r[0] for r in rows]
    points = np.array([r[1:] for r in rows])
    near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    counts, core = near.sum(axis=1), near.sum(axis=1) >= min_samples
    cluster, current = np.full(len(ids), -1), 0
    for start in range(len(ids)):
        if not core[start] or cluster[start] != -1:
            continue
        todo = [start]
        cluster[start] = current
        while todo:
            at = todo.pop()
            for other in np.flatnonzero(near[at] & core & (cluster == -1)):
                cluster[other] = current
                todo.append(other)
        current += 1
    final = cluster.copy()
    for i in np.flatnonzero(~core):
        reached = cluster[near[i] & core]
        final[i] = reached.min() if len(reached) else -1
    return {i: (int(c), bool(k), int(f)) for i, c, k, f in zip(ids, counts, core, final)}


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_dbscan_equals_brute_force(spark, monkeypatch, block_rows):
    pack = density.pack
    monkeypatch.setattr(density, "pack", lambda *a, **k: pack(*a, **{**k, "rows": block_rows}))
    rows = cloud()
    frame = spark.createDataFrame(rows, "customer_id bigint, x double, y double, z double")
    got = density.dbscan(frame, ["x", "y", "z"], eps=0.4, min_samples=8, axes=(0, 1))
    found = {r["customer_id"]: (r["n_neighbours"], r["is_core"], r["cluster"]) for r in got.collect()}
    assert found == brute_dbscan(rows, 0.4, 8)
    assert len({f[2] for f in found.values()}) >= 3


def test_within_agrees_with_distances_to_the_last_bit():
    draw = np.random.default_rng(9)
    for spread, offset in ((1.0, 0.0), (1e-4, 1e5), (1e6, -3.0)):
        left, right = (np.round(draw.normal(offset, spread, (300, 12)), 3) for _ in range(2))
        right[:50] = left[:50] + draw.choice([0.0, spread], (50, 12))  # many pairs at equal distances
        exact = blocks.squared_distances(left, right)
        for limit in (0.0, float(np.median(exact)), float(exact[3, 3]), float(np.nextafter(exact[3, 3], -1)), 12 * spread**2):
            assert (blocks.within(left, right, limit) == (exact <= limit)).all()
    left[0, 0], right[1, 1] = np.nan, np.inf
    assert (blocks.within(left, right, 5.0) == (blocks.squared_distances(left, right) <= 5.0)).all()


def test_near_blocks_are_compared_by_one_product(monkeypatch):
    """A block pair of unequal points is settled without measuring each pair column by column."""
    def measured(left, right):
        raise AssertionError("all pairs were measured")

    monkeypatch.setattr(blocks, "squared_distances", measured)
    draw = np.random.default_rng(2)
    assert blocks.within(draw.normal(size=(64, 12)), draw.normal(size=(64, 12)), 9.0).any()


@pytest.mark.parametrize("block_rows", [1024, 32])
def test_neighbours_equal_brute_force(spark, monkeypatch, block_rows):
    pack = neighbours.pack
    monkeypatch.setattr(neighbours, "pack", lambda *a, **k: pack(*a, **{**k, "rows": block_rows}))
    rows = cloud(900, seed=5)
    frame = spark.createDataFrame(rows, "customer_id bigint, x double, y double, z double")
    asked, searched = frame.where("customer_id % 5 = 0"), frame.where("customer_id % 5 <> 0")
    got = neighbours.nearest_neighbours(asked, searched, "customer_id", ["x", "y", "z"], 7)
    found = {}
    for r in got.orderBy("id", "rank").collect():
        found.setdefault(r["id"], []).append(r["neighbour"])
    pool = [r for r in rows if r[0] % 5]
    for r in rows:
        if r[0] % 5 == 0:
            ranked = sorted((round(math.dist(r[1:], o[1:]), 9), o[0]) for o in pool)
            assert found[r[0]] == [o for _, o in ranked[:7]]


def test_distance_weights_favour_exact_matches(spark):
    near = spark.createDataFrame([(1, 10, 0.0), (1, 11, 0.5), (2, 10, 0.5), (2, 11, 1.0)], "id bigint, neighbour bigint, distance double")
    labels = spark.createDataFrame([(10, 1), (11, 0)], "customer_id bigint, churned int")
    votes = {r["customer_id"]: r["probability"] for r in neighbours.neighbour_vote(near, labels, "customer_id", "churned", "distance").collect()}
    assert votes[1] == 1.0 and votes[2] == pytest.approx(2 / 3)


def test_euclidean_silhouette_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    points = [(i, *draw.normal(size=2).tolist(), int(draw.integers(0, 3)) if i else 7) for i in range(150)] + [(900, 0.0, 0.0, -1)]
    df = spark.createDataFrame(points, "customer_id bigint, x double, y double, cluster int").repartition(3)
    kept = [p for p in points if p[3] != -1]
    values = []
    for own in kept:
        mean = {}
        for c in {p[3] for p in kept}:
            others = [math.dist(own[1:3], p[1:3]) for p in kept if p[3] == c and p[0] != own[0]]
            mean[c] = sum(others) / len(others) if others else None
        a, b = mean.pop(own[3]), min(mean.values())
        values.append(0.0 if a is None else (b - a) / max(a, b))
    row = segment.euclidean_silhouette(df, ["x", "y"]).first()
    assert row["silhouette"] == pytest.approx(sum(values) / len(values), abs=1e-12) and row["n_judged"] == 150 and row["standard_error"] == 0
    some = segment.euclidean_silhouette(df, ["x", "y"], judged=60).first()
    assert some["n_judged"] == 60 and 0 < some["standard_error"] < 0.1
    assert abs(some["silhouette"] - row["silhouette"]) < 4 * some["standard_error"]
    chosen = segment.find_optimal_k(df.drop("cluster"), ["x", "y"], (2, 3, 5), 2).collect()
    assert [r["k"] for r in chosen if r["is_best"]] == [max(chosen, key=lambda r: r["silhouette"])["k"]]


def test_clusters_without_a_partner_have_no_quality(spark):
    rows = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 0), (3, 9.0, -1)], "customer_id bigint, x double, cluster int")
    assert segment.davies_bouldin(rows, ["x"]).first()[0] is None
    assert segment.silhouette(rows, ["x"]).first()[0] is None
    assert segment.euclidean_silhouette(rows, ["x"]).first()["silhouette"] is None


@pytest.mark.parametrize("row, label", [
    ((-1, 10.0, 3.0, 300.0, 0.1), "Unclassified / noise (DBSCAN)"),
    ((0, None, 3.0, 300.0, 0.1), "Unclassified"),
    ((0, 200.0, 20.0, 900.0, 0.1), "Lapsed high-value"),
    ((0, 200.0, 20.0, 500.0, 0.1), "Lapsed low-value"),
    ((0, 100.0, 20.0, 900.0, 0.1), "Loyal high-value"),
    ((0, 100.0, 20.0, 100.0, 0.1), "High-frequency low-value"),
    ((0, 20.0, 2.0, 100.0, 0.1), "New / recently acquired"),
    ((0, 100.0, 5.0, 300.0, 0.6), "Seasonal gift shopper"),
    ((0, 200.0, 20.0, -5.0, None), "High-frequency low-value"),
    ((0, 100.0, 5.0, 300.0, None), "Steady mid-value shopper"),
])
def test_business_rules(spark, row, label):
    frame = spark.createDataFrame(
        [row], "cluster int, recency_days_mean double, frequency_mean double, monetary_total_mean double, seasonal_concentration_mean double"
    )
    assert frame.select(segment.business_label()).first()[0] == label


def test_sampled_attributions_add_up(spark, small):
    """Per customer the attributions sum to its score minus the mean score of the walks' starts."""
    rows = explain_queries.valid_features(spark, small)
    scorer = explain_queries.scorer(spark, small)
    background = explain.background_sample(rows, FEATURE_COLUMNS, size=1)
    start = scorer(spark.createDataFrame([(0, *background[0])], ["customer_id", *FEATURE_COLUMNS])).first()["probability"]
    sums = explain.sampled_attributions(rows, scorer, FEATURE_COLUMNS, background, permutations=3).groupBy("customer_id").agg(
        F.sum("attribution").alias("total")
    )
    scores = scored(spark, small).select("customer_id", "churn_probability")
    gap = sums.join(scores, "customer_id").select(F.max(F.abs(F.col("total") + start - F.col("churn_probability")))).first()[0]
    assert gap < 1e-9


def test_rows_to_score_are_dealt_over_tasks(spark, small, monkeypatch):
    """A small table in one partition becomes many rows to score, which do not stay in its one task."""
    monkeypatch.setattr(explain, "ROWS_SCORED", 5_000, raising=False)
    rows = explain_queries.valid_features(spark, small).limit(100).coalesce(1)
    score, parts = explain_queries.scorer(spark, small), []

    def scorer(table):
        parts.append(table.rdd.getNumPartitions())
        return score(table)

    background = explain.background_sample(rows, FEATURE_COLUMNS, size=2)
    assert explain.sampled_attributions(rows, scorer, FEATURE_COLUMNS, background, permutations=10).count() == 1200
    curves = explain.partial_dependence(rows.select(*FEATURE_COLUMNS), scorer, FEATURE_COLUMNS, grid_points=10)
    assert curves.count() == 120
    assert parts == [3, 3]


def test_surrogate_finds_the_linear_drivers(spark, small):
    """Around a row of a linear scorer the surrogate recovers the strongest weights and their signs."""
    table = feature_table(spark, small).limit(1)
    weights = {c: 0.0 for c in FEATURE_COLUMNS} | {"recency_days": 0.3, "frequency": -0.2}
    scaler = prep.fit_scaler(feature_table(spark, small), FEATURE_COLUMNS)
    spread = scaler.first()

    def linear(rows):
        total = F.lit(0.0)
        for c, w in weights.items():
            total = total + F.lit(w) * F.col(c).cast("double") / (spread[f"{c}_std"] or 1.0)
        return rows.withColumn("probability", total)

    top = explain.local_surrogate(table, linear, scaler, FEATURE_COLUMNS, samples=3000, top_n=2).orderBy("rank").collect()
    assert [r["feature"] for r in top] == ["recency_days", "frequency"]
    assert top[0]["weight"] == pytest.approx(0.3, abs=0.02) and top[1]["weight"] == pytest.approx(-0.2, abs=0.02)


def test_neighbour_searches_place_few_rows_at_a_time():
    import pandas as pd

    from retailscope.operators.neighbours import pieces

    frame = pd.DataFrame({"id": range(1300)})
    parts = list(pieces(iter([frame, frame.iloc[:0], frame.iloc[:5]])))
    assert [len(p) for p in parts] == [512, 512, 276, 5] and pd.concat(parts)["id"].tolist() == [*range(1300), *range(5)]
