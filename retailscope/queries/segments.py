"""Segmentation queries over standardised features and affinities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.config import FEATURE_COLUMNS
from retailscope.operators import density, neighbours, segment
from retailscope.operators.prep import apply_scaler, fit_scaler, stratified_split
from retailscope.queries.inputs import CONFIG, feature_table, rounded, wide_features, written_once
from retailscope.queries.sqltext import (
    AFFINITY_COLUMNS, WIDE_COLUMNS, edge_sql, piece, scaler_piece, standard_sql, statement,
)

COLUMNS = FEATURE_COLUMNS + AFFINITY_COLUMNS
EPS, MIN_SAMPLES = 0.5, 10
GRID_AXES = (0, 2, 11)  # recency_days, monetary_total, engagement_score
NEIGHBOURS = 21
BAND = 25


def scaled_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """All feature and affinity columns, scaled over all customers."""
    table = wide_features(spark, folder)
    return apply_scaler(table, fit_scaler(table, COLUMNS), COLUMNS).select("customer_id", *COLUMNS)


def initial_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Engagement bands of 25 points, the starting partition of one assignment step."""
    bands = wide_features(spark, folder).select(
        "customer_id", F.least(F.floor(F.col("engagement_score") / BAND), F.lit(3)).cast("int").alias("cluster")
    )
    return scaled_matrix(spark, folder).join(bands, "customer_id")


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        start = initial_groups(spark, folder)
        return segment.assign_clusters(start.drop("cluster"), COLUMNS, segment.cluster_centroids(start, COLUMNS))

    return written_once("assigned-clusters", spark, folder, build)


def with_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(spark, folder).join(assigned(spark, folder).select("customer_id", "cluster"), "customer_id")


def segmentation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scaled_matrix(spark, folder))


def kmeans_assign(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(assigned(spark, folder).select("customer_id", "cluster", "squared_distance"))


def davies_bouldin(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segment.davies_bouldin(assigned(spark, folder), COLUMNS))


def silhouette(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segment.silhouette(assigned(spark, folder), COLUMNS))


def euclidean_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segment.euclidean_silhouette(assigned(spark, folder), COLUMNS).drop("standard_error"))


def segment_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segment.profile_segments(with_clusters(spark, folder)).drop("business_label"))


def segment_labels(spark: SparkSession, folder: str) -> DataFrame:
    return segment.profile_segments(with_clusters(spark, folder)).select("cluster", "business_label")


def segment_assign(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_clusters(spark, folder)
    return segment.segment_assignments(rows, segment.profile_segments(rows), "kmeans").drop("assigned_at")


def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    clusters = segment.run_kmeans(scaled_matrix(spark, folder), COLUMNS, k=7, n_init=10, seed=CONFIG.seed)
    return clusters.select("customer_id", "cluster")


def optimal_k(spark: SparkSession, folder: str) -> DataFrame:
    return segment.find_optimal_k(scaled_matrix(spark, folder), COLUMNS, CONFIG.segment_counts, n_init=10)


def scaled_features_only(spark: SparkSession, folder: str) -> DataFrame:
    table = feature_table(spark, folder)
    return apply_scaler(table, fit_scaler(table, FEATURE_COLUMNS), FEATURE_COLUMNS).select(
        "customer_id", *FEATURE_COLUMNS
    )


def dbscan_core(spark: SparkSession, folder: str) -> DataFrame:
    return density.dbscan_core(scaled_features_only(spark, folder), FEATURE_COLUMNS, EPS, MIN_SAMPLES, axes=GRID_AXES)


def dbscan(spark: SparkSession, folder: str) -> DataFrame:
    return density.dbscan(scaled_features_only(spark, folder), FEATURE_COLUMNS, EPS, MIN_SAMPLES, axes=GRID_AXES)


def knn_vote(spark: SparkSession, folder: str) -> DataFrame:
    """Share of churned among the 21 nearest training customers of every test customer."""
    tagged = stratified_split(feature_table(spark, folder))
    train = tagged.where(F.col("split") == "train")
    scaler = fit_scaler(train, FEATURE_COLUMNS)
    scaled = apply_scaler(tagged, scaler, FEATURE_COLUMNS)
    votes = neighbours.knn_classify(
        scaled.where(F.col("split") == "test"), scaled.where(F.col("split") == "train"), FEATURE_COLUMNS, NEIGHBOURS
    )
    return rounded(votes)


QUERIES = {
    "segmentation_matrix": segmentation_matrix,
    "kmeans_assign": kmeans_assign,
    "davies_bouldin": davies_bouldin,
    "silhouette": silhouette,
    "euclidean_silhouette": euclidean_silhouette,
    "segment_profiles": segment_profiles,
    "segment_labels": segment_labels,
    "segment_assign": segment_assign,
    "kmeans": kmeans,
    "optimal_k": optimal_k,
    "dbscan_core": dbscan_core,
    "dbscan": dbscan,
    "knn_vote": knn_vote,
}

scaler_piece("wide_scaler", ("wide",), "wide", WIDE_COLUMNS)
piece("matrix", ("wide", "wide_scaler"), "SELECT customer_id, engagement_score AS raw_engagement, " + ", ".join(
    f"{standard_sql(c)} AS z_{c}" for c in WIDE_COLUMNS) + " FROM wide, wide_scaler")
piece("start_centroids", ("matrix",), f"""
    SELECT least(CAST(floor(raw_engagement / {BAND}) AS INTEGER), 3) AS cluster, """ + ", ".join(
    f"avg(z_{c}) AS c_{c}" for c in WIDE_COLUMNS) + " FROM matrix GROUP BY 1")
GAP = " + ".join(f"(z_{c} - c_{c}) * (z_{c} - c_{c})" for c in WIDE_COLUMNS)
PAIR_GAP = " + ".join(f"(x.z_{c} - y.z_{c}) * (x.z_{c} - y.z_{c})" for c in WIDE_COLUMNS)
piece("assigned", ("matrix", "start_centroids"), f"""
    SELECT matrix.*, cluster, {GAP} AS gap FROM matrix, start_centroids
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY gap, cluster) = 1""")
piece("centroids", ("assigned",), "SELECT cluster, count(*) AS n, " + ", ".join(
    f"avg(z_{c}) AS c_{c}" for c in WIDE_COLUMNS)
    + ", avg(" + " + ".join(f"z_{c} * z_{c}" for c in WIDE_COLUMNS) + ") AS mean_norm FROM assigned GROUP BY cluster")
piece("scatter", ("assigned", "centroids"), f"""
    SELECT cluster, avg(sqrt({GAP})) AS s FROM assigned JOIN centroids USING (cluster) GROUP BY cluster""")
NORM = " + ".join(f"z_{c} * z_{c}" for c in WIDE_COLUMNS)
INNER = " + ".join(f"z_{c} * c_{c}" for c in WIDE_COLUMNS)
PAIR = " + ".join(f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in WIDE_COLUMNS)

PROFILED = ("recency_days", "frequency", "monetary_total", "engagement_score", "return_rate", "seasonal_concentration")
piece("profiles", ("features", "assigned"), "SELECT cluster, " + ", ".join(
    f"avg({c}) AS {c}_mean, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_median, count({c}) AS {c}_count"
    for c in PROFILED) + " FROM features JOIN (SELECT customer_id, cluster FROM assigned) USING (customer_id) GROUP BY cluster")
piece("labels_by_cluster", ("profiles",), """
    SELECT cluster, CASE
        WHEN cluster = -1 THEN 'Unclassified / noise (DBSCAN)'
        WHEN recency_days_mean IS NULL OR frequency_mean IS NULL OR monetary_total_mean IS NULL THEN 'Unclassified'
        WHEN recency_days_mean > 180 AND monetary_total_mean > 500 THEN 'Lapsed high-value'
        WHEN recency_days_mean > 180 AND monetary_total_mean > 0 THEN 'Lapsed low-value'
        WHEN frequency_mean > 10 AND monetary_total_mean > 500 THEN 'Loyal high-value'
        WHEN frequency_mean > 10 AND monetary_total_mean < 200 THEN 'High-frequency low-value'
        WHEN recency_days_mean < 30 AND frequency_mean <= 2 THEN 'New / recently acquired'
        WHEN seasonal_concentration_mean > 0.5 THEN 'Seasonal gift shopper'
        ELSE 'Steady mid-value shopper' END AS business_label
    FROM profiles""")
piece("points", ("features", "full_scaler"), "SELECT customer_id, " + ", ".join(
    f"{standard_sql(c)} AS z_{c}" for c in FEATURE_COLUMNS) + " FROM features, full_scaler")
NEAR = " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in FEATURE_COLUMNS)
scaler_piece("train_scaler_all", ("features", "splits"),
             "features JOIN (SELECT customer_id FROM splits WHERE split = 'train') USING (customer_id)", FEATURE_COLUMNS)
piece("split_points", ("features", "splits", "train_scaler_all"), "SELECT customer_id, features.churned, split, " + ", ".join(
    f"{standard_sql(c)} AS z_{c}" for c in FEATURE_COLUMNS)
    + " FROM features JOIN (SELECT customer_id, split FROM splits) USING (customer_id), train_scaler_all")

SQL = {
    "segmentation_matrix": statement(("matrix",), "SELECT customer_id, " + ", ".join(
        f"{edge_sql(f'z_{c}')} AS {c}" for c in WIDE_COLUMNS) + " FROM matrix"),
    "kmeans_assign": statement(("assigned",), """
        SELECT customer_id, cluster, round(gap, 6) AS squared_distance FROM assigned"""),
    "davies_bouldin": statement(("centroids", "scatter"), f"""
        SELECT round(avg(worst), 6) AS davies_bouldin_index
        FROM (SELECT a.cluster, max((sa.s + sb.s) / sqrt({PAIR})) AS worst
              FROM centroids a JOIN scatter sa ON a.cluster = sa.cluster, centroids b JOIN scatter sb ON b.cluster = sb.cluster
              WHERE a.cluster <> b.cluster GROUP BY a.cluster)"""),
    "euclidean_silhouette": statement(("assigned",), f"""
        SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n_judged
        FROM (SELECT customer_id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
                     min(CASE WHEN own <> other THEN total / n END) AS b
              FROM (SELECT x.customer_id, x.cluster AS own, y.cluster AS other, sum(sqrt({PAIR_GAP})) AS total, count(*) AS n
                    FROM assigned x, assigned y GROUP BY ALL) GROUP BY customer_id)"""),
    "silhouette": statement(("assigned", "centroids"), f"""
        SELECT round(avg(CASE WHEN own_n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette_squared
        FROM (SELECT customer_id, max(n) FILTER (own) AS own_n, min(d) FILTER (NOT own) AS b,
                     max(d * n / (n - 1)) FILTER (own) AS a
              FROM (SELECT customer_id, centroids.cluster = assigned.cluster AS own, n,
                           ({NORM}) + mean_norm - 2 * ({INNER}) AS d FROM assigned, centroids)
              GROUP BY customer_id)"""),
    "segment_profiles": statement(("profiles",), "SELECT cluster, " + ", ".join(
        f"round({c}_mean, 6) AS {c}_mean, round({c}_median, 6) AS {c}_median, {c}_count" for c in PROFILED)
        + " FROM profiles"),
    "segment_labels": statement(("labels_by_cluster",), "SELECT cluster, business_label FROM labels_by_cluster"),
    "segment_assign": statement(("assigned", "labels_by_cluster"), """
        SELECT customer_id, cluster AS cluster_id, business_label, 'kmeans' AS algorithm
        FROM (SELECT customer_id, cluster FROM assigned) LEFT JOIN labels_by_cluster USING (cluster)"""),
    "dbscan_core": statement(("points",), f"""
        SELECT a.customer_id, count(*) AS n_neighbours, count(*) >= {MIN_SAMPLES} AS is_core
        FROM points a, points b WHERE {NEAR} <= {EPS * EPS} GROUP BY a.customer_id"""),
    "knn_vote": statement(("split_points",), f"""
        SELECT customer_id, round(avg(CAST(label AS DOUBLE)), 6) AS probability
        FROM (SELECT a.customer_id, b.churned AS label FROM split_points a, split_points b
              WHERE a.split = 'test' AND b.split = 'train'
              QUALIFY row_number() OVER (PARTITION BY a.customer_id
                      ORDER BY round(sqrt({NEAR}), 9), b.customer_id) <= {NEIGHBOURS})
        GROUP BY customer_id"""),
}
