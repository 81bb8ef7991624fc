"""Density clustering (DBSCAN) by boxes of points that lie together, and label propagation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailscope.functions.blocks import pack  # noqa: F401  (a name that tests set)
from retailscope.functions.boxes import (
    ASKED_AT_ONCE, SLICE_ROWS, TILE_BOXES, Boxes, boxed, gaps, is_empty, matrix, slices,
)
from retailscope.functions.ranks import cumulative_histogram
from retailscope.operators.neighbours import vectors
from retailscope.sources.shared import materialize

NOISE = -1
EDGES_AT_ONCE = 1 << 21  # links a task gathers before it thins them
PAIRS_PER_POINT = 4  # near pairs of a box that stay as they are


def distinct_points(df: DataFrame, row_id: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Collapse identical vectors into weighted points named by their smallest id.

    Copies of one vector, however many, become a single point; the second table maps rows to points.
    """
    rows = vectors(df, row_id, columns)
    points = rows.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    members = rows.withColumnRenamed("id", "row_id").join(points.select("vector", "id"), "vector")
    return points, members.select("row_id", "id")


def tiled(points: DataFrame, row_id: str = "id") -> DataFrame:
    """The points written so that a partition holds neighbours. Tiles come from some of the points; they steer the cost, not the result."""
    spark = points.sparkSession
    part = next(slices(points.select(row_id, "vector"), row_id))
    if is_empty(part):
        return points
    low, high = Boxes(**part["boxes"]).together(TILE_BOXES)
    middle, axes, columns = part["boxes"]["middle"], part["boxes"]["axes"], points.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = (matrix(batch.column("vector"), batch.num_rows) - middle) @ axes
            tile = [gaps(asked[i : i + ASKED_AT_ONCE], low, high).argmin(axis=1) for i in range(0, batch.num_rows, ASKED_AT_ONCE)]
            tiles = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *tile]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, tiles], [*columns, "tile"])

    schema = T.StructType([*points.schema.fields, T.StructField("tile", T.IntegerType())])
    placed = points.mapInArrow(place, schema).repartitionById(len(low), F.col("tile"))
    return materialize(placed.drop("tile"), "tiled-points")


def beside(asked: DataFrame, others: DataFrame, eps: float, work, schema: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``work(ids, slice, near pairs)`` for every batch of ``asked`` and slice of ``others``; it yields columns of ``schema``.

    Near pairs come as (rows of the batch, points of the slice, which of them are within ``eps``), a box at a time.
    """
    context, limit = asked.sparkSession.sparkContext, eps * eps
    names = [part.split()[0] for part in schema.split(",")]

    def against(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            boxes = None
            for batch in batches:
                boxes = boxes or Boxes(**sent.value["boxes"])
                vectors = matrix(batch.column("vector"), batch.num_rows)
                ids, order = batch.column("id").to_numpy(), boxed(vectors)["order"]
                pairs = (
                    (order[i + rows], at, near) for i in range(0, len(order), ASKED_AT_ONCE)
                    for rows, at, near in boxes.within(vectors[order[i : i + ASKED_AT_ONCE]], limit))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in work(ids, sent.value, pairs)], names)

        return run

    found = None
    for part in slices(others, "id", slice_rows):
        own = asked.select("id", "vector").mapInArrow(against(context.broadcast(part)), schema)
        found = own if found is None else found.unionByName(own)
    return found


def neighbour_counts(points: DataFrame, eps: float, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Points with the number of rows within ``eps``, the point itself included."""

    def count(ids, others, pairs):
        total = np.zeros(len(ids))
        for rows, at, near in pairs:
            # counts of rows are whole numbers far below 2 ** 53, which a product of doubles adds up exactly
            total[rows] += near.astype("float64") @ others["weight"][at].astype("float64")
        return ids, total.astype("int64")

    partial = beside(points, points.select("id", "vector", "weight"), eps, count, "id bigint, n bigint", slice_rows)
    return points.join(partial.groupBy("id").agg(F.sum("n").alias("n_neighbours")), "id")


def core_links(cores: DataFrame, eps: float, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Edges that connect what a batch of points and a slice connect: a spanning forest, not their pairs."""

    def link(ids, others, pairs):
        found, count = [(np.zeros(0, dtype=np.int64),) * 2], 0
        for rows, at, near in pairs:
            found.append(edges_of(ids[rows], others["id"][at], near))
            count += len(found[-1][0])
            if count > EDGES_AT_ONCE:
                found, count = [forest(*(np.concatenate(side) for side in zip(*found)))], 0
        return forest(*(np.concatenate(side) for side in zip(*found)))

    return beside(cores, cores.select("id", "vector"), eps, link, "a bigint, b bigint", slice_rows).distinct()


def edges_of(left: np.ndarray, right: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that connect what ``near`` connects: the near pairs themselves, or a forest of what would be many."""
    rows, columns = np.nonzero(near)
    if len(rows) <= PAIRS_PER_POINT * sum(near.shape):
        return left[rows], right[columns]
    return forest(left[rows], right[columns])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each id to the smallest id that these pairs connect it with."""
    ids, ranks = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, u, v = np.arange(len(ids)), ranks[: len(a)], ranks[len(a) :]
    while True:
        low = np.minimum(label[u], label[v])
        grown = label.copy()
        np.minimum.at(grown, label[u], low)
        np.minimum.at(grown, label[v], low)
        while True:
            hop = grown[grown]
            if (hop == grown).all():
                break
            grown = hop
        if (grown == label).all():
            break
        label = grown
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def connected_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id of every node's component.

    Each round takes the smallest label next door and then the label of that label, which halves the
    remaining distance; rounds are written to the shared folder so lineage stays short.
    """
    both = materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = materialize(nodes.select("id", F.col("id").alias("label")), "labels")
    while True:
        named = labels.select(F.col("id").alias("b"), F.col("label").alias("offer"))
        offers = both.join(named, "b").groupBy("a").agg(F.min("offer").alias("offer"))
        nearer = labels.join(offers, F.col("id") == F.col("a"), "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("near")
        )
        hops = labels.select(F.col("id").alias("near"), F.col("label").alias("hop"))
        moved = materialize(nearer.join(hops, "near").select("id", "old", F.least("near", "hop").alias("label")), "labels")
        labels = moved.select("id", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def dbscan(
    df: DataFrame, columns: Sequence[str], eps: float = 0.5, min_samples: int = 10,
    row_id: str = "customer_id", axes: Sequence[int] = (0, 1, 2),
) -> DataFrame:
    """(row_id, n_neighbours, is_core, cluster): clusters numbered by their smallest core id, noise -1.

    A border row joins the lowest-numbered cluster that reaches it. ``axes`` has no effect: boxes follow
    the axes along which the points spread most.
    """
    points, members = distinct_points(df, row_id, columns)
    counted = materialize(neighbour_counts(tiled(materialize(points, "points")), eps), "counted")
    cores = tiled(counted.where(F.col("n_neighbours") >= min_samples))
    labels = connected_labels(cores, core_links(cores, eps))
    numbered = cumulative_histogram(
        labels.select("label").distinct(), F.col("label")
    ).select(F.col("value").alias("label"), F.col("below").alias("cluster"))
    core_clusters = materialize(labels.join(numbered, "label").select("id", "cluster"), "core-clusters")
    known = materialize(
        counted.join(core_clusters, "id", "left").withColumn("cluster", F.coalesce("cluster", F.lit(NOISE))), "known"
    )

    def adopt(ids, others, pairs):
        none = np.iinfo(np.int64).max
        best = np.full(len(ids), none)
        for rows, at, near in pairs:
            best[rows] = np.minimum(best[rows], np.where(near, others["cluster"][at][None, :], none).min(axis=1))
        hit = best < none
        return ids[hit], best[hit]

    # only rows without a cluster ask, and only those with one answer
    clustered = known.where(F.col("cluster") != NOISE).select("id", "vector", F.col("cluster").cast("bigint").alias("cluster"))
    offers = beside(known.where(F.col("cluster") == NOISE), clustered, eps, adopt, "id bigint, offer bigint")
    adopted = offers.groupBy("id").agg(F.min("offer").alias("offer"))
    final = known.join(adopted, "id", "left").select(
        "id", "n_neighbours", (F.col("n_neighbours") >= min_samples).alias("is_core"),
        F.when(F.col("cluster") != NOISE, F.col("cluster")).otherwise(F.coalesce("offer", F.lit(NOISE))).alias("cluster"),
    )
    return members.join(final, "id").select(F.col("row_id").alias(row_id), "n_neighbours", "is_core", "cluster")


def dbscan_core(
    df: DataFrame, columns: Sequence[str], eps: float = 0.5, min_samples: int = 10,
    row_id: str = "customer_id", axes: Sequence[int] = (0, 1, 2),
) -> DataFrame:
    """(row_id, n_neighbours, is_core) without the clustering that follows."""
    points, members = distinct_points(df, row_id, columns)
    counted = neighbour_counts(tiled(materialize(points, "points")), eps)
    return members.join(counted, "id").select(
        F.col("row_id").alias(row_id), "n_neighbours", (F.col("n_neighbours") >= min_samples).alias("is_core")
    )
