"""Approximate nearest neighbours: a small-world graph for each shard of the vectors, shard results merged.

Rows are dealt to shards by hash, so copies of one vector spread over all shards; within a shard equal vectors
are one node that knows its ids. Graphs are written as a table of flat arrays. Queries meet every shard's graph
in blocks of bounded size; what leaves a task are the nearest few of each query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailscope.llm.common import only_named
from retailscope.llm.hnsw import Graph, build, scaled
from retailscope.sources.shared import materialize

NEIGHBOURS = 10
SEARCH_BEAM = 96
SHARD_BYTES = 16 << 20  # vectors of a shard or a block of queries, at eight bytes a component
MAX_SHARD_ROWS = 1 << 17
SHARD_GROWTH = 16  # a shard holds so many times the square root of all rows
SEARCH_CELLS = 1 << 22  # components of candidates measured at once
INDEX = (
    "dim int, shard int, sizes array<int>, links binary, strays binary, vectors binary, starts binary, ids binary, scale double"
)


def usable(vector: Column) -> Column:
    """Vectors with finite components only, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Distinct (vec_id, vector) that take part."""
    rows = only_named(df, vec_id=id_column, vector=vector_column)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    """The graph of one shard: equal vectors become one node, nodes are numbered in random order."""
    dim, shard = (k.as_py() for k in key)
    ids, given = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"), dim) + 0.0  # -0.0 becomes 0.0
    order = np.argsort(ids, kind="stable")
    ids, given = ids[order], given[order]
    _, first, node = np.unique(given.view(f"V{8 * dim}").reshape(-1), return_index=True, return_inverse=True)
    shuffled = np.random.default_rng([dim, shard]).permutation(np.argsort(np.argsort(first)))
    node = shuffled[node]
    nodes = np.empty((len(first), dim))
    nodes[node] = given
    by_node = np.argsort(node, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(node))])
    scale = float(np.abs(nodes).max())
    graph = build(scaled(nodes, scale))
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
        "sizes": pa.array([[len(layer) for layer in graph.layers]], pa.list_(pa.int32())),
        "links": [b"".join(layer.tobytes() for layer in graph.layers)], "strays": [graph.strays.tobytes()],
        "vectors": [nodes.tobytes()], "starts": [starts.astype(np.int64).tobytes()], "ids": [ids[by_node].tobytes()], "scale": [scale],
    })


def opened(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, vectors, starts, ids) as ``build_shard`` wrote them."""
    vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    flat, layers, at = np.frombuffer(row["links"], dtype=np.int32), [], 0
    total = sum(row["sizes"])
    base = len(flat) // (total + row["sizes"][0])  # the lowest layer has twice the links
    for layer, size in enumerate(row["sizes"]):
        width = base * (2 if layer == 0 else 1)
        layers.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    graph = Graph(scaled(vectors, row["scale"]), layers, np.frombuffer(row["strays"], dtype=np.int32))
    return graph, vectors, np.frombuffer(row["starts"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)


def nearest_ids(found: np.ndarray, vectors, starts, ids, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest rows among the nodes found, but for the query's own id."""
    found = np.unique(found[found >= 0])
    apart = np.sqrt(((vectors[found] - query) ** 2).sum(axis=1))
    held = [ids[starts[n] : starts[n + 1]][: k + 1] for n in found]
    named = np.concatenate(held)
    measured = np.repeat(apart, [len(h) for h in held])
    named, measured = named[named != own], measured[named != own]
    best = np.lexsort((named, measured))[:k]
    return named[best], measured[best]


def build_index(points: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, int]:
    """(index, number of shards): the written table of graphs over all rows that take part."""
    rows = vectors_of(points, id_column, vector_column)
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    held = min(MAX_SHARD_ROWS, max(1, SHARD_BYTES // (8 * (dim or 1))), math.ceil(SHARD_GROWTH * math.sqrt(n)) or 1)
    shards = max(1, -(-n // held))
    dealt = rows.dropDuplicates(["vec_id", "vector"]).withColumns({
        "dim": F.size("vector"), "shard": F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")})
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(build_shard, INDEX), "vector-index"), shards


def search_index(
    index: DataFrame, shards: int, queries: DataFrame, k: int = NEIGHBOURS, beam: int = SEARCH_BEAM,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, see ``nearest_neighbours``."""
    asked = vectors_of(queries, id_column, vector_column).dropDuplicates(["vec_id", "vector"])
    n, dim = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    blocks = max(1, -(-n * 8 * (dim or 1) // SHARD_BYTES))
    asked = asked.withColumns({
        "dim": F.size("vector"), "block": F.pmod(F.xxhash64("vector", "vec_id"), F.lit(blocks)).cast("int"),
        "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))})
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search_block(key: tuple, graph: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if graph.num_rows and rows.num_rows:
            dim = key[0].as_py()
            opened_graph, vectors, starts, ids = opened(graph.to_pylist()[0])
            scale = graph.column("scale")[0].as_py()
            own, asked = rows.column("vec_id").to_pylist(), matrix(rows.column("vector"), dim)
            at_once = max(1, min(256, SEARCH_CELLS // (4 * 32 * dim)))
            for start in range(0, len(own), at_once):
                found = opened_graph.search(scaled(asked[start : start + at_once], scale), max(beam, k + 1))
                for i, near in enumerate(found, start):
                    named, apart = nearest_ids(near, vectors, starts, ids, asked[i], own[i], k)
                    out.append((np.full(len(named), i), named, apart))
        place, named, apart = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({
            "query_id": rows.column("vec_id").take(pa.array(place)), "query": rows.column("query").take(pa.array(place)),
            "vec_id": named, "score": apart,
        })

    keys = ["dim", "shard", "block"]
    found = (
        graphs.groupBy(*keys).cogroup(asked.withColumn("query", F.xxhash64("vector")).groupBy(*keys))
        .applyInArrow(search_block, "query_id bigint, query bigint, vec_id bigint, score double")
    )
    nearest = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    points: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, beam: int = SEARCH_BEAM,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of ``points`` found nearest, its own id left out.

    ``score`` is the Euclidean distance in double precision; equal ones are ranked by id. Rows without an id,
    and vectors that are null, empty, zero or hold null or non-finite components, take no part, neither as
    queries nor as results. Vectors are compared with those of their own length. Rows that repeat an id and a
    vector count once; an id with several vectors is found by each of them, and each is a query. A query with
    fewer candidates than k has fewer rows, one with none has no row. Every row is indexed; ``beam`` trades
    time for recall.
    """
    index, shards = build_index(points, id_column, vector_column)
    return search_index(index, shards, queries, k, beam, id_column, vector_column)
