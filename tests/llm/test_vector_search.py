import math

import numpy as np
import pytest
from pyspark.sql import types as T

from retailscope.llm import hnsw, vector_search
from retailscope.llm.hnsw import build, scaled
from retailscope.llm.vector_search import build_index, nearest_neighbours, search_index

SCHEMA = "vec_id bigint, embedding array<float>, label int, shard int, block string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 0.0) for i, v in rows], SCHEMA)


def plain(rows, queries, k):
    """Every distance, in double precision."""
    kept = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = set()
    for i, q in kept:
        if not queries(i):
            continue
        near = sorted((math.dist(q, v), j) for j, v in kept if j != i and len(v) == len(q))
        out |= {(i, rank, j, round(d, 9)) for rank, (d, j) in enumerate(near[:k], 1)}
    return out


def clustered(n, dim, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim))
    return (centres[draw.integers(0, 12, n)] + draw.normal(scale=0.2, size=(n, dim))).astype(np.float32)


def test_graph_finds_the_nearest():
    vectors = clustered(3000, 24, 1)
    graph = build(scaled(vectors.astype(np.float64), float(np.abs(vectors).max())))
    assert [len(layer) for layer in graph.layers] == [3000, 188, 12]
    for layer, links in enumerate(graph.layers):
        assert links.shape[1] == hnsw.DEGREE * (2 if layer == 0 else 1)
        assert links.max() < len(links) and not (links == np.arange(len(links))[:, None]).any()
        for own in links[:: max(1, len(links) // 50)]:
            assert len(set(own[own >= 0])) == (own >= 0).sum()
    found = graph.search(graph.vectors[:300], 64)
    hits = 0
    for i in range(300):
        exact = np.argsort(((vectors - vectors[i]) ** 2).sum(axis=1), kind="stable")[:10]
        hits += len(set(exact) & set(found[i]))
    assert hits / 3000 > 0.97


def test_every_node_is_found():
    """A far cluster that no link may reach is searched as strays."""
    vectors = np.concatenate([clustered(600, 8, 2), clustered(5, 8, 3) + 1000]).astype(np.float32)
    graph = build(vectors)
    for i in range(0, 605):
        assert i in graph.search(vectors[i : i + 1], 16)[0]


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "MAX_SHARD_ROWS", 500)
    monkeypatch.setattr(vector_search, "SHARD_BYTES", 500 * 16 * 8)
    vectors = clustered(2500, 16, 4)
    vectors[700:900] = vectors[700]  # a hot vector
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    points = table(spark, rows)
    index, shards = build_index(points)
    assert shards == 5 and index.count() == 5
    got = search_index(index, shards, points.where("vec_id % 50 = 0")).collect()
    wanted = plain(rows, lambda i: i % 50 == 0, 10)
    found = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got}
    assert len(found & wanted) / len(wanted) > 0.95 and len(got) == len(wanted)
    hot = {w for w in wanted if 700 <= w[0] < 900}
    assert hot <= found, "copies of a query's vector are told by id"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(clustered(60, 4, 5).tolist())] + [
        (100, None), (200, []), (300, [0.0, 0.0, -0.0, 0.0]), (400, [1.0, None, 0.0, 2.0]), (500, [nan, 1.0, 1.0, 1.0]), (600, [inf, 1.0, 1.0, 1.0]),
        (None, [1.0, 2.0, 3.0, 4.0]), (700, [1.0, 2.0]), (701, [1.0, -0.0]), (702, [1.0, 0.0]), (800, [1.0, 2.0, 3.0]),
        (0, clustered(60, 4, 5).tolist()[0]), (900, [3e38, 3e38, 1.0, 1.0]), (1000, [1e-30, 0.0, 0.0, 0.0]), (10, [9.0, 9.0, 9.0, 9.0]),
    ]
    got = nearest_neighbours(table(spark, rows), table(spark, rows).where("vec_id % 10 = 0")).collect()
    found = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got}
    single = [(i, np.float32(v).tolist() if v and None not in v else v) for i, v in rows]
    assert found == plain(single, lambda i: i % 10 == 0, 10)
    assert len(got) == len(found) and {r["query_id"] for r in got} & {100, 200, 300, 400, 500, 600, 800} == set()


def test_no_rows(spark):
    empty = table(spark, [])
    assert nearest_neighbours(empty, empty).count() == 0
    some = table(spark, [(1, [1.0, 0.0])])
    assert nearest_neighbours(some, some).count() == 0 and nearest_neighbours(empty, some).count() == 0
