"""A hierarchical navigable small-world graph over the vectors of one shard, as flat neighbour arrays.

Nodes are numbered so that a layer holds the first ``sizes[layer]`` of them; a layer's links are one array with
a row of neighbours for each node, -1 where there are fewer. All steps run for many vectors at once: searches
keep their beams side by side, and nodes are inserted in batches that also see each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 16  # links a new node makes, and has at most in upper layers; twice as many in the lowest
BEAM = 64  # candidates kept while a node is inserted
FIRST = 128  # nodes that start a layer, compared with each other
BATCH = 256
STEP = 4  # nodes of a beam that are opened at once
FARTHEST = 1e17  # no component may leave what squares of single precision can hold


def scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    """Vectors as the graph sees them; distances that count are measured on the given ones."""
    return np.clip(vectors / scale, -FARTHEST, FARTHEST).astype(np.float32)


def distances(vectors: np.ndarray, squares: np.ndarray, nodes: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query from its row of nodes, infinite for -1."""
    products = np.matmul(vectors[nodes], queries[:, :, None])[:, :, 0]
    apart = squares[nodes] - 2 * products + np.einsum("qd,qd->q", queries, queries)[:, None]
    return np.where(nodes >= 0, np.maximum(apart, 0), np.inf)


def without_twins(nodes: np.ndarray) -> np.ndarray:
    """Rows of node numbers, sorted, with -1 for repeats."""
    nodes = np.sort(nodes, axis=1)
    nodes[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -1
    return nodes


def nearest_first(nodes: np.ndarray, apart: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(apart, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(apart, order, axis=1)


def search_layer(vectors, squares, links, queries, seeds, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that each query finds from its seeds, nearest first, and their distances."""
    rows = np.arange(len(queries))
    seen = np.zeros((len(queries), len(links) + 1), dtype=bool)  # the last column is -1
    nodes = without_twins(seeds)
    seen[rows[:, None], nodes] = True
    nodes, apart = nearest_first(nodes, distances(vectors, squares, nodes, queries), beam)
    opened = ~np.isfinite(apart)
    while True:
        waiting = np.where(opened, np.inf, apart)
        live = np.flatnonzero(np.isfinite(waiting.min(axis=1)))
        if not len(live):
            return nodes, apart
        width = min(STEP, nodes.shape[1])
        place = np.argpartition(waiting[live], width - 1, axis=1)[:, :width]
        ready = np.isfinite(np.take_along_axis(waiting[live], place, axis=1))
        opened[live[:, None], place] = True
        near = links[np.where(ready, nodes[live[:, None], place], -1)]
        near[~ready] = -1
        near = without_twins(near.reshape(len(live), -1))
        near[seen[live[:, None], near]] = -1
        seen[live[:, None], near] = True
        found = distances(vectors, squares, near, queries[live])
        both = np.concatenate([apart[live], found], axis=1)
        if nodes.shape[1] < beam and len(live) < len(queries):  # beams still grow: keep all rows of one width
            live, near, found, both = widened(live, near, found, apart, len(queries))
        keep = min(beam, both.shape[1])
        order = np.argpartition(both, keep - 1, axis=1)[:, :keep] if keep < both.shape[1] else np.tile(np.arange(keep), (len(live), 1))
        merged = np.take_along_axis(np.concatenate([nodes[live], near], axis=1), order, axis=1)
        done = np.take_along_axis(np.concatenate([opened[live], ~np.isfinite(found)], axis=1), order, axis=1)
        closest = np.take_along_axis(both, order, axis=1)
        if len(live) == len(queries):
            nodes, apart, opened = merged, closest, done
        else:
            nodes[live], apart[live], opened[live] = merged, closest, done


def widened(live, near, found, apart, total):
    """The same step for all queries: those that are done find nothing."""
    all_near = np.full((total, near.shape[1]), -1, dtype=near.dtype)
    all_found = np.full((total, near.shape[1]), np.inf, dtype=found.dtype)
    all_near[live], all_found[live] = near, found
    return np.arange(total), all_near, all_found, np.concatenate([apart, all_found], axis=1)


def spread(vectors, squares, nodes, apart, most: int) -> np.ndarray:
    """Of candidates, nearest first, those nearer to the centre than to one already taken; then the nearest others."""
    own = vectors[nodes]
    between = squares[nodes][:, :, None] + squares[nodes][:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    usable = np.isfinite(apart)
    taken = np.zeros(nodes.shape, dtype=bool)
    for place in range(nodes.shape[1]):
        closest = np.where(taken, between[:, place, :], np.inf).min(axis=1)
        taken[:, place] = usable[:, place] & (apart[:, place] < closest) & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(usable, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    chosen = np.where(np.take_along_axis(usable, order, axis=1), np.take_along_axis(nodes, order, axis=1), -1)
    return np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)


def link_back(vectors, squares, links, new: np.ndarray) -> None:
    """Give the neighbours of new nodes links to them; a node with too many keeps a spread of them."""
    degree = links.shape[1]
    source = np.repeat(new, degree)
    target = links[new].reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    apart = squares[source] + squares[target] - 2 * np.einsum("ed,ed->e", vectors[source], vectors[target])
    order = np.lexsort((source, apart, target))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    place = np.arange(len(target)) - np.repeat(first, np.diff(first, append=len(target)))
    near = place < degree
    centres = target[first]
    row = np.repeat(np.arange(len(centres)), np.diff(first, append=len(target)))
    coming = np.full((len(centres), degree), -1, dtype=links.dtype)
    coming[row[near], place[near]] = source[near]
    nodes = without_twins(np.concatenate([links[centres], coming], axis=1))
    nodes, apart = nearest_first(nodes, distances(vectors, squares, nodes, vectors[centres]), 2 * degree)
    full = np.isfinite(apart[:, degree]) if apart.shape[1] > degree else np.zeros(len(centres), dtype=bool)
    links[centres[~full]] = np.where(np.isfinite(apart[~full, :degree]), nodes[~full, :degree], -1)
    for start in range(0, full.sum(), BATCH):
        part = np.flatnonzero(full)[start : start + BATCH]
        links[centres[part]] = spread(vectors, squares, nodes[part], apart[part], degree)


@dataclass
class Graph:
    """Layers from the lowest up; ``strays`` are nodes that no path from the first node reaches."""

    vectors: np.ndarray
    layers: list[np.ndarray]
    strays: np.ndarray

    def __post_init__(self):
        self.squares = np.einsum("nd,nd->n", self.vectors, self.vectors)

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Nodes of layer ``to`` from which to search: the best few of the layers above, and the first."""
        seeds = np.zeros((len(queries), 1), dtype=np.int32)
        for layer in range(len(self.layers) - 1, to - 1, -1):
            found, _ = search_layer(self.vectors, self.squares, self.layers[layer], queries, seeds, STEP)
            seeds = np.pad(found, ((0, 0), (0, 1)), constant_values=0)
        return seeds

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Up to ``beam`` near nodes of each query, -1 where there are fewer, and all strays."""
        found, _ = search_layer(self.vectors, self.squares, self.layers[0], queries, self.descend(queries, 1), beam)
        return np.concatenate([found, np.tile(self.strays, (len(queries), 1))], axis=1)


def build(vectors: np.ndarray) -> Graph:
    """The graph over distinct vectors, already in the order in which they are to be numbered."""
    graph = Graph(vectors, [], np.zeros(0, dtype=np.int32))
    sizes = [len(vectors)]
    while sizes[-1] > DEGREE:
        sizes.append(-(-sizes[-1] // DEGREE))
    for layer in range(len(sizes) - 1, -1, -1):
        graph.layers.insert(0, build_layer(graph, sizes[layer], DEGREE * (2 if layer == 0 else 1)))
    reached = np.zeros(len(vectors), dtype=bool)
    edge = np.array([0])
    while len(edge):
        reached[edge] = True
        near = np.unique(graph.layers[0][edge])
        edge = near[(near >= 0) & ~reached[near]]
    graph.strays = np.flatnonzero(~reached).astype(np.int32)
    return graph


def build_layer(graph: Graph, size: int, degree: int) -> np.ndarray:
    """Links of the first ``size`` nodes; ``graph`` has the layers above, so a search starts near its end."""
    vectors, squares = graph.vectors, graph.squares
    above = len(graph.layers[0]) if graph.layers else 0
    links = np.full((size, degree), -1, dtype=np.int32)
    done = 0
    while done < size:
        new = np.arange(done, min(size, done + (FIRST if done == 0 else min(BATCH, done))), dtype=np.int32)
        own = vectors[new]
        apart = squares[new][:, None] + squares[new] - 2 * own @ own.T
        np.fill_diagonal(apart, np.inf)
        nodes, apart = nearest_first(np.tile(new, (len(new), 1)), np.maximum(apart, 0), BEAM)
        if done:
            seeds = graph.descend(own, 0) if done >= above > 0 else np.zeros((len(new), 1), dtype=np.int32)
            found, away = search_layer(vectors, squares, links[:done], own, seeds, BEAM)
            nodes, apart = nearest_first(np.concatenate([nodes, found], axis=1), np.concatenate([apart, away], axis=1), BEAM)
        links[new, :DEGREE] = spread(vectors, squares, nodes, apart, DEGREE)
        link_back(vectors, squares, links, new)
        done = int(new[-1]) + 1
    return links
