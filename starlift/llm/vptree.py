"""Vantage-point trees over the vectors of a shard, searched for the largest inner products.

With one more coordinate that brings every vector to the length ``top`` (at least the longest
one's), and queries scaled to that length with a zero there, the nearest vectors are those with
the largest inner products, and distances obey the triangle inequality.

A node keeps its vantage point, the vector farthest from the middle of the node's, and for the
half of them that is nearer to it and the half that is farther the range of their distances.
A query skips a half if ``factor`` times the least distance that the triangle inequality leaves
exceeds that of its k-th best so far. A factor of one is exact; a larger one skips more.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Vectors of a leaf at most, and pairs whose inner products are taken at a time.
LEAF, PAIRS = 48, 1 << 16

#: What distances may be wrong by, and inner products, as shares of ``top`` and its square.
BLUR, ROUNDED = 1e-6, 1e-12


class Node(NamedTuple):
    start: int
    end: int
    vantage: int = -1  # of inner nodes, with the range of distances of each child's vectors
    children: tuple = ()
    ranges: tuple = ()


class Tree(NamedTuple):
    vectors: np.ndarray
    order: np.ndarray  # nodes hold runs of it
    nodes: list[Node]
    top: float


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """``vectors`` with the coordinate that brings them to the length ``top``."""
    rest = np.sqrt(np.maximum(0, top * top - (vectors * vectors).sum(axis=1)))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def grow(vectors: np.ndarray, top: float) -> Tree:
    order, nodes, points = np.arange(len(vectors)), [Node(0, len(vectors))], lifted(vectors, top)
    at = 0
    while at < len(nodes):
        start, end = nodes[at].start, nodes[at].end
        if end - start > LEAF:
            own = order[start:end]
            values = points[own]
            vantage = int(own[((values - values.mean(axis=0)) ** 2).sum(axis=1).argmax()])
            apart = np.sqrt(((values - points[vantage]) ** 2).sum(axis=1))
            by = np.argsort(apart, kind="stable")
            order[start:end], apart = own[by], apart[by]
            half = (end - start) // 2
            ranges = ((apart[0], apart[half - 1]), (apart[half], apart[-1]))
            nodes[at] = Node(start, end, vantage, (len(nodes), len(nodes) + 1), ranges)
            nodes += [Node(start, start + half), Node(start + half, end)]
        at += 1
    return Tree(vectors, order, nodes, top)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The inner product of each pair of rows, added up from the first component to the last, so
    that equal vectors give equal numbers wherever they stand."""
    total = np.zeros(len(left))
    for start in range(0, len(left), PAIRS):
        a, b = left[start : start + PAIRS], right[start : start + PAIRS]
        for axis in range(a.shape[1]):
            total[start : start + PAIRS] += a[:, axis] * b[:, axis]
    return total


def distance(product: np.ndarray, scale: np.ndarray, top: float) -> np.ndarray:
    """From inner products with unscaled queries; infinite where the product is minus infinity."""
    return np.sqrt(np.maximum(0, 2 * top * top - 2 * scale * product))


class Search:
    """One shard's answers to a block of queries: at most the ``k`` best each, ties included."""

    def __init__(self, tree: Tree, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, factor: float):
        self.tree, self.rows, self.queries, self.own, self.factor = tree, rows, queries, own, factor
        self.scale = tree.top / np.sqrt((queries * queries).sum(axis=1))
        self.slack = ROUNDED * tree.top * tree.top / self.scale
        self.best = np.full((len(queries), k), -np.inf)
        self.least = floor.copy()  # the k-th best so far, or what is known of it
        self.home = np.full(len(queries), -1)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.compared = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, inner product) of all that may be among the k best."""
        everyone = np.arange(len(self.queries))
        self._descend(0, everyone)
        self._visit(0, everyone)
        query, vector, product = (np.concatenate(part) for part in zip(*self.hits))
        still = product >= (self.least - self.slack)[query]
        query, vector = query[still], vector[still]
        return query, vector, products(self.queries[query], self.tree.vectors[vector])

    def _apart(self, node: Node, who: np.ndarray) -> np.ndarray:
        product = self.queries[who] @ self.tree.vectors[node.vantage]
        return distance(product, self.scale[who], self.tree.top)

    def _descend(self, at: int, who: np.ndarray) -> None:
        """Every query to the leaf that seems nearest, for a first k-th best."""
        node = self.tree.nodes[at]
        if not node.children:
            self.home[who] = at
            self._compare(node, who)
            return
        nearer = self._apart(node, who) < (node.ranges[0][1] + node.ranges[1][0]) / 2
        for child, chosen in zip(node.children, (nearer, ~nearer)):
            if chosen.any():
                self._descend(child, who[chosen])

    def _visit(self, at: int, who: np.ndarray) -> None:
        node = self.tree.nodes[at]
        if not node.children:
            self._compare(node, who[self.home[who] != at])
            return
        apart = self._apart(node, who)
        for child, (low, high) in zip(node.children, node.ranges):
            reach = distance(self.least[who], self.scale[who], self.tree.top) + BLUR * self.tree.top
            near = self.factor * np.maximum(low - apart, apart - high) <= reach
            if near.any():
                self._visit(child, who[near])

    def _compare(self, node: Node, who: np.ndarray) -> None:
        if not len(who):
            return
        vectors = self.tree.order[node.start : node.end]
        product = self.queries[who] @ self.tree.vectors[vectors].T
        self.compared += product.size
        product[self.own[who][:, None] == self.rows[vectors][None, :]] = -np.inf
        higher = (product > self.least[who][:, None]).any(axis=1)
        better, k = who[higher], self.best.shape[1]
        every = np.concatenate([self.best[better], product[higher]], axis=1)
        self.best[better] = np.partition(every, every.shape[1] - k, axis=1)[:, -k:]
        self.least[better] = np.maximum(self.least[better], self.best[better].min(axis=1))
        row, column = np.nonzero((product >= (self.least - self.slack)[who][:, None]) & (product > -np.inf))
        self.hits.append((who[row], vectors[column], product[row, column]))
