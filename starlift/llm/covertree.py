"""Cover trees over the points of a task, and their assignment to the nearest of a few entries.

A node stands for a run of points, the first of which is its centre, and knows their number,
their sum and the largest distance from the centre. Its children are found greedily: the first
point left is a centre and takes all points within half the node's radius, so that centres of
one level are apart by more than that and every point is covered.

If the second nearest entry is farther from the centre than the nearest by more than twice the
radius, the triangle inequality gives every point of the node the same nearest entry: the node's
sum and number are added as they are. Only the others are looked into, and points are compared
one by one only in ambiguous leaves. Coordinates are whole numbers and all distances that decide
are exact: floats while they hold every number, Python's integers beyond.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Points of a leaf at most, unless they are all equal.
LEAF = 24


class Tree(NamedTuple):
    points: np.ndarray  # in the order of the tree
    order: np.ndarray  # the row of each point
    start: np.ndarray  # a node's points, the first of them its centre
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # a node's children are consecutive nodes
    children: np.ndarray
    sums: np.ndarray


def small(*arrays: np.ndarray) -> bool:
    """Whether floats hold every squared distance among these points."""
    largest = max((abs(array).max() for array in arrays if array.size), default=0)
    return all(array.dtype != object for array in arrays) and 4 * arrays[0].shape[-1] * int(largest) ** 2 < 1 << 53


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The exact squared distance of every point to every entry."""
    if small(points, entries):
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    a = np.array([[int(x) for x in row] for row in points], object).reshape(points.shape)
    b = np.array([[int(x) for x in row] for row in entries], object).reshape(entries.shape)
    difference = a[:, None, :] - b[None, :, :]
    return (difference * difference).sum(axis=2)


def grow(points: np.ndarray) -> Tree:
    """The cover tree of ``points`` (rows); of huge numbers a single leaf."""
    order = np.arange(len(points))
    start, end, radius, child, children = [0], [len(points)], [np.inf], [0], [0]
    at = 0
    exact = small(points)
    values = points.astype(np.float64) if exact else points
    while exact and at < len(start) and len(points):
        own = order[start[at] : end[at]]
        apart = ((values[own] - values[own[0]]) ** 2).sum(axis=1)
        radius[at] = float(np.sqrt(apart.max()))
        if len(own) > LEAF and radius[at] > 0:
            limit = apart.max() / 4
            rest, sets = own, []
            while len(rest):
                near = apart <= limit
                sets.append(rest[near])
                rest = rest[~near]
                if len(rest):
                    apart = ((values[rest] - values[rest[0]]) ** 2).sum(axis=1)
            order[start[at] : end[at]] = np.concatenate(sets)
            ends = start[at] + np.cumsum([len(part) for part in sets])
            child[at], children[at] = len(start), len(sets)
            start += [start[at], *ends[:-1].tolist()]
            end += ends.tolist()
            radius += [0.0] * len(sets)
            child += [0] * len(sets)
            children += [0] * len(sets)
        at += 1
    placed = points[order]
    kind = object if points.dtype == object else np.int64
    total = np.concatenate([np.zeros((1, points.shape[1]), kind), np.cumsum(placed.astype(kind), axis=0)])
    ends, starts = np.array(end), np.array(start)
    return Tree(placed, order, starts, ends, np.array(radius), np.array(child), np.array(children), total[ends] - total[starts])


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each point, in the order of the tree (ties: the lower index), and
    the number and the sum of the points of each entry."""
    nearest = np.zeros(len(tree.points), np.int64)
    counts = np.zeros(len(entries), np.int64)
    sums = np.zeros((len(entries), tree.points.shape[1]), tree.sums.dtype)

    def one_by_one(places: np.ndarray) -> None:
        points = tree.points[places]
        found = squared(points, entries).argmin(axis=1).astype(np.int64)
        nearest[places] = found
        np.add.at(sums, found, points.astype(sums.dtype))
        np.add.at(counts, found, 1)

    if not small(tree.points, entries):
        one_by_one(np.arange(len(tree.points)))
        return nearest, counts, sums
    nodes = np.arange(min(1, len(tree.points)))
    while len(nodes):
        apart = squared(tree.points[tree.start[nodes]], entries)
        best = apart.argmin(axis=1)
        first = np.sqrt(apart[np.arange(len(nodes)), best])
        apart[np.arange(len(nodes)), best] = np.inf
        margin = np.sqrt(apart.min(axis=1)) - first
        radius = tree.radius[nodes]
        # A little more than twice the radius, for what square roots round.
        whole = (radius == 0) | (margin > 2 * radius * (1 + 1e-9) + 1e-6)
        sure, entry = nodes[whole], best[whole]
        size = tree.end[sure] - tree.start[sure]
        nearest[spread(tree.start[sure], size)] = np.repeat(entry, size)
        np.add.at(sums, entry, tree.sums[sure])
        np.add.at(counts, entry, size)
        rest = nodes[~whole]
        leaves = rest[tree.children[rest] == 0]
        if len(leaves):
            one_by_one(spread(tree.start[leaves], tree.end[leaves] - tree.start[leaves]))
        rest = rest[tree.children[rest] > 0]
        nodes = spread(tree.child[rest], tree.children[rest]) if len(rest) else rest
    return nearest, counts, sums
