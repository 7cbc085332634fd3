"""Connected components, of arrays in a task and of tables over the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import stage


def forest(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``labels`` (each place points to a smaller one of its component, or to itself) with
    the links ``left``-``right`` added, and every place pointing to its smallest."""
    while len(left):
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(labels, high, low)
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels = further
    return labels


def components(links: DataFrame) -> DataFrame:
    """The component of every node of ``links`` (src, dst): node, root (one of its nodes).

    Each round points every node to its smallest neighbour, or to itself if that is larger,
    and contracts the links to the nodes pointed to. Minima are combined before the shuffle
    and a node's links may be split over tasks, so hubs do no harm. The ids should be hashes:
    then a constant share of the nodes goes in each round. Every round is a written table.
    """
    rest = stage(links.filter("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "links")
    rounds = []
    while not rest.isEmpty():
        both = rest.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e"))
        points = both.groupBy(F.col("e.src").alias("node")).agg(F.min("e.dst").alias("near"))
        points = points.select("node", F.least("node", "near").alias("root"))
        # A second step along the pointers, so that chains shorten faster.
        onward = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
        points = stage(points.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "points")
        rounds.append(points)
        a = points.select(F.col("node").alias("src"), F.col("root").alias("a"))
        b = points.select(F.col("node").alias("dst"), F.col("root").alias("b"))
        moved = rest.join(a, "src").join(b, "dst").filter("a <> b")
        rest = stage(moved.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(), "links")
    if not rounds:
        return rest.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    found = rounds[0]
    for points in rounds[1:]:
        step = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
