import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from cases import CLASHING, changed, result
from compare import compare
from pyspark.sql import functions as F

from starlift.llm import covertree, oracle, queries, vector_codes
from starlift.llm.vector_codes import Quantizer, codebooks_digest, compress, with_total

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd in Python's integers; rows of (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    numbers = [[math.floor(Fraction(x) * 4096) for x in r[1]] for r in kept]
    step = len(kept[0][1]) // parts if kept else 0
    cut = [[v[p * step : (p + 1) * step] for v in numbers] for p in range(parts)]
    books, codes, errors = [], [[] for _ in kept], [0] * len(kept)
    for points in cut:
        book = [list(p) for p in points[:entries]]

        def nearest(p):
            return min((sum((a - b) ** 2 for a, b in zip(p, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            groups = {}
            for p in points:
                groups.setdefault(nearest(p)[1], []).append(p)
            for k, own in groups.items():
                book[k] = [sum(axis) // len(own) for axis in zip(*own)]
        for at, p in enumerate(points):
            apart, k = nearest(p)
            codes[at].append(f"{k:02x}")
            errors[at] += apart
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    by = {}
    for (_, _, label), error in zip(kept, errors):
        by[label] = by.get(label, 0) + error
    top = 2**63 - 1
    return sorted(((r[0], "".join(c), min(top, e), min(top, by[r[2]]), digest) for r, c, e in zip(kept, codes, errors)), key=repr)


def found(frame, **setting):
    rows, books = compress(frame, keep=("label",), setting=Quantizer(**setting))
    rows = with_total(rows, "label", "label_error")
    return result(rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books))))


def vectors(n, width, seed=0, clusters=7):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, width))
    return [(int(k), [float(np.float32(x)) for x in centres[k % clusters] + draw.normal(0, 0.2, width)], k % 3) for k in range(n)]


def test_trees_give_what_comparing_all_gives():
    draw = np.random.default_rng(1)
    for n, width in [(1, 3), (24, 2), (900, 2), (3000, 8)]:
        points = np.floor(draw.normal(0, 500, (n, width)) + 3000 * draw.integers(0, 3, (n, 1)))
        points[: n // 3] = points[0]  # a third of the points are equal
        tree = covertree.grow(points)
        assert sorted(tree.order) == list(range(n))
        for node in range(len(tree.start)):
            own = tree.points[tree.start[node] : tree.end[node]]
            assert (tree.sums[node] == own.sum(axis=0)).all()
            assert ((own - own[0]) ** 2).sum(axis=1).max() <= tree.radius[node] ** 2 * (1 + 1e-9)
        entries = np.concatenate([points[:5], np.floor(draw.normal(0, 2000, (6, width)))])
        nearest, counts, sums = covertree.assign(tree, entries)
        plain = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (nearest == plain[tree.order]).all()
        assert (counts == np.bincount(plain, minlength=len(entries))).all()
        assert all((sums[k] == points[plain == k].sum(axis=0)).all() for k in range(len(entries)))


def test_whole_subtrees_are_assigned():
    """Far apart clusters: hardly any point is compared."""
    draw = np.random.default_rng(2)
    points = np.floor(draw.normal(0, 20, (4000, 8)) + 40_000 * (np.arange(4000) % 4)[:, None])
    tree, seen = covertree.grow(points), []
    plain = covertree.squared
    with changed(covertree, squared=lambda a, b: seen.append(len(a)) or plain(a, b)):
        covertree.assign(tree, points[:4])
    assert sum(seen) < 40


@pytest.mark.parametrize("shard", [8192, 50])
def test_equals_brute_force(spark, shard):
    rows = vectors(700, 16)
    with changed(vector_codes, SHARD=shard), changed(covertree, LEAF=6):
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_other_settings(spark):
    rows = vectors(90, 6)
    assert found(spark.createDataFrame(rows, SCHEMA), parts=3, entries=5, rounds=2) == brute(rows, 3, 5, 2)


def test_awkward_rows_and_clashing_columns(spark):
    one = [0.25, -0.25, 1e-9, -1e-9, 0.0, -0.0, 0.5, 1 / 3]
    rows = [(1, one, 1), (1, one, None), (2, None, 2), (3, [0.1] * 7 + [None], 2), (4, [float("nan")] * 8, 1), (5, [float("inf")] * 8, 1)]
    rows += [(None, [0.3] * 8, 4), (6, [0.1] * 7, 1), (7, [-1e30, 1e12] * 4, None), (8, [2.0**20] * 8, 9), (9, [], 3), (1, one, 1), (-4, [0.2] * 8, 1)]
    rows += [(20 + k, [k / 50, 1 - k / 50] * 4, None) for k in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA)
    names = {*CLASHING, "n", "part", "entry", "_vector", "_trees", "error", "code"} - {"label"}
    assert found(frame.select("*", *(F.lit(7).alias(name) for name in sorted(names)))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)], [(5, [0.5] * 8, 1), (3, [0.25] * 8, 1)]])
def test_few_rows(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_length_that_the_parts_do_not_divide(spark):
    with pytest.raises(ValueError, match="divide"):
        compress(spark.createDataFrame([(1, [0.5] * 9, 1)], SCHEMA))


def test_query_equals_brute_force_and_sql(spark, sf_dir, tables):
    frame = queries.op11_vector_codes(spark, sf_dir)
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(frame.select("vec_id", "code", "error", "label_error", "codebooks_sha256")) == brute(rows)
    assert compare(frame, tables, oracle.oracle()["op11_vector_codes"]) is None
