import math

import numpy as np
import pytest
from cases import CLASHING, changed, result
from compare import compare
from pyspark.sql import functions as F

from starlift.llm import neighbours, oracle, queries, vptree

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=20):
    """(query_id, rank, vec_id, score) by comparing each query with every other row."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    lengths = [len(r[1]) for r in kept]
    kept = [r for r in kept if len(r[1]) == min(set(lengths), key=lambda n: (-lengths.count(n), n))]
    found = []
    for at, (query, vector, *_) in enumerate(kept):
        if query is None or query % 20:
            continue
        scores = []
        for other, (key, candidate, *_) in enumerate(kept):
            total = 0.0
            for a, b in zip(vector, candidate):
                total += a * b
            if other != at:
                scores.append((-total, key is None, key or 0, key))
        found += [(query, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def found(frame, k=20, factor=1.0):
    return result(neighbours.search(neighbours.build(frame), F.col("id") % 20 == 0, k, factor))


def vectors(n, width, seed=0, common=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 12] * (1 + k % 3) + draw.normal(0, 0.3, width)], k % 3) for k in range(n)]
    return rows + [(n + k, rows[3][1], 1) for k in range(common)]


def test_a_tree_finds_what_comparing_all_finds():
    draw = np.random.default_rng(4)
    for n, width, common in [(1, 2, 0), (40, 3, 0), (1500, 6, 0), (1500, 6, 700)]:
        points = draw.normal(size=(n, width)) * draw.uniform(0.1, 3, (n, 1))
        points[:common] = points[-1]
        tree = vptree.grow(points, float(np.sqrt((points * points).sum(axis=1).max())))
        asked, own = draw.normal(size=(50, width)) * 5, np.arange(50)
        query, vector, score = vptree.Search(tree, np.arange(n), asked, own, np.full(50, -np.inf), 5, 1.0).run()
        for q in range(50):
            every = vptree.products(np.repeat(asked[q : q + 1], n, axis=0), points)
            every[q : q + 1] = -np.inf  # rows and queries with the same number are one row
            best = [v for v in np.lexsort((np.arange(n), -every))[:5] if every[v] > -np.inf]
            mine = sorted(zip(-score[query == q], vector[query == q]))[:5]
            assert [v for _, v in mine] == best


def test_pruning_skips_most_of_a_shard():
    draw = np.random.default_rng(5)
    points = draw.normal(size=(4000, 3))
    points /= np.sqrt((points * points).sum(axis=1, keepdims=True))
    tree = vptree.grow(points, 1.001)
    compared = []
    for factor in (1.0, 2.0):
        search = vptree.Search(tree, np.arange(4000), points[::40], np.arange(0, 4000, 40), np.full(100, -np.inf), 5, factor)
        search.run()
        compared.append(search.compared / (100 * 4000))
    assert compared[0] < 0.2 and compared[1] <= compared[0]


@pytest.mark.parametrize("shard, block, sample", [(2048, 2048, 4096), (40, 7, 60), (25, 5, 1)])
def test_exact_search_equals_brute_force(spark, shard, block, sample):
    rows = vectors(500, 8, common=250)
    with changed(neighbours, SHARD=shard, BLOCK=block, SAMPLE=sample), changed(vptree, LEAF=10):
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_a_relaxed_search_finds_most(spark):
    rows = vectors(900, 8, seed=2)
    with changed(neighbours, SHARD=100), changed(vptree, LEAF=10):
        some = {row[:1] + row[2:3] for row in found(spark.createDataFrame(rows, SCHEMA), factor=1.5)}
    true = {row[:1] + row[2:3] for row in brute(rows)}
    assert len(some & true) >= 0.9 * len(true)


def test_awkward_rows_and_clashing_columns(spark):
    draw = np.random.default_rng(6)
    rows = [(k, draw.normal(size=4).tolist(), None) for k in range(0, 60)]
    rows += [(None, rows[7][1], 1), (None, rows[7][1], 1), (20, rows[20][1], 2), (20, rows[20][1], 2), (40, None, 1), (60, [0.0] * 4, 1)]
    rows += [(80, [1.0, None, 1.0, 1.0], 1), (100, [float("nan")] * 4, 1), (120, [float("inf"), 0.0, 0.0, 0.0], 1), (140, [1.0] * 3, 1), (160, [], 1)]
    rows += [(-20, [1e30, -1e30, 1.0, 0.0], 1), (180, [1e-30] * 4, 1)]
    names = {*CLASHING, "query", "vector", "region", "cell", "least", "score", "rank", "id"} - {"label"}
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(7).alias(name) for name in sorted(names)))
    assert found(frame) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [1.0, 2.0], 1)], [(0, [1.0, 2.0], 1), (20, [1.0, 2.0], 1), (3, [-1.0, 0.0], 1)]])
def test_few_rows(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_settings_out_of_range(spark):
    index = neighbours.build(spark.createDataFrame([(0, [1.0], 1)], SCHEMA))
    with pytest.raises(ValueError):
        neighbours.search(index, F.lit(True), factor=0.5)


def test_query_equals_brute_force_and_sql(spark, sf_dir, tables):
    frame = queries.op12_neighbours(spark, sf_dir)
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(frame) == brute(rows)
    assert compare(frame, tables, oracle.oracle()["op12_neighbours"]) is None
