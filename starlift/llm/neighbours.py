"""Nearest neighbours by inner product, with a vantage-point tree for each shard.

A bounded sample of the vectors gives pivots; every vector goes to the region of its nearest
pivot, and a region to shards of bounded size, so one with a third of all vectors, or of copies,
is many shards. A query learns from the sample what its k-th best is at least, and goes only to
the regions that can hold better ones by the triangle inequality. There it meets each shard's
tree (``vptree``) in blocks of bounded size: a task holds one shard and one block of queries at a
time. The k best of each shard meet in a ranking that keeps the k best of a task before they move.

``factor`` relaxes the pruning of regions and of trees alike; one is an exact search, ties
included. Scores are the inner products of the given vectors, in double precision, added up in
order. The driver holds the sample, the pivots, and a few numbers for each region.

Left out: vectors that are null, zero, hold null or non-finite components, or have another
length than most (ties: the shorter). Each row is an answer of its own: repeated ids and vectors
are ranked like others, and only the query's own row isn't its answer. Ties go to the smaller
id, null ids last. A row with a null id is no query. Fewer candidates than k are all returned. An
empty table gives no rows. Columns beyond the id and the vector are not read. Components are to
stay below 1e150, so that squares are finite.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlift.llm import vptree
from starlift.llm.common import stage
from starlift.llm.vector_codes import usable

#: Vectors of a shard and queries of a block, on average at most.
SHARD, BLOCK = 2048, 2048
#: Vectors drawn as the sample, and pivots among them, at most.
SAMPLE, PIVOTS = 4096, 256
#: Tasks that the searches are dealt to, at most.
TASKS = 20_000

_PLACED = "row long, id long, vector array<double>, region int, apart double"
_ROUTED = "row long, id long, vector array<double>, least double, region int"
_HITS = "query long, query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Index:
    """Every usable vector with its region, and what the driver knows of them."""

    rows: DataFrame
    sample: np.ndarray
    sample_rows: np.ndarray
    pivots: np.ndarray
    top: float
    regions: dict[int, tuple[int, float, float]]  # vectors, least and largest distance from the pivot


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _list(vectors: np.ndarray) -> pa.Array:
    width = vectors.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, width), pa.int32()), pa.array(vectors.ravel()))


def _placed(pivots: np.ndarray, top: float) -> Callable:
    heads = vptree.lifted(pivots, top)
    lengths = (heads * heads).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = vptree.lifted(_matrix(batch.column("vector"), pivots.shape[1]), top)
            region = (lengths[None, :] - 2 * vectors @ heads.T).argmin(axis=1)
            apart = np.sqrt(((vectors - heads[region]) ** 2).sum(axis=1))
            columns = [batch.column(name) for name in ("row", "id", "vector")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(region.astype(np.int32)), pa.array(apart)], ["row", "id", "vector", "region", "apart"])

    return run


def build(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> Index:
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    rows = rows.filter(usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)).withColumn("square", square)
    found = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max("square").alias("square"))
    most = found.orderBy(F.desc("n"), "width").first()
    if most is None:
        nothing = np.zeros((0, 1))
        empty = vectors.sparkSession.createDataFrame([], _PLACED)
        return Index(empty, nothing, np.zeros(0, np.int64), nothing, 0.0, {})
    rows = rows.filter(F.size("vector") == most["width"]).drop("square")
    # A little longer than the longest, so that no rounding makes a length too short.
    top = float(np.sqrt(most["square"])) * (1 + 1e-9)
    drawn = rows.orderBy(F.xxhash64("id", "vector"), "row").limit(SAMPLE).collect()
    sample = np.array([row["vector"] for row in drawn], np.float64)
    different = np.unique(sample, axis=0, return_index=True)[1]
    pivots = sample[np.sort(different)[: min(PIVOTS, -(-most["n"] // SHARD))]]
    placed = stage(rows.mapInArrow(_placed(pivots, top), _PLACED), "regions")
    sizes = placed.groupBy("region").agg(F.count("*").alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high")).collect()
    regions = {row["region"]: (row["n"], row["low"], row["high"]) for row in sizes}
    return Index(placed, sample, np.array([row["row"] for row in drawn], np.int64), pivots, top, regions)


def _routed(index: Index, k: int, factor: float) -> Callable:
    """The regions that each query has to look into, and its k-th best in the sample."""
    named = sorted(index.regions)
    low, high = (np.array([index.regions[region][n] for region in named]) for n in (1, 2))
    sample, own, pivots, top = index.sample, index.sample_rows, index.pivots[named], index.top
    exact = vptree.ROUNDED * top * top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                queries = _matrix(part.column("vector"), sample.shape[1])
                rows = part.column("row").to_numpy()
                scale = top / np.sqrt((queries * queries).sum(axis=1))
                product = queries @ sample.T
                product[rows[:, None] == own[None, :]] = -np.inf
                least = np.full(len(queries), -np.inf)
                if product.shape[1] > k:
                    least = np.partition(product, -k, axis=1)[:, -k] - exact / scale
                reach = vptree.distance(least, scale, top) + vptree.BLUR * top
                apart = vptree.distance(queries @ pivots.T, scale[:, None], top)
                query, region = np.nonzero(factor * np.maximum(low - apart, apart - high) <= reach[:, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[query]), part.column("id").take(pa.array(query)), _list(queries[query]),
                        pa.array(least[query]), pa.array(np.array(named, np.int32)[region]),
                    ],
                    ["row", "id", "vector", "least", "region"],
                )

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell; a task's rows are in the order of their cells."""
    waiting: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        if not len(rows):
            continue
        cells = rows.column("cell").to_numpy()
        ends = np.flatnonzero(cells[1:] != cells[:-1]) + 1
        for start, end in zip([0, *ends[:-1]], ends):
            yield rows.slice(start, end - start)
        waiting = rows.slice(ends[-1] if len(ends) else 0)
    if waiting is not None and len(waiting):
        yield waiting


def _answered(width: int, top: float, k: int, factor: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            cell = cell.combine_chunks()
            asks = cell.column("least").is_valid().to_numpy()
            points, queries = cell.filter(pa.array(~asks)).combine_chunks(), cell.filter(pa.array(asks)).combine_chunks()
            if not len(points) or not len(queries):
                continue
            tree = vptree.grow(_matrix(points.column("vector").combine_chunks(), width), top)
            wanted = _matrix(queries.column("vector").combine_chunks(), width)
            own, floor = queries.column("row").to_numpy(), queries.column("least").to_numpy()
            query, vector, score = vptree.Search(tree, points.column("row").to_numpy(), wanted, own, floor, k, factor).run()
            ids = points.column("id")
            last, ids = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
            by = np.lexsort((points.column("row").to_numpy()[vector], ids[vector], last[vector], -score, query))
            place = np.arange(len(by)) - np.searchsorted(query[by], query[by])
            by = by[place < k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[query[by]]), queries.column("id").combine_chunks().take(pa.array(query[by])),
                    points.column("id").combine_chunks().take(pa.array(vector[by])), pa.array(score[by]),
                ],
                ["query", "query_id", "vec_id", "score"],
            )

    return run


def _of_region(numbers: dict[int, int]) -> Column:
    """A number of each region, looked up by the column ``region``."""
    return F.get(F.array(*(F.lit(numbers.get(region, 0)) for region in range(max(numbers) + 1))), F.col("region"))


def search(index: Index, asked: Column, k: int = 20, factor: float = 1.0) -> DataFrame:
    """The ``k`` nearest rows of every row for which ``asked`` (of its id) holds: query_id, rank,
    vec_id and score."""
    if factor < 1 or k < 1:
        raise ValueError("factor and k must be 1 or more")
    spark, width = index.rows.sparkSession, index.sample.shape[1]
    if not index.regions:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = index.rows.filter(asked).select("row", "id", "vector")
    routed = stage(wanted.mapInArrow(_routed(index, k, factor), _ROUTED), "routed")
    asking = {row["region"]: row["count"] for row in routed.groupBy("region").count().collect()}
    shards = {region: -(-n // SHARD) for region, (n, _, _) in index.regions.items()}
    blocks = {region: -(-asking.get(region, 0) // BLOCK) for region in shards}

    def dealt(own: dict[int, int], salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.greatest(_of_region(own), F.lit(1))).cast("int")

    def every(others: dict[int, int]) -> Column:
        count = _of_region(others)
        return F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")))

    points = index.rows.select("region", dealt(shards, 1).alias("shard"), every(blocks).alias("block"), "row", "id", "vector", F.lit(None).cast("double").alias("least"))
    asks = routed.select("region", every(shards).alias("shard"), dealt(blocks, 2).alias("block"), "row", "id", "vector", "least")
    cells = {region: shards[region] * blocks[region] for region in sorted(shards)}
    before = dict(zip(cells, accumulate(cells.values(), initial=0)))
    cell = (_of_region(before) + F.col("shard") * _of_region(blocks) + F.col("block")).cast("long").alias("cell")
    met = points.unionByName(asks).select(cell, "row", "id", "vector", "least")
    tasks = max(1, min(TASKS, sum(cells.values())))
    met = met.repartition(tasks, "cell").sortWithinPartitions("cell", "row")
    hits = met.mapInArrow(_answered(width, index.top, k, factor), _HITS)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
