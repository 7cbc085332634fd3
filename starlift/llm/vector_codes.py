"""Product codes of vectors by Lloyd's rounds over partition-local cover trees.

A component x becomes the whole number floor(scale * x). Vectors are cut into equal consecutive
parts; each part position has a codebook, which starts as that part of the vectors of the
smallest ids. A round gives every part to the nearest entry (squared distance, ties to the lower
index) and moves each entry to the componentwise floor of its parts' mean; an entry without
parts stays.

The vectors don't move: tasks gather theirs into shards of bounded size and grow a cover tree
for each part position (``covertree``), which is written once. A round reads the trees, assigns
whole subtrees by the triangle inequality, and sends on one number, count and sum for each
component of an entry and task; what comes to the driver, and goes out again as codebooks, is
parts x entries x width numbers, however many vectors there are.

Left out: null vectors, those that hold null or non-finite components, and those of another
length than the first one's (smallest id, null ids last, ties by the vector). Fewer vectors than
entries make smaller codebooks. Equal vectors and repeated ids count each time. Components of any
size are exact up to 38 digits; an error above the largest long is given as that. An empty table
gives no rows and empty codebooks. A length that the parts don't divide raises ValueError.
Columns beyond the id, the vector and those to keep are not read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlift.llm.common import stage
from starlift.llm.covertree import Tree, assign, grow, squared

#: Vectors of a shard, all of whose trees a task holds at a time.
SHARD = 8192

# The largest long, and a float below which scaled components are exact.
LONGEST, EXACT = 2**63 - 1, 2.0**40

_PARTIAL = "part int, entry int, axis int, n long, total decimal(38,0)"

Codebooks = list[list[list[int]]]


@dataclass(frozen=True)
class Quantizer:
    """parts of a vector, entries of a codebook, rounds, and what components are scaled by."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, as floats while they are exact."""
    if not vectors.size or np.abs(vectors).max() * scale < EXACT:
        return np.floor(vectors * scale)
    return np.array([[math.floor(Fraction(x) * scale) for x in row] for row in vectors.tolist()], object)


def usable(vector: Column) -> Column:
    """Whether a vector (array<double>) is there and every component is a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task, ``SHARD`` at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(len(part) for part in waiting) >= SHARD:
            rows = pa.Table.from_batches(waiting)
            for start in range(0, len(rows) - SHARD + 1, SHARD):
                yield rows.slice(start, SHARD)
            waiting = rows.slice(len(rows) // SHARD * SHARD).to_batches()
    if sum(len(part) for part in waiting):
        yield pa.Table.from_batches(waiting)


def _grown(kept: list[str], width: int, setting: Quantizer) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches):
            rows = rows.combine_chunks()
            vectors = rows.column("_vector").combine_chunks().flatten().to_numpy().reshape(len(rows), width)
            numbers = whole(vectors, setting.scale)
            if numbers.dtype != object and np.abs(numbers).max(initial=0) < 1 << 31:
                numbers = numbers.astype(np.int32)
            trees = [grow(part) for part in np.split(numbers, setting.parts, axis=1)]
            columns = [rows.column(name).combine_chunks() for name in kept]
            lists = [pa.ListArray.from_arrays([0, len(column)], column) for column in columns]
            packed = pa.array([pickle.dumps([tuple(tree) for tree in trees])], pa.binary())
            yield pa.RecordBatch.from_arrays([*lists, packed], [*kept, "_trees"])

    return run


def _trees(value: pa.Scalar) -> list[Tree]:
    return [Tree(*parts) for parts in pickle.loads(value.as_py())]


def _entries(book: list[list[int]]) -> np.ndarray:
    largest = max((abs(x) for entry in book for x in entry), default=0)
    return np.array(book, np.float64 if largest < EXACT else object).reshape(len(book), len(book[0]) if book else 0)


def _summed(books: Codebooks) -> Callable:
    entries = [_entries(book) for book in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], int] = {}
        totals: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for value in batch.column("_trees"):
                for part, tree in enumerate(_trees(value)):
                    _, count, total = assign(tree, entries[part])
                    for entry in np.flatnonzero(count).tolist():
                        counts[part, entry] = counts.get((part, entry), 0) + int(count[entry])
                        for axis, x in enumerate(total[entry].tolist()):
                            totals[part, entry, axis] = totals.get((part, entry, axis), 0) + int(x)
        if totals:
            keys = list(totals)
            columns = [pa.array([key[k] for key in keys], pa.int32()) for k in range(3)]
            columns += [pa.array([counts[key[:2]] for key in keys], pa.int64())]
            columns += [pa.array([Decimal(totals[key]) for key in keys], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "axis", "n", "total"])

    return run


def _coded(kept: list[str], books: Codebooks) -> Callable:
    entries = [_entries(book) for book in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                trees = _trees(batch.column("_trees")[row])
                codes = np.zeros((len(trees[0].order), len(trees)), np.uint8)
                errors = np.zeros(len(codes), np.int64)
                for part, tree in enumerate(trees):
                    nearest, _, _ = assign(tree, entries[part])
                    codes[tree.order, part] = nearest
                    for entry in np.unique(nearest):
                        at = np.flatnonzero(nearest == entry)
                        apart = squared(tree.points[at], entries[part][entry : entry + 1])[:, 0]
                        errors = errors if apart.dtype != object else errors.astype(object)
                        errors[tree.order[at]] += apart.astype(errors.dtype)
                text = codes.tobytes().hex()
                step = 2 * codes.shape[1]
                lists = [batch.column(name)[row].values for name in kept]
                names = pa.array([text[at : at + step] for at in range(0, len(text), step)], pa.string())
                errors = pa.array([min(LONGEST, x) for x in errors.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*lists, names, errors], [*kept, "code", "error"])

    return run


def _moved(books: Codebooks, sums: list) -> Codebooks:
    moved = [[list(entry) for entry in book] for book in books]
    for row in sums:
        moved[row["part"]][row["entry"]][row["axis"]] = int(row["total"]) // row["n"]
    return moved


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place in the part."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compress(
    vectors: DataFrame, column: str = "embedding", key: str = "vec_id", keep: tuple[str, ...] = (), setting: Quantizer = Quantizer()
) -> tuple[DataFrame, Codebooks]:
    """Per usable vector its key, the columns to keep, ``code`` (two hex digits a part) and
    ``error`` (squared distance to what the code stands for); and the codebooks."""
    if not 1 <= setting.entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = [key, *keep]
    rows = vectors.select(*kept, F.col(column).cast("array<double>").alias("_vector")).filter(usable(F.col("_vector")))
    order = (F.col(key).asc_nulls_last(), F.col("_vector"))
    first = rows.orderBy(*order).limit(setting.entries).collect()
    width = len(first[0]["_vector"]) if first else 0
    if width % setting.parts:
        raise ValueError(f"{setting.parts} parts don't divide vectors of {width} components")
    rows = rows.filter(F.size("_vector") == width)
    if any(len(row["_vector"]) != width for row in first):
        first = rows.orderBy(*order).limit(setting.entries).collect()
    start = whole(np.array([row["_vector"] for row in first], np.float64).reshape(len(first), width), setting.scale)
    step = width // setting.parts
    books = [[[int(x) for x in row[part * step : (part + 1) * step]] for row in start] for part in range(setting.parts)]

    lists = [T.StructField(name, T.ArrayType(rows.schema[name].dataType)) for name in kept]
    trees = rows.mapInArrow(_grown(kept, width, setting), T.StructType([*lists, T.StructField("_trees", T.BinaryType())]))
    trees = stage(trees, "cover-trees")
    for _ in range(setting.rounds if first else 0):
        partial = trees.select("_trees").mapInArrow(_summed(books), _PARTIAL)
        # At most parts x entries x width rows come back.
        sums = partial.groupBy("part", "entry", "axis").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        books = _moved(books, sums)
    schema = T.StructType([*(rows.schema[name] for name in kept), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return trees.mapInArrow(_coded(kept, books), schema), books


def with_total(found: DataFrame, by: str, name: str) -> DataFrame:
    """``found`` with the sum of ``error`` over the rows that are equal in ``by``, nulls too."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    sums = found.groupBy(F.col(by).alias("_by")).agg(total.alias(name))
    return found.join(sums, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
