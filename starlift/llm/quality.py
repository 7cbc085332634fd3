"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Words are hashed to a fixed number of ids. Every id has a fixed sparse index vector of a few
+1 and -1 (drawn from a seed); the vector of a word is the sum of the index vectors of its
neighbours, two on each side, over the whole corpus. Each task adds up its own share and the
shares are summed in the cluster; the finished table has ``IDS`` rows of ``WIDTH`` numbers
however large the corpus is. A document is the mean of its words' vectors, each of length 1.

A network with one hidden layer is trained in numpy on at most about ``sample`` labelled
documents. A fifth of them is kept aside to fit the temperature that divides the logit, so
that scores are calibrated probabilities. Labels are learned only from the rows that the
caller gives; language, source and id are never inputs.

Defined cases: a null or empty text has the zero vector and gets a score like any other. A
document with several labels has the mean of them, rounded (a tie is 1). If there are no
labelled documents, or all have one label, every score is the smoothed share of label 1.
Repeated rows count and are scored each. Columns beyond those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import stage

IDS, WIDTH, ONES, REACH = 1 << 14, 64, 4, 2
#: Tokens that are worked on at a time, and words whose ids a task remembers.
CHUNK, REMEMBERED = 1 << 20, 1 << 20

# Ids that don't stand for a word: all capitals, the same as the one before, a number.
CAPITALS, AGAIN, NUMBER, FIRST = 0, 1, 2, 3
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")


class Training(NamedTuple):
    """sample: labelled documents learned from, at most about so many, drawn by a hash of
    doc_id. hidden: units of the hidden layer. rounds: passes over the sample."""

    sample: int = 20_000
    hidden: int = 32
    rounds: int = 60
    rate: float = 0.003
    decay: float = 1e-4
    seed: int = 17


class Model(NamedTuple):
    """vectors: unit vectors of the ids. The rest: scaling, both layers, temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


class _Ids(dict):
    """Ids of tokens, remembered as they come."""

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        if token.isdigit():
            found = NUMBER
        elif len(token) > 1 and token.isupper():
            found = CAPITALS
        else:
            found = FIRST + zlib.crc32(token.lower().encode("utf-8", "replace")) % (IDS - FIRST)
        self[token] = found
        return found


def ids_of(text: str | None, known: dict) -> np.ndarray:
    """The ids of a text's words, punctuation runs and line ends."""
    ids = np.fromiter(map(known.__getitem__, _TOKEN.findall(text or "")), np.int64)
    again = np.flatnonzero(ids[1:] == ids[:-1]) + 1
    ids[again] = AGAIN
    return ids


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ones of every id; the last row is the empty neighbour."""
    draw = np.random.default_rng(0)
    places = draw.integers(0, WIDTH, (IDS + 1, ONES))
    signs = draw.choice([-1.0, 1.0], (IDS + 1, ONES))
    signs[IDS] = 0
    return places, signs


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's sums of neighbours' index vectors."""
    places, signs = _index_vectors()
    total, known = np.zeros((IDS + 1) * WIDTH), _Ids()
    gap = np.full(REACH, IDS)

    def add(parts: list[np.ndarray]) -> None:
        whole = np.concatenate(parts)
        for start in range(0, len(whole), CHUNK):  # a long text in pieces that overlap
            part(whole[max(0, start - REACH) : start + CHUNK], min(start, REACH))

    def part(ids: np.ndarray, seen: int) -> None:
        for apart in range(1, REACH + 1):
            # Pairs within the first ``seen`` ids were added with the piece before.
            left, right = ids[max(0, seen - apart) : -apart], ids[max(apart, seen) :]
            for word, near in ((left, right), (right, left)):
                for one in range(ONES):
                    total[:] += np.bincount(word * WIDTH + places[near, one], signs[near, one], len(total))

    waiting, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            ids = ids_of(text.as_py(), known)
            waiting += [ids, gap]
            size += len(ids)
            if size >= CHUNK:
                add(waiting)
                waiting, size = [], 0
    if waiting:
        add(waiting)
    sums = total.reshape(-1, WIDTH)[:IDS].astype(np.int64)
    used = np.flatnonzero(sums.any(axis=1))
    columns = [pa.array(used.astype(np.int32)), *(pa.array(sums[used, k]) for k in range(WIDTH))]
    yield pa.RecordBatch.from_arrays(columns, ["id", *(f"v{k}" for k in range(WIDTH))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """A unit vector for each id (zero where it has no neighbours), from all of ``docs``."""
    names = [f"v{k}" for k in range(WIDTH)]
    shares = docs.select("text").mapInArrow(_shares, "id int, " + ", ".join(f"{name} long" for name in names))
    summed = shares.groupBy("id").agg(*(F.sum(name).alias(name) for name in names)).toPandas()
    vectors = np.zeros((IDS, WIDTH), np.float32)
    vectors[summed["id"].to_numpy(np.int64)] = summed[names].to_numpy(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(text: str | None, vectors: np.ndarray, known: dict) -> np.ndarray:
    ids = ids_of(text, known)
    total = np.zeros(WIDTH)
    for start in range(0, len(ids), CHUNK):
        total += vectors[ids[start : start + CHUNK]].sum(axis=0, dtype=np.float64)
    return total / max(1, len(ids))


def _probability(model: Model, features: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_logits(model, features) / model.temperature, -50, 50)))


def _logits(model: Model, features: np.ndarray) -> np.ndarray:
    inner = np.tanh((features - model.centre) / model.scale @ model.w1 + model.b1)
    return inner @ model.w2 + model.b2


def fit(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, training: Training = Training()) -> Model:
    """The network on ``features`` (rows in a fixed order), and its temperature."""
    width, hidden = features.shape[1], training.hidden
    draw = np.random.default_rng(training.seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        flat = np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden)
        return Model(vectors, np.zeros(width), np.ones(width), *flat, float(np.log(share / (1 - share))), 1.0)
    order = draw.permutation(len(labels))
    aside, used = order[: len(order) // 5], order[len(order) // 5 :]
    x, y = features[used], labels[used].astype(float)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - centre) / scale
    weights = [draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    weights[3][0] = np.log(share / (1 - share))
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(training.rounds):
        for rows in np.array_split(draw.permutation(len(y)), max(1, len(y) // 128)):
            inner = np.tanh(x[rows] @ weights[0] + weights[1])
            wrong = (1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3][0], -50, 50))) - y[rows]) / len(rows)
            back = np.outer(wrong, weights[2]) * (1 - inner * inner)
            slopes = [x[rows].T @ back, back.sum(axis=0), inner.T @ wrong, np.array([wrong.sum()])]
            step += 1
            for w, slope, a, b in zip(weights, slopes, first, second):
                slope = slope + training.decay * w
                a += 0.1 * (slope - a)
                b += 0.001 * (slope * slope - b)
                w -= training.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    if len(set(labels[aside].tolist())) < 2:
        return model
    logits, y = _logits(model, features[aside]), labels[aside]
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    losses = [np.logaddexp(0, np.where(y == 1, -logits, logits) / heat).mean() for heat in heats]
    return model._replace(temperature=float(heats[int(np.argmin(losses))]))


def train(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """The model for ``docs``, from ``labels`` (doc_id, quality) of some of them."""
    vectors = word_vectors(docs)
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    known = stage(known.select("doc_id", F.when(F.col("quality") < 0.5, 0).otherwise(1).alias("label")), "labels")
    # Of many labelled rows a share by hash, so that what is broadcast and collected is bounded.
    part = min(1.0, training.sample / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = _Ids()
        for batch in batches:
            rows = [pooled(text.as_py(), shared.value, remembered) for text in batch.column("text")]
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "label", "vector"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    rows = texts.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, vector array<double>").toPandas()
    features = np.array(rows["vector"].tolist(), float).reshape(-1, WIDTH)
    # The same order whichever task came first, also of rows that share a doc_id.
    order = np.lexsort((*features.T, rows["doc_id"].to_numpy(np.int64)))
    return fit(features[order], rows["label"].to_numpy(np.int64)[order], vectors, training)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The probability that a text is good, as a column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        remembered = _Ids()
        for texts in batches:
            rows = [pooled(value, shared.value.vectors, remembered) for value in texts]
            features = np.array(rows).reshape(-1, WIDTH)
            yield pd.Series(_probability(shared.value, features))

    return probability(F.col(text))


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0))
