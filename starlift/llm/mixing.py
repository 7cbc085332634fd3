"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted for every cell of source, language and topic. The cells' weights start from
their tokens and are raked: scaled to the target share of every source, then of every language,
then of every topic, again and again until the margins of all three agree with the targets. A
cell's probability is its weight for each of its tokens, calibrated by one factor so that the
expected tokens are ``share`` of the corpus, with no probability above 1. Documents are then
drawn by a hash of id and text, so a run can be repeated.

Cells and margins are tables: their sums are combined before the shuffle, and only totals and
the largest deviation come to the driver.

A topic is the locality-sensitive code of a document's longer words: three sign sums over the
hashes of its distinct words, so texts with much common vocabulary share a topic. A caller
with topics of its own names their column.

Defined cases: a null source, language or topic is a value of its own. A null or empty text has
no tokens and topic 0; a cell without tokens has weight 0 and the corpus' probability. A target
for a value that has no tokens is left out and the others scaled up; a value without a target
gets weight 0. Repeated rows are drawn together. Columns beyond those named are not read; what
``sampled`` returns has all columns, whatever they are called.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from starlift.llm.common import fresh, stage, word_chunks

DIMENSIONS = ("source", "lang", "topic")
#: Letters from which a word counts for the topic, bits of a topic, words remembered by a task.
LONG, TOPIC_BITS, REMEMBERED = 6, 3, 1 << 20
#: Binary digits in which the words that have a bit are counted.
FIELD = 40


class Mix(NamedTuple):
    """share: of the corpus' tokens that the sample is to have. smoothing: targets are the
    shares found, to this power, where the caller gives none. closeness: largest relative
    deviation of a margin at which raking stops, after ``rounds`` rounds at most."""

    share: float = 0.5
    smoothing: float = 0.5
    closeness: float = 1e-4
    rounds: int = 40
    seed: int = 11


class _Bits(dict):
    """The topic bits of a word's hash, each in a field of its own, so that they add up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        code = zlib.crc32(word) >> 8
        found = self[word] = sum((code >> bit & 1) << FIELD * bit for bit in range(TOPIC_BITS))
        return found


def topic_of(words: set[bytes], bits: dict) -> int:
    """A bit is set if more than half of the words have it."""
    total = sum(map(bits.__getitem__, words))
    return sum((2 * (total >> FIELD * bit & (1 << FIELD) - 1) > len(words)) << bit for bit in range(TOPIC_BITS))


@F.pandas_udf(StructType().add("n_tokens", LongType()).add("topic", LongType()))
def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    bits = _Bits()
    for texts in batches:
        counts, topics = [], []
        for text in texts:
            words, count = set(), 0
            for some in word_chunks((text or "").encode("utf-8", "replace")):
                count += len(some)
                words.update(word for word in some if len(word) >= LONG)
            counts.append(count)
            topics.append(topic_of(words, bits))
        yield pd.DataFrame({"n_tokens": counts, "topic": topics})


def _value(column: str | Column) -> Column:
    """A key in which a null is a value of its own."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def shown(key: Column) -> Column:
    """The value that a key stands for."""
    return F.when(key != "", F.substring(key, F.lit(2), F.length(key)))


def _described(docs: DataFrame, topic: str | None) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of the cell's keys and the tokens."""
    measured, cell = fresh(docs, "_measured"), fresh(docs, "_cell")
    rows = docs.withColumn(measured, _measured(F.col("text")))
    keys = {"source": "source", "lang": "lang", "topic": topic or F.col(measured)["topic"]}
    parts = [_value(column).alias(name) for name, column in keys.items()]
    return rows.withColumn(cell, F.struct(*parts, F.col(measured)["n_tokens"].alias("n_tokens"))).drop(measured), cell


def _total(weight: Column | str) -> Column:
    """A sum of weights that doesn't depend on the order of the rows: weights are at most
    about 1, and whole multiples of 1e-17 add up exactly."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.sum((weight * 1e17).cast("long")) / 1e17


def _targets(cells: DataFrame, dimension: str, given: DataFrame | None, mix: Mix) -> DataFrame:
    """Shares (value, target) of a dimension that add up to 1 over the values with tokens."""
    found = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    if given is None:
        shares = found.select(dimension, F.pow("tokens", F.lit(mix.smoothing)).alias("target"))
    else:
        wanted = given.select(_value("value").alias(dimension), F.col("target").cast("double").alias("target"))
        shares = wanted.filter("target > 0").join(found.select(dimension), dimension, "left_semi")
    shares = stage(shares, "shares")
    total = shares.agg(F.sum(F.col("target").cast("decimal(30,8)"))).first()[0] or 1
    return shares.withColumn("target", F.col("target") / float(total))


def rake(cells: DataFrame, targets: dict[str, DataFrame], mix: Mix = Mix()) -> DataFrame:
    """``cells`` (the dimensions, tokens) with ``weight``: shares of a total of 1 whose margins
    are the targets, and ``deviation``: by how much, relative to it, the worst margin was off
    its target in the last round. Targets that contradict each other leave a large one, which
    is also warned of."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    weighed, worst = cells.withColumn("weight", F.col("tokens") / total), 0.0
    for _ in range(mix.rounds):
        off = F.lit(0.0)
        for dimension, target in targets.items():
            margin = weighed.groupBy(dimension).agg(_total("weight").alias("margin"))
            scaled = margin.join(target, dimension, "left").select(
                dimension, F.coalesce(F.when(F.col("margin") > 0, F.col("target") / F.col("margin")), F.lit(0.0)).alias("factor")
            )
            weighed = weighed.join(scaled, dimension)
            off = F.greatest(off, F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(0.0))
            kept = [c for c in weighed.columns if c not in ("weight", "factor", "off")]
            weighed = weighed.select(*kept, (F.col("weight") * F.col("factor")).alias("weight"), off.alias("off"))
            off = F.col("off")
        weighed = stage(weighed, "raked")
        worst = weighed.agg(F.max("off")).first()[0] or 0.0
        weighed = weighed.drop("off")
        if worst <= mix.closeness:
            break
    else:
        warnings.warn(f"raking ended after {mix.rounds} rounds with a margin off its target by {worst:.2%}", stacklevel=2)
    return weighed.withColumn("deviation", F.lit(float(worst)))


def calibrate(raked: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``raked`` with ``probability``: in proportion to the weight for each token, at most 1,
    and with ``share`` of all tokens expected (or all that have a weight, if they are fewer)."""
    ratio = F.col("weight") / F.nullif("tokens", F.lit(0))
    wanted = mix.share * (raked.agg(F.sum("tokens")).first()[0] or 0)
    factor, full = None, 0.0
    while True:  # cells that reach 1 stay there, so each pass ends or fixes more of them
        open_ = F.col("tokens") > 0 if factor is None else (F.col("tokens") > 0) & (ratio * factor < 1)
        row = raked.agg(
            _total(F.when(open_, F.col("weight"))).alias("open"),
            F.sum(F.when((F.col("weight") > 0) & ~open_, F.col("tokens"))).alias("full"),
        ).first()
        if not row["open"] or (factor is not None and (row["full"] or 0) == full):
            break
        full = row["full"] or 0
        factor = max(0.0, wanted - full) / row["open"]
    chance = F.least(F.lit(1.0), ratio * F.lit(factor or 0.0))
    return raked.withColumn("probability", F.when(F.col("tokens") > 0, chance).otherwise(F.lit(float(mix.share))))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, topic: str | None = None, mix: Mix = Mix()) -> tuple[DataFrame, str]:
    """``docs`` with one more column, named in the result: a struct of the cell (source, lang,
    topic as keys), n_tokens, weight, probability, deviation and sampled. ``targets`` may hold a table
    (value, target) for each dimension."""
    described, cell = _described(docs, topic)
    tokens = F.sum(F.col(cell)["n_tokens"]).alias("tokens")
    cells = described.groupBy(*(F.col(cell)[name].alias(name) for name in DIMENSIONS)).agg(tokens)
    cells = stage(cells, "cells")
    wanted = {name: _targets(cells, name, (targets or {}).get(name), mix) for name in DIMENSIONS}
    rated = stage(calibrate(rake(cells, wanted, mix), mix), "probabilities")
    rated = rated.select(*(F.col(name).alias(f"_rated_{name}") for name in DIMENSIONS), F.struct("weight", "probability", "deviation").alias(rate := fresh(described, "_rate")))
    same = [F.col(cell)[name] == F.col(f"_rated_{name}") for name in DIMENSIONS]
    joined = described.join(rated, same).drop(*(f"_rated_{name}" for name in DIMENSIONS))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(mix.seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    parts = [F.col(cell)[name].alias(name) for name in (*DIMENSIONS, "n_tokens")]
    parts += [F.col(rate)[name].alias(name) for name in ("weight", "probability", "deviation")]
    return joined.withColumn(cell, F.struct(*parts, (drawn < F.col(rate)["probability"]).alias("sampled"))).drop(rate), cell
