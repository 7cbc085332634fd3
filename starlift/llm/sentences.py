"""Substring dedup by sliding sentence spans.

A text is cut into sentences, and a sentence of more than ``longest`` words after content-defined
words: those whose hash is smaller than that of the ``radius`` words before and not larger than
that of the ``radius`` words after. So the cuts within a passage don't depend on where its
sentence began, and a passage that begins and ends inside sentences has the same units between
its outermost cuts wherever it stands. What no such word cuts is cut every ``most`` words.

Every run of ``run`` consecutive units is hashed (128 bits of its words, white space evened out)
and all runs are joined globally. Of equal runs the first stays, in order of doc_id (null ids
last), place and digest of the text; the units that any other one covers are removed from its
row. Three sentences of up to ``longest`` words are a span; of a passage of over 50 words all but
some words at its edges goes, as units lie within two cuts.

Counts and first places are combined before the shuffle. The join back to the places has one
row of firsts for a hash, so a hash with very many places can be split over tasks.

Defined cases: a null text counts as empty; a text of fewer than ``run`` units has no run and
stays whole. Rows that share a doc_id, or have none, are texts of their own. Of rows that repeat
doc_id and text one is taken as the others' first. White space before the first word is not kept.
A task holds the words of one text at a time, however long. A doc_id that isn't a whole number
raises. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import stage

# A sentence runs to full stops, or the like, before white space, or to the end of its line.
SPACE = " \t\n\x0b\f\r"
SENTENCE = r"(?:[^.!?\n]|[.!?]+[^.!? \t\n\x0b\f\r])+[.!?]*[ \t\n\x0b\f\r]*|[.!?]+[ \t\n\x0b\f\r]*"
WORD = r"[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*"
_SENTENCE, _WORD = re.compile(SENTENCE), re.compile(WORD)


class Spans(NamedTuple):
    """run: units of a span. longest: words of a sentence that is not cut. radius: words on
    either side that a cutting word is compared with. most: words of a unit."""

    run: int = 3
    longest: int = 8
    radius: int = 3
    most: int = 16


#: Words whose hashes a task remembers, and a number above all hashes.
REMEMBERED, ABOVE = 1 << 20, 1 << 32


class _Hashes(dict):
    """Hashes of words with the white space after them, remembered as they come."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = int(hashlib.md5(word.rstrip(SPACE).encode("utf-8", "replace")).hexdigest()[:8], 16)
        return found


def _cuts(sentences: list[list[str]], spans: Spans, known: dict[str, int]) -> Iterator[list[int]]:
    """For each sentence the places after which it is cut by content."""
    apart = [ABOVE] * spans.radius
    hashes = list(apart)
    for words in sentences:
        hashes += map(known.__getitem__, words)
        hashes += apart
    h = np.array(hashes, np.int64)
    end = len(h) - spans.radius
    middle = h[spans.radius : end]
    cut = middle < ABOVE
    for k in range(1, spans.radius + 1):
        cut &= (middle < h[spans.radius - k : end - k]) & (middle <= h[spans.radius + k : end + k])
    places = (np.flatnonzero(cut) + 1).tolist()
    begin = at = 0
    for words in sentences:
        found = []
        while at < len(places) and places[at] <= begin + len(words):
            found.append(places[at] - begin)
            at += 1
        yield found
        begin += len(words) + spans.radius


def units(text: str | None, spans: Spans = Spans(), known: dict[str, int] | None = None) -> list[str]:
    """The pieces whose concatenation is the text without its leading white space."""
    known = _Hashes() if known is None else known
    pieces: list[str | None] = []
    long: list[list[str]] = []
    for sentence in _SENTENCE.findall((text or "").lstrip(SPACE)):
        words = _WORD.findall(sentence.lstrip(SPACE)) if len(sentence) > 2 * spans.longest else []
        if len(words) <= spans.longest:  # so few characters can't be more words
            pieces.append(sentence)
        else:
            pieces.append(None)
            long.append(words)
    if not long:
        return pieces
    cut = zip(long, _cuts(long, spans, known))
    found: list[str] = []
    for piece in pieces:
        if piece is not None:
            found.append(piece)
            continue
        words, places = next(cut)
        begin = 0
        for end in [*places, len(words)]:
            found += ["".join(words[at : min(end, at + spans.most)]) for at in range(begin, end, spans.most)]
            begin = end
    return found


def _normal(unit: str) -> bytes:
    return b" ".join(unit.encode("utf-8", "replace").split())


def _hashed(spans: Spans):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            places: list[int] = []
            found = bytearray()
            owners: list[int] = []
            for row, text in enumerate(batch.column("text")):
                keys = [_normal(unit) for unit in units(text.as_py(), spans, known)]
                runs = max(0, len(keys) - spans.run + 1)
                owners += [row] * (runs + 1)
                places += [-1 - len(keys), *range(runs)]  # a row of its own tells how many units there are
                found += bytes(16)
                for run_of in zip(*(keys[k:] for k in range(spans.run))):
                    found += xxhash.xxh3_128_digest(b"\n".join(run_of))
            halves = np.frombuffer(bytes(found), np.int64).reshape(-1, 2)
            ids, texts = (batch.column(name).take(pa.array(owners, pa.int64())) for name in ("doc_id", "text_key"))
            columns = [ids, texts, pa.array(places, pa.int32()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "at", "high", "low"])

    return run


def _cut(spans: Spans):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            kept, gones = [], []
            for text, size, removed, copy in zip(*(batch.column(name) for name in ("text", "units", "removed", "copy"))):
                runs = range(size.as_py() - spans.run + 1) if copy.as_py() else removed.as_py() or ()
                gone = {place + k for place in runs for k in range(spans.run)}
                pieces = units(text.as_py(), spans, known) if gone else [(text.as_py() or "").lstrip(SPACE)]
                kept.append("".join(piece for k, piece in enumerate(pieces) if k not in gone))
                gones.append(len(gone))
            columns = [batch.column("doc_id"), pa.array(kept, pa.string()), batch.column("units"), pa.array(gones, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_sentences", "n_removed"])

    return run


def text_digest(text: str) -> Column:
    """60 bits of the text's MD5, which order rows that share a doc_id."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def without_repeats(docs: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """Per row: doc_id, kept (the text that stays), n_sentences and n_removed (units)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest("text").alias("text_key"), "text")
    placed = stage(texts.mapInArrow(_hashed(spans), "doc_id long, text_key long, at int, high long, low long"), "spans")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "at", "text_key")
    runs = placed.filter("at >= 0")
    firsts = runs.groupBy("high", "low").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1").select("high", "low", "first")
    # Written, so that the join shuffles both sides plainly and a hot hash can be split.
    firsts = stage(firsts, "firsts")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("at") == F.col("first.at")) & (F.col("text_key") == F.col("first.text_key"))
    later = runs.join(firsts, ["high", "low"]).filter(~is_first)
    # A row's later runs: as many as it has units at most.
    by_row = (F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"))
    removed = later.groupBy(*by_row).agg(F.collect_set("at").alias("removed"))
    sizes = placed.filter("at < 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"), F.max(-1 - F.col("at")).cast("long").alias("units"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    marks = sizes.join(removed, same, "left").select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"), "removed", "rows", "units")
    # Written, so that a row that is repeated very often can be split over tasks.
    marks = stage(marks, "marks")
    once = texts.join(marks.filter("rows = 1"), same).select("doc_id", "text", "units", "removed", F.lit(False).alias("copy"))
    # Rows that repeat whole: one keeps what is first, all runs of the others stand in that one.
    # They are few, or one text often, so their marks are a small table of their own.
    several = texts.join(stage(marks.filter("rows > 1"), "copies"), same).dropDuplicates(["doc_id", "text_key"])
    several = several.select("doc_id", "text", "units", "removed", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("number"))
    several = several.select("doc_id", "text", "units", "removed", (F.col("number") > 1).alias("copy"))
    return once.unionByName(several).mapInArrow(_cut(spans), "doc_id long, kept string, n_sentences long, n_removed long")
