"""Benchmark decontamination by a distributed positional inverted index.

The documents are cut into blocks of bounded text. A block's index holds, for every word in
it, the ascending list of places where it stands (its postings); places run on through the
block, with a gap after each document (2 * ``slop`` + 1 places: the middle one is too far from
both), so no phrase, exact or near, crosses into the next one. The index is
written as a table: one row for each block, words and postings as arrays, few rows to a row
group, so that a task holds a few blocks at a time however many its file has.

A search takes the test items' windows to every block. A window whose words all occur there
starts from the postings of its rarest word, less that word's offset, and is intersected with
the other words' lists, rarest first; what the two rarest words of a window leave is shared by
the windows that hold both. With ``slop`` a window also matches nearly: from some place on,
every word stands within that many places of where it ought to. Nothing is shuffled but the
findings.

The items are cut into parts of at most ``part_words`` words by Spark and written as a table.
A part is fetched, broadcast, searched for and dropped before the next one, so what the driver
and the executors hold is bounded however many items there are and however long one is. Each
part reads the index once.

Defined cases: a null or empty text has no words and no findings. Items without words are
passed over; items with the same id count once, and a null id is listed as an empty string.
Repeated documents are searched each. An empty benchmark leaves every document clean. A very
long text makes a block of its own, which one task holds. Columns beyond doc_id and text, and
item_id and text, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import row_key, stage

#: Bytes of text after which a block is closed.
BLOCK = 2 << 20
#: Blocks in a row group of the index. Readers decode up to 4096 rows of a group at once, and
#: writers hold at least 100 of one before they look at its bytes: too many of this size.
TOGETHER = 4
_TO_SPACE = bytes(
    byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else byte + 32 if 0x41 <= byte <= 0x5A else 32
    for byte in range(256)
)

_INDEX = (
    "block long, terms array<string>, counts array<int>, places array<int>, "
    "doc_ids array<long>, text_keys array<long>, starts array<int>, lengths array<int>"
)
_FOUND = "block long, at int, runs array<struct<a:int,b:int>>, items array<string>, near_items array<string>"
_PART = "part long, names array<string>, words array<binary>, ids array<int>, lengths array<int>"


class Search(NamedTuple):
    """window: words of a phrase. slop: places a word may be off in a near match."""

    window: int = 10
    slop: int = 0
    part_words: int = 2_000_000


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_TO_SPACE).split()


class _Block:
    def __init__(self, gap: int):
        self.gap = gap
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.end = self.size = 0

    def add(self, doc_id: int | None, text_key: int, text: str | None) -> None:
        words, known = words_of(text), self.vocabulary
        for word in set(words):
            known.setdefault(word, len(known))
        self.terms.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.places.append(np.arange(self.end, self.end + len(words), dtype=np.int32))
        self.docs.append((doc_id, text_key, self.end, len(words)))
        self.end += len(words) + self.gap
        self.size += len(text or "")

    def row(self, block: int) -> pa.RecordBatch:
        terms, places = np.concatenate(self.terms), np.concatenate(self.places)
        order = np.argsort(terms, kind="stable")
        counts = np.bincount(terms, minlength=len(self.vocabulary))
        # Differences compress to about a byte; each list starts from zero.
        places = places[order]
        steps = np.diff(places, prepend=0)
        begins = np.cumsum(counts) - counts
        if len(places):
            steps[begins] = places[begins]
        ids, keys, starts, lengths = zip(*self.docs)
        arrays = [
            ("block", pa.array([block], pa.int64())),
            ("terms", _one(pa.array(list(self.vocabulary), pa.binary()).cast(pa.string()))),
            ("counts", _one(pa.array(counts.astype(np.int32)))),
            ("places", _one(pa.array(steps.astype(np.int32)))),
            ("doc_ids", _one(pa.array(ids, pa.int64()))),
            ("text_keys", _one(pa.array(keys, pa.int64()))),
            ("starts", _one(pa.array(starts, pa.int32()))),
            ("lengths", _one(pa.array(lengths, pa.int32()))),
        ]
        return pa.RecordBatch.from_arrays([a for _, a in arrays], [name for name, _ in arrays])


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _build(gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block(gap)
        for batch in batches:
            for doc_id, key, text in zip(*(batch.column(name) for name in ("doc_id", "text_key", "text"))):
                block.add(doc_id.as_py(), key.as_py(), text.as_py())
                if block.size >= BLOCK:
                    yield block.row(number)
                    number, block = number + 1, _Block(gap)
        if block.docs:
            yield block.row(number)

    return run


def build_index(docs: DataFrame, slop: int = 0) -> DataFrame:
    """The positional index of (doc_id, text), as a written table with a row for each block;
    for searches with at most this ``slop``."""
    wanted = docs.select("doc_id", row_key().alias("text_key"), "text")
    few = {"parquet.block.row.count.limit": str(TOGETHER)}
    return stage(wanted.mapInArrow(_build(2 * slop + 1), _INDEX), "postings", **few)


class _Part:
    """Windows of some items, over a vocabulary of their own. ``ids`` are the items' words as
    places in the vocabulary, one item after the other."""

    def __init__(self, names: list[str], words: list[bytes], ids: list[int], lengths: list[int], window: int):
        self.items, self.words = names, words
        sizes = np.array(lengths, np.int64)
        begins = np.cumsum(sizes) - sizes
        short = np.minimum(sizes, window)
        each = sizes - short + 1
        self.owners = np.repeat(np.arange(len(sizes)), each)
        self.lengths = short[self.owners]
        starts = begins[self.owners] + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        offsets = np.arange(window)
        filled = np.append(np.array(ids, np.int64), np.full(window, -1))
        self.windows = np.where(offsets < self.lengths[:, None], filled[starts[:, None] + offsets], -1)


def _nearest(sorted_places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How far the nearest of the places is from each wanted one."""
    after = np.searchsorted(sorted_places, wanted)
    right = np.abs(sorted_places[np.minimum(after, len(sorted_places) - 1)] - wanted)
    left = np.abs(sorted_places[np.maximum(after - 1, 0)] - wanted)
    return np.minimum(left, right)


def _search(part_of, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: _Part = part_of.value
        wanted = pa.array(part.words, pa.binary()).cast(pa.string())
        for batch in batches:
            for at in range(batch.num_rows):
                yield from found(part, wanted, {name: batch.column(name)[at] for name in batch.schema.names})

    def found(part: _Part, wanted: pa.Array, row: dict) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(row["counts"].values.to_numpy(zero_copy_only=False).astype(np.int64))
        steps = row["places"].values.to_numpy(zero_copy_only=False).astype(np.int64)
        where = pc.index_in(wanted, value_set=row["terms"].values).fill_null(-1).to_numpy(zero_copy_only=False)
        counts = np.diff(ends, prepend=0)
        often = np.where(where >= 0, counts[where] if len(counts) else 0, 0)
        often = np.append(often, np.iinfo(np.int64).max)  # of the filling of short windows
        lists: dict[int, np.ndarray] = {}

        def postings(word: int) -> np.ndarray:
            if word not in lists:
                at = where[word]
                lists[word] = np.cumsum(steps[ends[at] - counts[at] : ends[at]])
            return lists[word]

        pairs: dict[tuple, np.ndarray] = {}

        def together(first: int, second: int, apart: int) -> np.ndarray:
            """Places of the first word with the second so far on, give or take a slop for each."""
            if (first, second, apart) not in pairs:
                at = postings(first)
                pairs[first, second, apart] = at[_nearest(postings(second), at + apart) <= 2 * slop]
            return pairs[first, second, apart]

        alive = np.flatnonzero((often[part.windows] > 0).all(axis=1))
        ranked = np.argsort(often[part.windows[alive]], axis=1, kind="stable")
        starts = row["starts"].values.to_numpy(zero_copy_only=False).astype(np.int64)
        places, sizes, owners, near_at, near_owners = [], [], [], [], []
        for window, offsets, words in zip(alive.tolist(), ranked.tolist(), part.windows[alive].tolist()):
            size = int(part.lengths[window])
            rarest = offsets[0]
            if size == 1:
                begin = postings(words[0])
            else:
                begin = together(words[rarest], words[offsets[1]], offsets[1] - rarest) - rarest
            if not len(begin):
                continue
            exact = begin
            for offset in offsets[1:size]:
                exact = exact[_nearest(postings(words[offset]), exact + offset) == 0]
                if not len(exact):
                    break
            if len(exact):
                places.append(exact)
                sizes.append(np.full(len(exact), size))
                owners.append(np.full(len(exact), part.owners[window]))
            if slop:
                # By the rarest word's own place: the first one's could lie before the document.
                own = np.repeat(begin + rarest, 2 * slop + 1)
                begin = (begin[:, None] + np.arange(-slop, slop + 1)).ravel()
                for offset in offsets[1:size]:
                    kept = _nearest(postings(words[offset]), begin + offset) <= slop
                    begin, own = begin[kept], own[kept]
                    if not len(begin):
                        break
                if len(begin):
                    near_at.append(own)
                    near_owners.append(np.full(len(own), part.owners[window]))
        if not places and not near_at:
            return
        none = np.zeros(0, np.int64)
        place, size, owner = (np.concatenate(x) if x else none for x in (places, sizes, owners))
        doc = np.searchsorted(starts, place, side="right") - 1
        near_place, near_owner = (np.concatenate(x) if x else none for x in (near_at, near_owners))
        near_doc = np.searchsorted(starts, near_place, side="right") - 1
        order = np.argsort(near_doc, kind="stable")
        near_doc, near_owner = near_doc[order], near_owner[order]
        order = np.argsort(doc, kind="stable")
        doc, place, size, owner = doc[order], place[order], size[order], owner[order]
        out = []
        for d in np.union1d(doc, near_doc):
            a, b = np.searchsorted(doc, [d, d + 1])
            names = [part.items[o] for o in np.unique(owner[a:b])]
            runs = _merged(place[a:b] - starts[d], size[a:b])
            a, b = np.searchsorted(near_doc, [d, d + 1])
            near_names = [part.items[o] for o in np.unique(near_owner[a:b])]
            out.append((row["block"].as_py(), int(d), runs, names, near_names))
        yield from _batches(out)

    return run


def _merged(begins: np.ndarray, sizes: np.ndarray) -> list[dict]:
    """Non-overlapping runs that cover the same words."""
    runs: list[dict] = []
    for a, b in sorted(zip(begins.tolist(), (begins + sizes).tolist())):
        if runs and a <= runs[-1]["b"]:
            runs[-1]["b"] = max(runs[-1]["b"], b)
        else:
            runs.append({"a": a, "b": b})
    return runs


_FOUND_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("at", pa.int32()),
        ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
        ("items", pa.list_(pa.string())),
        ("near_items", pa.list_(pa.string())),
    ]
)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = [pa.array(list(values), kind) for values, kind in zip(zip(*rows), _FOUND_ARROW.types)]
        yield pa.RecordBatch.from_arrays(columns, schema=_FOUND_ARROW)


def _cut(search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names, lengths, ids, vocabulary = [], [], [], {}

        def row() -> pa.RecordBatch:
            values = [pa.array(names, pa.string()), pa.array(list(vocabulary), pa.binary()), pa.array(ids, pa.int32()), pa.array(lengths, pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *map(_one, values)], ["part", "names", "words", "ids", "lengths"])

        for batch in batches:
            for name, text in zip(batch.column("item"), batch.column("text")):
                words = words_of(text.as_py())
                # Pieces of a long item share all words of a window but one.
                for start in range(0, max(1, len(words) - search.window + 1) if words else 0, search.part_words - search.window + 1):
                    piece = words[start : start + search.part_words]
                    if ids and len(ids) + len(piece) > search.part_words:
                        yield row()
                        number, names, lengths, ids, vocabulary = number + 1, [], [], [], {}
                    names.append(name.as_py())
                    lengths.append(len(piece))
                    ids += [vocabulary.setdefault(word, len(vocabulary)) for word in piece]
        if ids:
            yield row()

    return run


def cut_items(benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """The items' words in parts of bounded size, as a written table with a row for each."""
    if search.part_words < search.window:
        raise ValueError(f"a part of {search.part_words} words cannot hold a window of {search.window}")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    # A word takes two characters at least, with what parts it from the next.
    total = benchmark.agg(F.sum(F.char_length("text")).alias("total")).first()["total"] or 0
    items = items.repartition(1 + total // (2 * search.part_words))
    return stage(items.mapInArrow(_cut(search), _PART), "items")


def find_phrases(index: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """Per document with a finding: block, at (its place in the block), runs (words a to b
    that windows cover), items (their ids), near_items (ids of items of which a window matches
    within the slop; those that match exactly too are among them if there is a slop)."""
    spark = index.sparkSession
    parts = cut_items(benchmark, search)
    found = []
    for number in parts.select("part").toLocalIterator():
        row = parts.filter(F.col("part") == number["part"]).first()
        sent = spark.sparkContext.broadcast(_Part(*(row[name] for name in ("names", "words", "ids", "lengths")), search.window))
        met = index.select("block", "terms", "counts", "places", "starts").mapInArrow(_search(sent, search.slop), _FOUND)
        found.append(stage(met, "findings"))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], _FOUND)
    if len(found) == 1:
        return found[0]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("block", "at").agg(*(F.flatten(F.collect_list(name)).alias(name) for name in ("runs", "items", "near_items")))


def contamination(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, n_items, items (sorted), n_near,
    near_items (sorted): the items that only match nearly."""
    index = build_index(docs, search.slop)
    one = F.explode(F.arrays_zip("doc_ids", "text_keys", "lengths", F.sequence(F.lit(0), F.size("doc_ids") - 1).alias("at")))
    rows = index.select("block", one.alias("d")).select(
        "block", F.col("d.at").alias("at"), F.col("d.doc_ids").alias("doc_id"), "d.text_keys", F.col("d.lengths").cast("long").alias("n_words")
    )
    found = find_phrases(index, benchmark, search)
    joined = rows.join(found, ["block", "at"], "left")
    # Words in the union of the runs: each adds what lies beyond the furthest end so far.
    runs = F.array_sort(F.coalesce("runs", F.array().cast("array<struct<a:int,b:int>>")))
    hit = F.aggregate(
        runs,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda state, run: F.struct(
            F.greatest(state["end"], run["b"]).alias("end"),
            (state["hit"] + F.greatest(F.lit(0), run["b"] - F.greatest(state["end"], run["a"]))).alias("hit"),
        ),
        lambda state: state["hit"].cast("long"),
    )
    named = {name: F.coalesce(name, F.array().cast("array<string>")) for name in ("items", "near_items")}
    items = F.array_sort(F.array_distinct(named["items"]))
    near_items = F.array_sort(F.array_except(named["near_items"], named["items"]))
    return joined.select(
        "doc_id", F.col("text_keys").alias("text_key"), "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        items.alias("items"), F.size(near_items).cast("long").alias("n_near"), near_items.alias("near_items"),
    )


def items_digest(items: str) -> Column:
    return F.sha2(F.array_join(items, ","), 256)
