"""SimHash near-duplicates by anchor points.

A fingerprint bit is set when more than half of the hashes of a text's word shingles have it
set. Two fingerprints that differ in at most ``distance`` of 64 bits differ in at most half
of that in one of their two halves, so each half is searched for that smaller threshold.

The anchors of a half are the words of a covering code: the perfect binary Golay code over
23 of its bits (every word within 3 bits of one code word) times the perfect Hamming code
over 7 more (within 1 bit). Each fingerprint has one home anchor, and is copied to every
anchor that is home of some word within the threshold; for a perfect code these are exactly
the code words within covering radius plus threshold. So two linked fingerprints meet at the
home anchor of either. Only the fingerprints at one anchor are compared, all 64 bits.

Equal fingerprints are one node, so copies cost no comparison. An anchor that holds more
than ``CELL`` rows is cut into a grid of bounded cells which together compare the same pairs.
A cell returns a spanning forest of its links, never all pairs.

Defined cases: a text that is null or has no words has fingerprint zero, linked like any
other. Rows that repeat are linked by their equal fingerprints. The component is named by its
smallest doc_id; null ids don't name one unless there is no other. An empty table gives no
rows. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import row_key, stage, word_chunks
from starlift.llm.graph import components, forest

SEED = 42
#: Rows of an anchor that one task compares; more are cut into a grid.
CELL = 8192
#: Pairs that are compared at a time.
PAIRS = 1 << 21

# The generator polynomial of the binary Golay code, x^11 to 1.
GOLAY = 0b101011100011

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64 bits of a text, unsigned."""
    counts, total = np.zeros((8, 256), np.int64), 0
    last: list[bytes] = []
    for more in word_chunks((text or "").encode("utf-8", "replace").lower()):
        part = last + more
        shingles = map(b" ".join, zip(*(part[at:] for at in range(words))))
        hashes = [xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles]
        if hashes:
            octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
            counts += np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
        total += len(hashes)
        last = part[max(0, len(part) - words + 1) :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(last), SEED) if last else 0
    set_bits = (counts @ _BITS).ravel() * 2 > total
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def _golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the words x^11 * high part, and the error pattern of each remainder."""

    def remainder(word: int) -> int:
        for at in range(22, 10, -1):
            if word >> at & 1:
                word ^= GOLAY << at - 11
        return word

    high = np.array([remainder(part << 11) for part in range(1 << 12)], np.int64)
    errors = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for places in combinations(range(23), weight):
            pattern = sum(1 << at for at in places)
            errors[remainder(pattern)] = pattern
    return high, errors


_HIGH, _ERRORS = _golay_errors()


def _hamming_home(word: np.ndarray) -> np.ndarray:
    place = np.zeros_like(word)
    for at in range(7):
        place ^= np.where(word >> at & 1, at + 1, 0)
    return np.where(place > 0, word ^ (1 << np.maximum(place, 1) - 1), word)


def home(half: np.ndarray) -> np.ndarray:
    """The anchor of each 32-bit half: 23 bits of Golay code, 7 bits of Hamming code."""
    low, rest = half & 0x7FFFFF, half >> 23 & 0x7F
    golay = low ^ _ERRORS[_HIGH[low >> 11] ^ low & 0x7FF]
    return golay << 7 | _hamming_home(rest)


def anchors(half: np.ndarray, threshold: int) -> np.ndarray:
    """A row per half: every anchor it is copied to, its home first; -1 where repeated."""
    found = [home(half)]
    for weight in range(1, threshold + 1):
        found += [home(half ^ sum(1 << at for at in places)) for places in combinations(range(30), weight)]
    every = np.stack(found, axis=1)
    rest = np.sort(every[:, 1:], axis=1)
    again = np.zeros(rest.shape, bool)
    again[:, 1:] = rest[:, 1:] == rest[:, :-1]
    rest[again | (rest == every[:, :1])] = -1
    return np.concatenate([every[:, :1], rest], axis=1)


def _fingerprints(words: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(text.as_py(), words) for text in batch.column("text")], np.uint64)
            columns = [*(batch.column(name) for name in names), pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "bits"])

    return run


def _placed(threshold: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = batch["bits"].to_numpy(np.int64)
            unsigned = bits.view(np.uint64)
            for side in (0, 1):
                half = (unsigned >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                for start in range(0, len(half), 4096):
                    at = anchors(half[start : start + 4096], threshold)
                    row, column = np.nonzero(at >= 0)
                    yield pd.DataFrame(
                        {"anchor": at[row, column] | side << 30, "bits": bits[start + row], "home": column == 0}
                    )

    return run


def _linked(distance: int):
    """Spanning forests of the links within the (sorted) groups of a partition."""

    def compare(cells: np.ndarray, bits: np.ndarray, homes: np.ndarray) -> pd.DataFrame:
        begins = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        ends = np.r_[begins[1:], len(cells)]
        group = np.cumsum(np.r_[False, cells[1:] != cells[:-1]])
        at_home = np.flatnonzero(homes)
        counts = (ends - begins)[group[at_home]]
        labels = np.arange(len(cells))
        done = 0
        while done < len(at_home):
            few = max(1, int(np.searchsorted(np.cumsum(counts[done:]), PAIRS)))
            left = np.repeat(at_home[done : done + few], counts[done : done + few])
            first = np.cumsum(counts[done : done + few]) - counts[done : done + few]
            right = np.arange(len(left)) - np.repeat(first, counts[done : done + few]) + begins[group[left]]
            differ = np.bitwise_count(bits[left] ^ bits[right])
            near = (differ <= distance) & (differ > 0)
            labels = forest(labels, left[near], right[near])
            done += few
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pd.DataFrame({"src": bits[linked], "dst": bits[labels[linked]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            cells = batch["cell"].to_numpy()
            if not len(cells):
                continue
            whole = int(np.searchsorted(cells, cells[-1]))  # the last group may go on
            if whole:
                yield compare(cells[:whole], batch["bits"].to_numpy()[:whole], batch["home"].to_numpy()[:whole])
            rest = batch.iloc[whole:]
        if rest is not None and len(rest):
            yield compare(rest["cell"].to_numpy(), rest["bits"].to_numpy(), rest["home"].to_numpy())

    return run


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (src, dst) between the distinct 64-bit ``bits`` of ``nodes`` that connect all
    that are within ``distance`` bits: a spanning forest for each anchor."""
    # AQE may not merge these partitions: a few megabytes of nodes become many copies.
    spread = nodes.select("bits").repartition(F.xxhash64("bits"))
    placed = spread.mapInPandas(_placed(distance // 2), "anchor long, bits long, home boolean")
    placed = stage(placed, "anchors")
    # A home row is compared with all rows of its anchor. Where an anchor is too full, home
    # rows go to one row of the grid and copies to one column, so each pair meets once.
    crowded = placed.groupBy("anchor").count().filter(F.col("count") > CELL)
    crowded = crowded.select("anchor", F.ceil(F.col("count") / CELL).cast("int").alias("side"))
    part = F.pmod(F.xxhash64("bits", F.lit(1)), F.coalesce("side", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("side", F.lit(1)) - 1)
    line = F.transform(every, lambda k: F.struct(part.alias("i"), k.alias("j")))
    column = F.transform(every, lambda k: F.struct(k.alias("i"), part.alias("j")))
    roles = F.array_union(F.when(F.col("home"), line).otherwise(F.array().cast("array<struct<i:int,j:int>>")), column)
    dealt = placed.join(crowded, "anchor", "left").select(
        "anchor", "bits", "home", part.alias("part"), F.explode(roles).alias("at")
    )
    cell = F.xxhash64("anchor", "at.i", "at.j")
    as_home = F.col("home") & (F.col("part") == F.col("at.i"))
    met = dealt.select(cell.alias("cell"), "bits", as_home.alias("home"))
    return (
        met.repartition("cell").sortWithinPartitions("cell").mapInPandas(_linked(distance), "src long, dst long")
    )


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, row: str | None = None) -> DataFrame:
    """Per row: doc_id, text_key, bits (signed), root (the fingerprint that names the
    component, one of it) and component_id; with ``row``, a column of longs, it as row_id too."""
    names = ["doc_id", "text_key"] + ["row_id"] * (row is not None)
    more = [] if row is None else [F.col(row).alias("row_id")]
    spread = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("text_key"), *more, "text")
    marked = spread.mapInArrow(_fingerprints(words, names), ", ".join(f"{name} long" for name in [*names, "bits"]))
    marked = stage(marked, "simhash")
    nodes = marked.groupBy("bits").agg(F.min("doc_id").alias("smallest"))
    nodes = stage(nodes, "simhash-nodes")
    joined = components(links(nodes, distance))
    named = nodes.join(joined.withColumnRenamed("node", "bits"), "bits")
    smallest = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = named.join(smallest, "root").select("bits", "root", "component_id")
    classes = nodes.join(named, "bits", "left").select(
        "bits",
        F.coalesce("root", "bits").alias("root"),
        F.when(F.col("root").isNull(), F.col("smallest")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # Written, so that the join shuffles both sides plainly and a hot fingerprint can be split.
    return marked.join(stage(classes, "classes"), "bits").select(*names, "bits", "root", "component_id")


def as_hex(bits: str) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
