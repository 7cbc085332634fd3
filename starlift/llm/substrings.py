"""Substring dedup by suffix arrays over shards.

Every string of ``length`` bytes that starts at two places, of one document or of two, is
repeated; each byte that a repeated one covers is removed. Nothing but the strings' bytes
decides which shard they meet in: the smallest of the hashes of its ``GRAM``-byte grams. Strings
at successive places with the same smallest hash make a segment, so a text is about twice as
many segments as ``length`` - ``GRAM`` goes into it, and equal strings lie in segments of equal
hash. Segments whose hash is alone in the corpus can't hold a repeated string and go.

Equal segments are counted, and repeated as a whole, so nothing within them is looked for: they
only show what repeats in others. One of each goes on: the bytes of those
that share their hash with a different segment, or that repeat within themselves, are put
together into shards of whole groups, and the shard's suffix array (induced sorting) and
permuted common prefixes show the strings that stand twice. A group of more than ``GROUP``
bytes is never put into one task: its strings are hashed one by one (128 bits) and counted in
the cluster, which gives the same strings. So no group is left out, however large.

Texts are packed before they are shuffled. Defined cases: a null text counts as empty; a text
shorter than ``length`` keeps all its bytes. Repeated rows are documents of their own, and each
other's copies. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import row_key, stage
from starlift.llm.suffixes import common_prefixes, suffix_array

#: Bytes of a gram, of a shard, and of a group that may go into one shard.
GRAM, SHARD, GROUP = 50, 1 << 20, 1 << 20
#: Strings whose grams are hashed at a time; their places must fit into 20 bits.
CHUNK = 1 << 19

_PLACE = np.uint64((1 << 20) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(of: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(n - 1, of, np.uint64)]).cumprod(dtype=np.uint64)


class _Hashes:
    """Hashes of all grams of a text: differences of a prefix sum of byte * odd ** place,
    shifted back by the inverse power, and mixed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.letters = np.random.default_rng(0).integers(1, 1 << 63, 256, np.uint64)

    def grams(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            size = max(1 << 16, 2 * len(data))
            self.up = _powers(int(_ODD), size)
            self.down = _powers(pow(int(_ODD), -1, 1 << 64), size)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=sums[1:])
        found = (sums[GRAM:] - sums[:-GRAM]) * self.down[: len(data) - GRAM + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found


def _sliding_least(values: np.ndarray, wide: int) -> np.ndarray:
    """The least of every ``wide`` neighbouring values."""
    blocks = np.full(-(-len(values) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, wide)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    many = len(values) - wide + 1
    return np.minimum(backward[:many], onward[wide - 1 : wide - 1 + many])


def segments(data: bytes, length: int, hashes: _Hashes) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece of a text: the segments' hash, begin, size, and whether their smallest hash
    stands at more than one place, without which no string can repeat within."""
    wide = length - GRAM + 1
    octets = np.frombuffer(data, np.uint8)
    for start in range(0, len(data) - length + 1, CHUNK):
        part = octets[start : start + CHUNK + length - 1]
        grams = hashes.grams(part)
        # The leftmost of the smallest, by the upper bits; the lower ones are its place.
        marked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (_sliding_least(marked, wide) & _PLACE).astype(np.int64)
        value = grams[place]
        begins = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        ends = np.append(begins[1:], len(value))
        yield value[begins].view(np.int64), begins + start, ends - begins + length - 1, place[begins] != place[ends - 1]


_SEGMENTS = "mh long, sh long, start int, size int, inner boolean, doc_id long, text_key long"


def _cut(length: int):
    names = [part.split()[0] for part in _SEGMENTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            found: list[tuple] = []
            digests: list[int] = []
            owners: list[np.ndarray] = []
            for row, text in enumerate(batch.column("text")):
                data = (text.as_py() or "").encode("utf-8", "replace")
                view = memoryview(data)
                for part in segments(data, length, hashes):
                    found.append(part)
                    owners.append(np.full(len(part[0]), row))
                    digests += [xxhash.xxh3_64_intdigest(view[a : a + n]) for a, n in zip(part[1].tolist(), part[2].tolist())]
            if found:
                value, begin, size, inner = (np.concatenate(column) for column in zip(*found))
                owner = pa.array(np.concatenate(owners))
                columns = [
                    value, np.array(digests, np.uint64).view(np.int64), begin.astype(np.int32), size.astype(np.int32), inner,
                ]
                columns = [pa.array(column) for column in columns] + [batch.column(name).take(owner) for name in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [pack.compress((text.as_py() or "").encode("utf-8", "replace")) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(texts, pa.binary())], ["doc_id", "text_key", "packed"])


def _unpacked(value: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value.as_py())


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that are asked for from each text."""
    for batch in batches:
        for packed, wanted in zip(batch.column("packed"), batch.column("wanted")):
            data, rows = _unpacked(packed), wanted.as_py()
            columns = [
                pa.array([row["mh"] for row in rows], pa.int64()), pa.array([row["sh"] for row in rows], pa.int64()),
                pa.array([row["crowded"] for row in rows], pa.bool_()), pa.array([row["whole"] for row in rows], pa.bool_()),
                pa.array([data[row["start"] : row["start"] + row["size"]] for row in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["mh", "sh", "crowded", "whole", "octets"])


_RUNS = "array<struct<a:int,b:int>>"
_RUNS_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def repeated(parts: list[bytes], length: int) -> list[list[dict]]:
    """Of each part of a shard, the runs of its bytes that are covered by strings of ``length``
    which stand at two places of the parts."""
    # 0 ends the shard, 1 ends a part, so no string of two parts equals one of a single part.
    symbols = np.ones(sum(map(len, parts)) + len(parts) + 1, np.int64)
    begins = np.cumsum([0, *(len(part) + 1 for part in parts)])
    for begin, part in zip(begins, parts):
        symbols[begin : begin + len(part)] = np.frombuffer(part, np.uint8).astype(np.int64) + 2
    symbols[-1] = 0
    order = suffix_array(symbols, 258)
    shared = common_prefixes(symbols, order, length)
    twice = shared >= length
    places = np.flatnonzero(twice[order])
    twice[order[places - 1]] = True
    runs = []
    for begin, part in zip(begins, parts):
        at = np.flatnonzero(twice[begin : begin + len(part) - length + 1])
        runs.append([{"a": int(a), "b": int(b)} for a, b in zip(*joined(at, at + length))])
    return runs


def joined(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of what the ranges (begins ascending) cover."""
    if not len(begins):
        return begins, ends
    furthest = np.maximum.accumulate(ends)
    new = np.concatenate([[True], begins[1:] > furthest[:-1]])
    return begins[new], furthest[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _shards(length: int):
    """Whole groups (the rows are sorted by their hash) are put together into shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int, bool]] = []
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(name) for name in ("mh", "sh", "whole", "octets"))):
                mh, sh, whole, octets = (value.as_py() for value in row)
                if size >= SHARD and mh != keys[-1][0]:
                    yield found(keys, parts)
                    keys, parts, size = [], [], 0
                keys.append((mh, sh, whole))
                parts.append(octets)
                size += len(octets)
        if keys:
            yield found(keys, parts)

    def found(keys, parts) -> pa.RecordBatch:
        rows = [(mh, sh, runs) for (mh, sh, whole), runs in zip(keys, repeated(parts, length)) if runs and not whole]
        columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), _RUNS_ARROW))]
        return pa.RecordBatch.from_arrays(columns, ["mh", "sh", "runs"])

    return run


def _strings(length: int):
    """Every string of the crowded groups by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mh, sh, whole, octets in zip(*(batch.column(name) for name in ("mh", "sh", "whole", "octets"))):
                view = memoryview(octets.as_py())
                many = len(view) - length + 1
                digests = b"".join(xxhash.xxh3_128_digest(view[k : k + length]) for k in range(many))
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = [
                    np.full(many, mh.as_py()), np.full(many, sh.as_py()), np.full(many, whole.as_py()),
                    np.arange(many, dtype=np.int32), halves[:, 0].copy(), halves[:, 1].copy(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["mh", "sh", "whole", "at", "high", "low"])

    return run


def _runs_of(at: Column, length: int) -> Column:
    """The runs that strings of ``length`` at these (ascending) places cover."""
    begins = F.filter(at, lambda x, i: (i == 0) | (x - F.get(at, i - 1) > length))
    ends = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) - x > length))
    return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("a"), (b + length).alias("b")))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        rows = []
        for packed, wanted in zip(batch.column("packed"), batch.column("runs")):
            data = _unpacked(packed)
            pairs = sorted((run["a"], run["b"]) for run in wanted.as_py() or ())
            begins, ends = joined(np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64))
            edges = [0, *(edge for pair in zip(begins.tolist(), ends.tolist()) for edge in pair), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((len(data), len(data) - len(kept), len(begins), kept))
        columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def without_substrings(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes
    that stay)."""
    doc_id, text_key = F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("text_key")
    texts = docs.select(doc_id, text_key, "text")
    # Written, as cutting costs more than reading it twice; so are the small tables by hash,
    # so that a join's other side, which has the hot hashes, can be split.
    cut = stage(texts.mapInArrow(_cut(length), _SEGMENTS), "cut")
    stats = cut.groupBy("mh").agg(F.count("*").alias("n"), F.min("sh").alias("least"), F.max("sh").alias("most"), F.max("inner").alias("inner"))
    shared = stats.filter("n > 1 or inner").select("mh", (F.col("inner") | (F.col("least") != F.col("most"))).alias("mixed"))
    known = stage(cut.drop("inner").join(stage(shared, "shared"), "mh"), "segments")

    place = F.min(F.struct("doc_id", "text_key", "start")).alias("place")
    distinct = known.groupBy("mh", "sh", "size").agg(F.count("*").alias("n"), F.max("mixed").alias("mixed"), place)
    distinct = stage(distinct, "distinct")
    mixed = distinct.filter("mixed")
    crowded = mixed.groupBy("mh").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > GROUP).select("mh", F.lit(True).alias("crowded"))
    wanted = mixed.join(stage(crowded, "crowded"), "mh", "left").select(
        F.col("place.doc_id").alias("at_doc"), F.col("place.text_key").alias("at_key"),
        F.struct("mh", "sh", F.col("place.start").alias("start"), "size", F.coalesce("crowded", F.lit(False)).alias("crowded"), (F.col("n") > 1).alias("whole")).alias("one"),
    )
    wanted = wanted.groupBy("at_doc", "at_key").agg(F.collect_list("one").alias("wanted"))
    packed = texts.mapInArrow(_packed, "doc_id long, text_key long, packed binary")
    asked = packed.join(wanted, packed["doc_id"].eqNullSafe(wanted["at_doc"]) & (packed["text_key"] == wanted["at_key"]))
    # Rows that repeat give the same bytes twice; one is enough.
    octets = asked.select("packed", "wanted").mapInArrow(_sliced, "mh long, sh long, crowded boolean, whole boolean, octets binary")
    octets = stage(octets, "octets")

    few = octets.filter("not crowded").dropDuplicates(["mh", "sh"]).repartition("mh").sortWithinPartitions("mh")
    found = few.mapInArrow(_shards(length), f"mh long, sh long, runs {_RUNS}")
    strings = octets.filter("crowded").dropDuplicates(["mh", "sh"]).mapInArrow(_strings(length), "mh long, sh long, whole boolean, at int, high long, low long")
    twice = strings.groupBy("high", "low").count().filter("count > 1").drop("count")
    counted = strings.join(twice, ["high", "low"]).filter("not whole").groupBy("mh", "sh")
    counted = counted.agg(F.sort_array(F.collect_list("at")).alias("at")).select("mh", "sh", _runs_of(F.col("at"), length).alias("runs"))
    whole = distinct.filter("n > 1").select("mh", "sh", F.array(F.struct(F.lit(0).alias("a"), F.col("size").alias("b"))).alias("runs"))
    covered = stage(found.unionByName(counted).unionByName(whole), "covered")

    moved = F.transform("runs", lambda run: F.struct((run["a"] + F.col("start")).alias("a"), (run["b"] + F.col("start")).alias("b")))
    places = known.join(covered, ["mh", "sh"]).select("doc_id", "text_key", F.explode(moved).alias("run"))
    runs = places.groupBy(F.col("doc_id").alias("at_doc"), F.col("text_key").alias("at_key")).agg(F.collect_set("run").alias("runs"))
    joined_docs = packed.join(runs, packed["doc_id"].eqNullSafe(runs["at_doc"]) & (packed["text_key"] == runs["at_key"]), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined_docs.select("doc_id", "packed", "runs").mapInArrow(_kept, schema)
