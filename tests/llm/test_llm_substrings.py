import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import TEXTS, changed, docs, result, sample

from starlift.llm import queries, substrings
from starlift.llm.suffixes import common_prefixes, suffix_array


def brute(rows, length=200):
    data = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    counts = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for doc_id, d in data:
        gone = bytearray(len(d))
        end = 0
        for k in range(len(d) - length + 1):
            if counts[d[k : k + length]] > 1:
                gone[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((doc_id, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted(((i, n, r, s, hashlib.sha256(kept).hexdigest()) for i, n, r, s, kept in (tuple(row) for row in frame.collect())), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"GROUP": 300}, {"CHUNK": 97, "SHARD": 500}])
def test_awkward_rows(spark, sizes):
    with changed(substrings, **sizes):
        assert as_rows(substrings.without_substrings(docs(spark), 200)) == brute(TEXTS, 200)


def test_partial_overlaps(spark):
    draw = np.random.default_rng(3)
    base = "".join(draw.choice(list("abcdé "), 3000))
    rows = [(k, base[a : a + n] + base[b : b + m]) for k, (a, n, b, m) in enumerate(draw.integers(0, 1500, (30, 4)).tolist())]
    with changed(substrings, GROUP=5000):
        assert as_rows(substrings.without_substrings(docs(spark, rows), 100)) == brute(rows, 100)


def test_empty_table(spark):
    assert as_rows(substrings.without_substrings(docs(spark, []))) == []


def test_query_equals_brute_force(spark, sf_dir):
    assert result(queries.op6_substrings(spark, sf_dir)) == brute(sample(spark, sf_dir))


def test_suffix_arrays_and_common_prefixes():
    draw = np.random.default_rng(1)
    for few in (0, 16):
        from starlift.llm import suffixes

        with changed(suffixes, FEW=few):
            for _ in range(150):
                symbols = np.append(draw.integers(1, 1 + int(draw.integers(1, 4)), int(draw.integers(0, 80))), 0)
                text = symbols.tolist()
                want = sorted(range(len(text)), key=lambda k: text[k:])
                assert suffix_array(symbols, 5).tolist() == want
                shared = common_prefixes(symbols, np.array(want), 10)
                for a, b in zip(want, want[1:]):
                    same = next(k for k in range(len(text)) if text[a + k : a + k + 1] != text[b + k : b + k + 1])
                    assert shared[b] == min(10, same)


def test_texts_whose_digests_share_a_half_stay_apart(spark):
    shared, tail = "one passage " * 25, "z" * 150
    halves = {xxhash.xxh64_intdigest(f"{k} {shared}", 42) >> 32: k for k in range(150_000)}
    plain = next(k for k in range(150_000) if xxhash.xxh64_intdigest(f"{k} {tail}", 42) >> 32 in halves)
    copy = halves[xxhash.xxh64_intdigest(f"{plain} {tail}", 42) >> 32]
    rows = [(None, f"{copy} {shared}"), (None, f"{plain} {tail}"), (1, f"Other {shared}")]
    assert as_rows(substrings.without_substrings(docs(spark, rows), 200)) == brute(rows, 200)
