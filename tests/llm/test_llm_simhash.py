import re

import numpy as np
import pytest
import xxhash
from cases import TEXTS, changed, docs, result, sample

from starlift.llm import graph, queries, simhash


def brute_bits(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, smallest doc_id reachable) by comparing all pairs."""
    bits = [brute_bits(text) for _, text in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 3:
                a, b = groups[i], groups[j]
                groups = [a if g == b else g for g in groups]
    smallest = {}
    for g, (doc_id, _) in zip(groups, rows):
        smallest[g] = min((x for x in (smallest.get(g), doc_id) if x is not None), default=None)
    return sorted(((i, f"{b:016x}", smallest[g]) for (i, _), b, g in zip(rows, bits, groups)), key=repr)


def as_rows(frame):
    return result(frame.select("doc_id", simhash.as_hex("bits"), "component_id"))


def test_awkward_rows(spark):
    assert as_rows(simhash.near_duplicates(docs(spark))) == brute(TEXTS)


def test_empty_table(spark):
    assert as_rows(simhash.near_duplicates(docs(spark, []))) == []


def test_query_equals_brute_force(spark, sf_dir):
    assert result(queries.op8_simhash(spark, sf_dir)) == brute(sample(spark, sf_dir))


@pytest.mark.parametrize("chunk", [16, 100])
def test_long_texts_are_read_in_pieces(chunk):
    from starlift.llm import common

    text = " ".join(f"w{k * k % 97}" for k in range(300))
    with changed(common, CHUNK=chunk):
        assert simhash.fingerprint(text) == brute_bits(text)


def test_every_near_pair_meets_at_a_home_anchor():
    draw = np.random.default_rng(5)
    for _ in range(200):
        half = draw.integers(0, 1 << 32, 1)
        other = half ^ (1 << int(draw.integers(0, 32)))
        assert simhash.home(half)[0] in simhash.anchors(other, 1)[0]


def test_golay_and_hamming_homes_are_the_nearest_code_words():
    words = np.random.default_rng(6).integers(0, 1 << 30, 2000)
    homes = simhash.home(words)
    golay, hamming = homes >> 7, homes & 0x7F
    assert np.bitwise_count(golay ^ words & 0x7FFFFF).max() <= 3
    assert np.bitwise_count(hamming ^ words >> 23).max() <= 1
    assert np.array_equal(simhash.home(golay | hamming << 23), homes)


def clusters(spark, many):
    """Fingerprints of which many lie close to one of few centres."""
    draw = np.random.default_rng(7)
    centres = draw.integers(-(1 << 62), 1 << 62, 3)
    bits = set()
    while len(bits) < many:
        flips = sum(1 << int(b) for b in set(draw.integers(0, 63, int(draw.integers(0, 5)))))
        bits.add(int(centres[draw.integers(0, 3)]) ^ flips)
    bits |= {int(b) for b in draw.integers(-(1 << 62), 1 << 62, many)}
    return sorted(bits)


@pytest.mark.parametrize("cell", [8192, 10])
def test_crowded_anchors_lose_no_link(spark, cell):
    bits = clusters(spark, 150)
    values = np.array(bits, np.int64).view(np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    left, right = np.nonzero(near)
    want = graph.forest(np.arange(len(bits)), left, right)
    with changed(simhash, CELL=cell):
        links = simhash.links(spark.createDataFrame([(b,) for b in bits], "bits long")).collect()
    at = {b: k for k, b in enumerate(bits)}
    pairs = np.array([(at[src], at[dst]) for src, dst in links])
    got = graph.forest(np.arange(len(bits)), pairs[:, 0], pairs[:, 1])
    assert np.array_equal(want, got)


def test_components_of_chains_stars_and_rings(spark):
    draw = np.random.default_rng(8)
    names = [int(x) for x in draw.integers(-(1 << 62), 1 << 62, 300)]
    links = [(names[k], names[k + 1]) for k in range(99)]  # a chain
    links += [(names[100], names[k]) for k in range(101, 200)]  # a hub
    links += [(names[200 + k], names[200 + (k + 1) % 50]) for k in range(50)]  # a ring
    links += [(names[260], names[260]), (names[270], names[271]), (names[271], names[270])]
    found = dict(result(graph.components(spark.createDataFrame(links, "src long, dst long"))))
    for group in (names[:100], names[100:200], names[200:250], names[270:272]):
        assert len({found[name] for name in group}) == 1 and found[group[0]] in group
    assert len(set(found.values())) == 4 and names[260] not in found
    assert result(graph.components(spark.createDataFrame([], "src long, dst long"))) == []
