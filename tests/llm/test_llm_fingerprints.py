import hashlib
import random
import re

import pytest
from cases import TEXTS, changed, docs, result, sample
from pyspark.sql import functions as F

from starlift.llm import fingerprints, queries


def paragraphs(text):
    """Word by word: lines, cut after words of some endings."""
    found = set()
    for line in text.split("\n"):
        words = re.findall(r"\S{1,64}\s*", line, re.ASCII)
        while words:
            size = next((n for n in range(32, 97) if n <= len(words) and re.search(r"[aeo]\s+$", words[n - 1], re.ASCII)), 96)
            found.add(re.sub(r"\s+$", "", "".join(words[:size]), flags=re.ASCII))
            words = words[size:]
    return found


def brute(rows, hashes):
    """n_chars, edited text's digest and likenesses; ``hashes`` orders rows of one id."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        sets = [paragraphs(t) for t in (text, edited, following)]
        near = [1 - len(sets[0] ^ other) / (len(sets[0]) + len(other)) if sets[0] or other else 1.0 for other in sets[1:]]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *(round(x, 9) for x in near)))
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted(((i, n, e, round(a, 9), round(b, 9)) for i, n, e, _, _, a, b in (tuple(r) for r in frame.collect())), key=repr)


def hashes(spark, rows):
    texts = [((t or ""),) for _, t in rows] or [("",)]
    return {t: h for t, h in spark.createDataFrame(texts, "text string").select("text", F.xxhash64("text")).collect()}


LINES = [(k, "\n".join(f"line {k * j % 53} {j % 17}" for j in range(k * 13 % 200))) for k in range(40)]


@pytest.mark.parametrize("rows", [TEXTS, TEXTS[:1], [(5, "a\nb"), (5, "a\nb")], LINES, [(10**12 * k, f"t{k}\nx") for k in range(20)]])
@pytest.mark.parametrize("wide", [2048, 2])
def test_awkward_rows(spark, rows, wide):
    with changed(fingerprints, RANGE=wide):
        assert as_rows(fingerprints.fingerprints(docs(spark, rows))) == brute(rows, hashes(spark, rows))


def one_line(words, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgilmnorstu", k=draw.randint(2, 9))) for _ in range(words))


def test_texts_of_one_line_are_alike_as_far_as_they_are_equal(spark):
    text = one_line(1200, 1)
    rows = [(1, text), (2, text + "x"), (3, "Another beginning of the text, " + text), (4, one_line(1200, 2))]
    near = {row["doc_id"]: row for row in fingerprints.fingerprints(docs(spark, rows)).collect()}
    assert near[1]["near_next"] > 0.9 and near[2]["near_next"] > 0.8 and near[3]["near_next"] < 0.1
    assert all(0.35 < near[k]["near_edited"] < 0.65 for k in (3, 4)) and near[1]["near_edited"] > 0.35


def test_a_text_without_white_space(spark):
    rows = [(1, "x" * 300_000), (2, "語" * 5000), (3, "".join(random.Random(1).choices("語文字日本。", k=5000)))]
    assert as_rows(fingerprints.fingerprints(docs(spark, rows))) == brute(rows, hashes(spark, rows))


def test_empty_table(spark):
    assert as_rows(fingerprints.fingerprints(docs(spark, []))) == []


def test_query_equals_brute_force(spark, sf_dir):
    rows = sample(spark, sf_dir)
    found = queries.op4_fingerprints(spark, sf_dir)
    assert as_rows(found) == brute(rows, hashes(spark, rows))
    texts = dict(rows)
    marks = {}
    for row in found.collect():
        assert marks.setdefault(texts[row["doc_id"]], row["fingerprint"]) == row["fingerprint"]


def test_peeling_recovers_the_differing_digests(spark):
    left, right = [11, 12, 13, 1 << 60, -5], [13, 14, -5, -(1 << 62)]
    frame = spark.createDataFrame([(left, right, list(range(1000)))], "a array<long>, b array<long>, c array<long>")
    for seed in (0, 3):
        sketches = [fingerprints.sketch(F.transform(F.col(n), lambda k: F.xxhash64(k)), seed) for n in "abc"]
        less = fingerprints.less(sketches[0], sketches[1])
        few, many, none = frame.select(
            fingerprints.peeled(less, seed), fingerprints.peeled(fingerprints.less(sketches[0], sketches[2]), seed),
            fingerprints.peeled(fingerprints.less(sketches[0], sketches[0]), seed),
        ).first()
        wanted = spark.createDataFrame([(k, 1) for k in {*left} - {*right}] + [(k, -1) for k in {*right} - {*left}], "k long, n int")
        assert sorted((p["key"], p["n"]) for p in few) == result(wanted.select(F.xxhash64("k"), "n"))
        assert many is None and none == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op4_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
