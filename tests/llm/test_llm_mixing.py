import re
import zlib

import numpy as np
import pytest
from cases import TEXTS, docs, result
from pyspark.sql import functions as F

from starlift.llm import mixing, queries


def raked(tokens, targets, rounds=500):
    """Plain fitting of a dense table."""
    weight = tokens / tokens.sum()
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            margin = weight.sum(axis=tuple(k for k in range(weight.ndim) if k != axis))
            factor = np.divide(target, margin, out=np.zeros_like(margin), where=margin > 0)
            weight = weight * factor.reshape([-1 if k == axis else 1 for k in range(weight.ndim)])
    return weight


def cells(spark, tokens):
    rows = [(f"={i}", f"={j}", f"={k}", int(n)) for (i, j, k), n in np.ndenumerate(tokens)]
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_raking_meets_the_targets(spark):
    tokens = np.random.default_rng(1).integers(1, 1000, (4, 3, 2)).astype(float)
    tokens[0, 1, 0] = 0
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.7, 0.3])]
    names = dict(zip(mixing.DIMENSIONS, targets))
    tables = {d: spark.createDataFrame([(f"={k}", float(x)) for k, x in enumerate(t)], f"{d} string, target double") for d, t in names.items()}
    found = mixing.rake(cells(spark, tokens), tables, mixing.Mix(closeness=1e-9)).collect()
    want = raked(tokens, targets)
    for row in found:
        assert row["weight"] == pytest.approx(want[tuple(int(row[d][1:]) for d in mixing.DIMENSIONS)], abs=1e-7)


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9, 1.0])
def test_probabilities_expect_the_share(spark, share):
    draw = np.random.default_rng(2)
    rows = [(k, int(n), float(w)) for k, (n, w) in enumerate(zip(draw.integers(1, 1000, 50), draw.random(50)))] + [(50, 0, 0.0)]
    total = sum(n for _, n, _ in rows)
    frame = spark.createDataFrame(rows, "cell long, tokens long, weight double")
    found = mixing.calibrate(frame, mixing.Mix(share=share)).collect()
    assert sum(r["tokens"] * r["probability"] for r in found) == pytest.approx(share * total)
    assert all(0 <= r["probability"] <= 1 for r in found)
    ratios = {round(r["probability"] * r["tokens"] / r["weight"], 9) for r in found if r["tokens"] and r["probability"] < 1}
    assert len(ratios) <= 1


def topic(text):
    words = {w for w in re.split(rb"[ \t\n\x0b\f\r]+", (text or "").encode()) if len(w) >= 6}
    return sum((sum(1 if zlib.crc32(w) >> 8 + b & 1 else -1 for w in words) > 0) << b for b in range(3))


def test_awkward_rows(spark):
    table = docs(spark)
    frame, cell = mixing.mixed(table)
    assert set(table.columns) < set(frame.columns) and frame.count() == len(TEXTS)
    for row in frame.collect():
        measured = row[cell]
        assert measured["n_tokens"] == len((row["text"] or "").encode().split())
        assert mixing_value(measured["topic"]) == str(topic(row["text"]))
        assert mixing_value(measured["source"]) == row["source"] and mixing_value(measured["lang"]) == row["lang"]
        assert 0 <= measured["probability"] <= 1
    again = mixing.mixed(docs(spark).repartition(3))[0]
    assert result(frame.select("doc_id", F.col(cell)["sampled"])) == result(again.select("doc_id", F.col(cell)["sampled"]))


def mixing_value(key):
    return key[1:] if key else None


def test_empty_tables_and_texts(spark):
    frame, _ = mixing.mixed(docs(spark, []))
    assert frame.count() == 0
    frame, cell = mixing.mixed(docs(spark, [(1, None), (2, "")]))
    assert {row[cell]["probability"] for row in frame.collect()} == {0.5}


def test_given_targets_and_topics(spark):
    rows = [(k, "some words of this document " * (1 + k % 7)) for k in range(300)]
    table = docs(spark, rows).withColumn("theme", F.col("doc_id") % 2)
    goal = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), ("absent", 9.0), (None, 0.0)], "value string, target double")
    frame, cell = mixing.mixed(table, {"source": goal}, topic="theme", mix=mixing.Mix(share=0.1))
    shares = {}
    for row in frame.collect():
        measured = row[cell]
        shares[row["source"]] = shares.get(row["source"], 0) + measured["n_tokens"] * measured["probability"]
        assert mixing_value(measured["topic"]) == str(row["theme"])
    total = sum(shares.values())
    assert shares["src0"] / total == pytest.approx(0.75, abs=1e-3) and shares["src1"] / total == pytest.approx(0.25, abs=1e-3)
    assert shares["src2"] == 0 and shares[None] == 0


def test_query_meets_smoothed_shares(spark, sf_dir):
    found = queries.op7_mixing(spark, sf_dir).toPandas()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    found["drawn"] = found["n_tokens"] * found["weight"] / found.groupby(["source", "lang", "topic"])["n_tokens"].transform("sum")
    for name in mixing.DIMENSIONS:
        by = found.groupby(name)
        target = by["n_tokens"].sum() ** 0.5
        assert np.allclose(by["drawn"].sum(), target / target.sum(), rtol=2e-3)
    assert (found["n_tokens"] * found["probability"]).sum() == pytest.approx(0.5 * found["n_tokens"].sum(), rel=1e-3)
    assert abs(found["n_tokens"][found["sampled"]].sum() / found["n_tokens"].sum() - 0.5) < 0.2


def test_contradicting_targets_are_reported(spark):
    frame = spark.createDataFrame([("=a", "=x", "=0", 60), ("=b", "=y", "=0", 40)], "source string, lang string, topic string, tokens long")
    tables = {"source": [("=a", 0.5), ("=b", 0.5)], "lang": [("=x", 0.9), ("=y", 0.1)]}
    tables = {name: spark.createDataFrame(rows, f"{name} string, target double") for name, rows in tables.items()}
    with pytest.warns(UserWarning, match="off its target"):
        found = mixing.rake(frame, tables, mixing.Mix(rounds=3)).collect()
    assert all(row["deviation"] > 0.5 for row in found)
    assert mixing.rake(frame, {"source": tables["source"]}).first()["deviation"] <= 1e-4


def test_the_whole_result_equals_brute_force(spark, sf_dir):
    """Cells, weights and probabilities of every document, from the texts up."""
    found = queries.op7_mixing(spark, sf_dir).toPandas()
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    table["topic"] = [str(topic(text)) for text in table["text"]]
    table["n"] = [len((text or "").encode().split()) for text in table["text"]]
    names = [sorted(table[d].unique()) for d in mixing.DIMENSIONS]
    tokens = np.zeros([len(n) for n in names])
    at = [tuple(n.index(row[d]) for n, d in zip(names, mixing.DIMENSIONS)) for _, row in table.iterrows()]
    for place, n in zip(at, table["n"]):
        tokens[place] += n
    margins = [tokens.sum(axis=tuple(k for k in range(3) if k != axis)) ** 0.5 for axis in range(3)]
    weight = raked(tokens, [m / m.sum() for m in margins])
    wanted, full, factor = 0.5 * tokens.sum(), np.zeros(tokens.shape, bool), 1.0
    ratio = np.divide(weight, tokens, out=np.zeros_like(weight), where=tokens > 0)
    for _ in range(100):
        factor = (wanted - tokens[full].sum()) / weight[~full].sum()
        full = ratio * factor >= 1
    chance = np.minimum(1, ratio * factor)
    by_id = found.set_index("doc_id")
    for doc_id, place, n, *keys in zip(table["doc_id"], at, table["n"], *(table[d] for d in mixing.DIMENSIONS)):
        row = by_id.loc[doc_id]
        assert [row[d] for d in mixing.DIMENSIONS] == keys and row["n_tokens"] == n
        assert row["weight"] == pytest.approx(weight[place], rel=2e-3) and row["probability"] == pytest.approx(chance[place], rel=5e-3)
    assert (found["deviation"] <= 1e-4).all()
