import zlib

import numpy as np
import pytest
from cases import TEXTS, changed, docs, result
from pyspark.sql import functions as F

from starlift.llm import quality, queries


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "1 as text", "2 as label")


def test_scores_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op1_quality(spark, folder).toPandas()
    truth = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert len(found) == 1000 and found["score"].between(0, 1).all()
    assert found["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]
    assert found["predicted"].tolist() == (found["score"] >= 0.5).astype(int).tolist()
    aside = found[found["held_out"]].merge(truth, on="doc_id")
    assert len(aside) > 80 and (aside["predicted"] == aside["quality"]).mean() >= 0.95


def test_labels_of_held_out_rows_dont_matter(spark, sf_dir):
    docs_, known = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    turned = known.withColumn("quality", F.when(quality.remainder() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [quality.train(docs_, rows.filter(quality.remainder() != 1)) for rows in (known, turned)]
    assert all(np.array_equal(a, b) for a, b in zip(*models))


def test_awkward_rows(spark):
    table = docs(spark)
    known = labels(spark, [(1, 1, 0), (2, 1, 0), (2, 0, 1), (6, 0, 0), (7, 0, None), (11, 0, 0), (None, 1, 0), (4, None, 0), (99, 1, 0)])
    model = quality.train(table, known)
    found = result(table.select("doc_id", quality.score(table, model)))
    assert len(found) == len(TEXTS) and all(0 <= score <= 1 for _, score in found)
    by_text = {}
    for (_, text), (_, score) in zip(TEXTS, [tuple(r) for r in table.select("doc_id", quality.score(table, model)).collect()]):
        assert by_text.setdefault(text or "", score) == score  # equal texts, equal scores


@pytest.mark.parametrize("rows, share", [([], 0.5), ([(1, 1, 0), (6, 1, 0)], 0.75), ([(1, 0, 0)], 1 / 3)])
def test_without_two_labels_the_share_is_the_score(spark, rows, share):
    table = docs(spark)
    model = quality.train(table, labels(spark, rows))
    assert {round(score, 9) for (score,) in result(table.select(quality.score(table, model)))} == {round(share, 9)}


def test_empty_table(spark):
    table = docs(spark, [])
    model = quality.train(table, labels(spark, [(1, 1, 0)]))
    assert result(table.select(quality.score(table, model))) == []


@pytest.mark.parametrize("chunk", [1 << 20, 16, 7])
def test_word_vectors_are_sums_of_neighbours_index_vectors(spark, chunk):
    rows = [(1, "a b c b a ! b"), (2, None), (3, "c AB ab 12 12 x"), (4, " ".join("pqrst"[k % 5] for k in range(60)))]
    with changed(quality, CHUNK=chunk):
        found = quality.word_vectors(docs(spark, rows))
    places, signs = quality._index_vectors()
    want = np.zeros((quality.IDS, quality.WIDTH))
    for _, text in rows:
        ids = quality.ids_of(text, quality._Ids())
        for i in range(len(ids)):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if i != j:
                    np.add.at(want[ids[i]], places[ids[j]], signs[ids[j]])
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(found, want, atol=1e-6)


def test_temperature_calibrates_noisy_labels():
    draw = np.random.default_rng(2)
    features = draw.normal(size=(4000, 8))
    chance = 1 / (1 + np.exp(-2 * features[:, 0]))
    model = quality.fit(features, (draw.random(4000) < chance).astype(int), np.zeros((1, 8)), quality.Training(rounds=20))
    fresh_ = draw.normal(size=(4000, 8))
    scores = quality._probability(model, fresh_)
    assert np.abs(scores - 1 / (1 + np.exp(-2 * fresh_[:, 0]))).mean() < 0.08
