import pytest
from cases import CLASHING, PROSE, TEXTS, docs, result
from pyspark.sql import functions as F
from test_llm_decontaminate import brute as hits
from test_llm_pii import AWKWARD
from test_llm_simhash import brute as groups

import corpus_pipeline
from starlift.llm.common import stage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 0), (11, 0, 0), (10, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(1, "children had gone after school was it the garden again")], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    docs(spark).write.parquet(f"{place}/documents.parquet")
    return place


def test_stages_are_those_asked_for():
    assert [step.__name__ for _, step in corpus_pipeline.STAGES] == ["good_quality", "near_duplicates", "decontaminated", "without_personal_data", "mixed"]


@pytest.mark.parametrize("rows", [TEXTS, []])
def test_every_stage_takes_awkward_rows(spark, folder, rows):
    table = docs(spark, rows)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, table, folder).columns == table.columns
    last = corpus_pipeline.STAGES[-1][1](spark, table, folder)
    assert last.columns[: len(table.columns)] == table.columns and len(last.columns) == len(table.columns) + 1
    assert last.count() <= len(rows)


def test_near_duplicates_keep_one_of_each_group(spark, folder):
    kept = corpus_pipeline.near_duplicates(spark, docs(spark), folder)
    ids = sorted(i for (i,) in result(kept.select("doc_id").distinct()) if i is not None)
    assert ids == sorted({smallest for _, _, smallest in groups(TEXTS) if smallest is not None})


def test_decontamination_drops_what_brute_force_finds(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [row[0] for row in hits(TEXTS, items) if not row[2]]
    kept = corpus_pipeline.decontaminated(spark, docs(spark), folder)
    assert sorted((i for (i,) in result(kept.select("doc_id"))), key=repr) == sorted(clean, key=repr)


def test_personal_data_is_marked_and_the_rest_stays(spark, folder):
    rows = TEXTS + list(enumerate(AWKWARD, 100))
    before = docs(spark, rows)
    after = corpus_pipeline.without_personal_data(spark, before, folder)
    assert after.schema["n_chars"].dataType == before.schema["n_chars"].dataType
    assert after.filter("n_chars <> char_length(text)").count() == 0
    clean = [row for row in result(after.select("doc_id", "text")) if row in TEXTS]
    assert len(clean) == len(TEXTS) and after.count() == len(rows)
    assert "[EMAIL]" in after.filter("doc_id = 100").first()["text"]


def test_run_is_the_stages_one_after_the_other(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        table = stage(step(spark, table, sf_dir), "test")
    found = corpus_pipeline.run(spark, sf_dir)
    assert result(found) == result(table)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_weight"]


def test_quality_keeps_prose_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.good_quality(spark, table, folder).select("doc_id")
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    wrong = truth.join(kept, "doc_id", "left_semi").filter("quality = 0").count() + truth.join(kept, "doc_id", "left_anti").filter("quality = 1").count()
    assert wrong <= 0.02 * truth.count()


def test_clashing_names_are_those_of_the_cases(spark):
    assert set(CLASHING) < set(docs(spark).columns) and PROSE in docs(spark).filter(F.col("doc_id") == 9).first()["text"]


def test_near_duplicates_keep_one_row_of_repeated_ones(spark, folder):
    rows = [(None, PROSE * 3)] * 3 + [(7, "two words")] * 2 + [(7, "quite another text")]
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, rows), folder)
    assert result(kept.select("doc_id", "text")) == sorted(set(rows), key=repr)


def test_decontamination_drops_items_with_a_word_put_in(spark, folder):
    rows = [(1, PROSE.replace("it the garden", "it really the garden")), (2, "Nothing of the kind.")]
    assert result(corpus_pipeline.decontaminated(spark, docs(spark, rows), folder).select("doc_id")) == [(2,)]


def test_every_secret_after_a_context_word_is_marked(spark, folder):
    rows = [(1, "tokens: 24be64439e3e49cf, b7db7aa4a5fcc783")]
    assert result(corpus_pipeline.without_personal_data(spark, docs(spark, rows), folder).select("text")) == [("tokens: [SECRET], [SECRET]",)]
