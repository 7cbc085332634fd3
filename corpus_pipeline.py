"""The training-data pipeline over ``documents``: each stage applies one operator of
starlift.llm to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.llm import decontaminate, mixing, pii, quality, simhash
from starlift.llm.common import fresh, keep_keys, stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 1/2 go."""
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(quality.remainder() != 1))
    return docs.filter(quality.score(docs, model) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: the one with the smallest doc_id, then the
    smallest digest of its text, then the first of the rows that repeat both."""
    row = fresh(docs, "_row")
    # Written, so that a row has the same number wherever it is read.
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = simhash.near_duplicates(numbered, words=3, distance=3, row=row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "row_id")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.row_id").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go, also with a word put in, left
    out or moved by one place (proximity with slop 1)."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), decontaminate.Search(slop=1))
    return keep_keys(docs, found.filter("n_hit > 0 or n_near > 0"), "left_anti")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes a mark such as [EMAIL]; n_chars follows."""
    found, columns = fresh(docs, "_spans"), docs.columns
    marked = docs.withColumn(found, pii.spans(F.col("text"), through=True))
    changed = F.size(found) > 0
    marked = marked.withColumn("text", pii.redacted(F.col("text"), F.col(found)))
    if "n_chars" in columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        marked = marked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return marked.select(*columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target mix, with the number to count each one by."""
    drawn, cell = mixing.mixed(docs)
    weight = fresh(docs, "mix_weight")
    drawn = drawn.filter(F.col(cell)["sampled"])
    return drawn.select(*docs.columns, (1 / F.col(cell)["probability"]).alias(weight))


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("mixing to target weights", mixed),
]

#: The classifier, the fingerprints and the raking can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
