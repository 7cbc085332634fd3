"""The registered queries of this folder's operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.llm import decontaminate, fingerprints, manifest, mixing, neighbours, pii, quality, sentences, simhash, substrings, url_filter, vector_codes, warc
from starlift.llm.common import stage, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; labels of the held-out third are not learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.filter(quality.remainder() != 1))
    scored = docs.select("doc_id", (quality.remainder() == 1).alias("held_out"), quality.score(docs, model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, and read back from the archives."""
    archives = stage(warc.write_archives(table(spark, sf_dir, "pages")), "archives")
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, else by its host's reputation."""
    parts = url_filter.taken_apart(table(spark, sf_dir, "pages"))
    outcomes = url_filter.labelled_pages(parts, table(spark, sf_dir, "labels"))
    return url_filter.judge(parts, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sketch, and its likeness to the edited and the next document."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and places of the base kinds, and all spans."""
    found = table(spark, sf_dir, "documents").select("doc_id", pii.spans(F.col("text"), through=True).alias("found"))
    kinds = [kind.name for kind in pii.KINDS if kind.base]
    counts = [pii.count_of(F.col("found"), kind).alias(f"n_{kind}") for kind in kinds]
    base = F.sha2(pii.listed(pii.base_only(F.col("found"))), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.listed(F.col("found")).alias("spans"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    found = substrings.without_substrings(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, its weight for each token and whether it is drawn; and how
    far raking came."""
    docs, cell = mixing.mixed(table(spark, sf_dir, "documents"))
    names = ("n_tokens", "weight", "probability", "deviation", "sampled")
    keys = [mixing.shown(F.col(cell)[name]).alias(name) for name in mixing.DIMENSIONS]
    return docs.select("doc_id", *keys, *(F.col(cell)[name].alias(name) for name in names))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component of near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3)
    return found.select("doc_id", simhash.as_hex("bits").alias("fingerprint"), "component_id")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words and items of the benchmark found in it, and the items found
    only with words one place off."""
    search = decontaminate.Search(slop=1)
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), search)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        "n_near", decontaminate.items_digest("near_items").alias("near_sha256"),
    )


def op10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of spans that stand earlier in the corpus."""
    found = sentences.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", "n_removed", F.col("kept").alias("text"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's code and error, the error of its label, and the codebooks' digest."""
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    found = vector_codes.with_total(stage(found, "codes"), "label", "label_error")
    return found.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id 20 divides, found exactly (factor one)."""
    index = neighbours.build(table(spark, sf_dir, "embeddings"))
    return neighbours.search(index, F.col("id") % 20 == 0, k=20, factor=1.0)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the Merkle tree, and whether it still leads to the root."""
    found = manifest.verified(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def catalogue() -> dict:
    found = (
        op1_quality, op2_warc, op3_url_filter, op4_fingerprints, op5_pii, op6_substrings, op7_mixing, op8_simhash,
        op9_decontaminate, op10_sentences, op11_vector_codes, op12_neighbours, op13_manifest,
    )
    return {query.__name__: query for query in found}
