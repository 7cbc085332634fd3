"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.operators.staging import stage

__all__ = ["ascii_lower", "fresh", "keep_keys", "row_key", "stage", "table", "word_chunks"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The bytes that end a word, and how much text is split at a time.
SPACES = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other letter left as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` is called so."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(text: str | Column = "text") -> Column:
    """A digest that tells apart rows that share a doc_id."""
    return F.xxhash64(text)


def keep_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, digest of text) is (left_semi) or isn't (left_anti)
    among ``keys`` (columns doc_id and text_key). Null ids match null ids."""
    keys = keys.select(F.col("doc_id").alias("_keep_id"), F.col("text_key").alias("_keep_text"))
    same = docs["doc_id"].eqNullSafe(keys["_keep_id"]) & (row_key(docs["text"]) == keys["_keep_text"])
    return docs.join(keys, same, how)


def word_chunks(data: bytes) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in lists of about a megabyte of text."""
    start = 0
    while len(data) - start > CHUNK:
        end = start + CHUNK
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[start:end].split()
        start = end
    yield data[start:].split()
