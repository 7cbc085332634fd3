"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

# Names that operators use for columns of their own.
CLASHING = (
    "score", "bits", "root", "component_id", "fingerprint", "text_key", "kept", "packed", "runs", "found", "at", "n",
    "cell", "_cell", "_measured", "_spans", "_keep_id", "_keep_text", "mix_weight", "weight", "own", "row", "bucket",
    "next_text", "mh", "sh", "label", "host", "path", "n_words", "items", "removed", "first", "spans",
)

PROSE = (
    "The quick brown fox jumps over the lazy dog near the river bank. It was a bright cold day in April. "
    "Nobody knew where the children had gone after school! Was it the garden again?\nThey would surely be back for tea. "
)

TEXTS = [
    (1, PROSE * 3),
    (2, PROSE * 3),  # a copy
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, "word"),
    (7, "two words"),
    (8, "Écoute, naïve café: ünïcode 日本語 ẞ İ " + PROSE),
    (9, "Prefix here. " + PROSE * 2 + "And a tail of its own."),
    (None, PROSE + "Without an id."),
    (10, "again " * 400),
    (10, "another row of the same id"),
    (11, "x" * 5000),
    (12, "long words " * 3000 + PROSE),
    (13, "... !! ? a. b. c. d."),
    (14, "a.b c.d\r\ne.f\x0bg\x0ch"),
    (2, PROSE * 3),  # a repeated row
]


def docs(spark, rows=TEXTS):
    """Documents with null languages and sources and columns of clashing names."""
    table = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *(F.lit(7).alias(name) for name in CLASHING))


@contextlib.contextmanager
def changed(module, **values):
    """Other constants of a module for a while."""
    before = {name: getattr(module, name) for name in values}
    for name, value in values.items():
        setattr(module, name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            setattr(module, name, value)


def result(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def sample(spark, sf_dir):
    """(doc_id, text) of a whole small table."""
    return [tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
