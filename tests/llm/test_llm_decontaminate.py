import hashlib
import re

import duckdb
import pyarrow.parquet as pq
import pytest
from cases import PROSE, TEXTS, changed, docs, result
from compare import compare
from pyspark.sql import functions as F

from starlift.llm import decontaminate, oracle, queries

ITEMS = [
    (1, "quick brown fox jumps over the lazy dog near the river bank"),
    (1, "a bright cold day in April"),
    (2, "again"),
    (3, None),
    (4, "?!"),
    (None, "children had gone after school"),
    (5, "NAÏVE café ünïcode 日本語 ẞ İ the quick brown fox jumps and no further words"),
    (6, "nothing of this stands anywhere at all in those texts here"),
]


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        found, hit, names = words(text), set(), set()
        for item, phrase in items:
            wanted = words(phrase)
            size = min(10, len(wanted))
            for k in range(len(wanted) - size + 1 if size else 0):
                for at in range(len(found) - size + 1):
                    if found[at : at + size] == wanted[k : k + size]:
                        hit.update(range(at, at + size))
                        names.add("" if item is None else str(item))
        out.append((doc_id, len(found), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_near(rows, items, slop):
    """Per row the items of which some window has every word within ``slop`` of its place, and
    no window stands exactly."""
    out = []
    for doc_id, text in rows:
        found, near, exact = words(text), set(), set()
        for item, phrase in items:
            wanted, name = words(phrase), "" if item is None else str(item)
            size = min(10, len(wanted))
            for k in range(len(wanted) - size + 1 if size else 0):
                window = wanted[k : k + size]
                for at in range(-slop, len(found) + slop):
                    if found[max(0, at) : at + size] == window and at >= 0:
                        exact.add(name)
                    if all(word in found[max(0, at + j - slop) : max(0, at + j + slop + 1)] for j, word in enumerate(window)):
                        near.add(name)
        out.append((doc_id, len(near - exact), sorted(near - exact)))
    return sorted(out, key=repr)


def as_rows(frame):
    return result(frame.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest("items")))


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as runs", "2 as at", "3 as doc_id")


@pytest.mark.parametrize("block, part, slop", [(2 << 20, 2_000_000, 0), (100, 2_000_000, 1), (1000, 12, 2)])
def test_awkward_rows(spark, block, part, slop):
    search = decontaminate.Search(part_words=part, slop=slop)
    with changed(decontaminate, BLOCK=block):
        assert as_rows(decontaminate.contamination(docs(spark), benchmark(spark), search)) == brute(TEXTS, ITEMS)


# Words put in, left out, swapped, one and two places off, at the ends and across a text's end.
NEARLY = [
    (1, "a b c d e f g h i j k l"),
    (2, "x a b c d e new f g h i j k l"),
    (3, "a b c d f g h i j k l"),
    (4, "a b d c e f g h i j k l"),
    (5, "a b c one two d e f g h i j k l"),
    (6, "b a c d e"),
    (7, "f g h i j k l m"),
    (8, None),
    (9, "j i h g f e d c b a"),
    (10, "a a a b c d e f g h h i j"),
    (None, "q a r b s c t d"),
    (2, "x a b c d e new f g h i j k l"),
]
PHRASES = [(1, "a b c d e f g h i j"), (2, "c d e f g h i j k l m"), (3, "a b c d"), (None, "f g"), (4, "a"), (3, "j i x"), (5, ""), (6, None)]


@pytest.mark.parametrize("slop", [0, 1, 2])
@pytest.mark.parametrize("block, part", [(2 << 20, 2_000_000), (30, 10)])
def test_near_items_equal_brute_force(spark, slop, block, part):
    search = decontaminate.Search(slop=slop, part_words=part)
    with changed(decontaminate, BLOCK=block):
        found = decontaminate.contamination(docs(spark, NEARLY).coalesce(2), benchmark(spark, PHRASES), search).cache()
        assert as_rows(found) == brute(NEARLY, PHRASES)
        assert result(found.select("doc_id", "n_near", "near_items")) == brute_near(NEARLY, PHRASES, slop)
    assert slop == 0 or found.filter("n_near > 0").count() > 3


def test_near_items_equal_sql(spark, tmp_path):
    docs(spark, NEARLY).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark(spark, PHRASES).select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(oracle.oracle()["op9_decontaminate"])
    names = [column[0] for column in want.description]
    assert result(queries.op9_decontaminate(spark, str(tmp_path)).select(*names)) == sorted(want.fetchall(), key=repr)


def test_parts_hold_whole_windows(spark):
    # An item longer than a part is cut into pieces that share all words of a window but one.
    long = " ".join(f"w{k}" for k in range(500))
    search = decontaminate.Search(part_words=40)
    parts = decontaminate.cut_items(benchmark(spark, [(1, long), (2, "a b c")]), search).collect()
    assert max(len(part["ids"]) for part in parts) <= 40 and len({part["part"] for part in parts}) == len(parts)
    windows = {tuple(part["words"][k] for k in part["ids"][at : at + 10]) for part in parts for at in range(31) if len(set(part["names"])) == 1}
    assert {tuple(f"w{k}".encode() for k in range(at, at + 10)) for at in range(0, 491)} - windows == set()
    with pytest.raises(ValueError, match="cannot hold"):
        decontaminate.cut_items(benchmark(spark), decontaminate.Search(part_words=9))


def test_empty_tables(spark):
    assert as_rows(decontaminate.contamination(docs(spark, []), benchmark(spark))) == []
    assert as_rows(decontaminate.contamination(docs(spark), benchmark(spark, []))) == brute(TEXTS, [])


def test_query_equals_sql(spark, sf_dir, tables):
    assert compare(queries.op9_decontaminate(spark, sf_dir), tables, oracle.oracle()["op9_decontaminate"]) is None


def test_phrases_dont_cross_documents(spark):
    rows = [(1, "one two three four five"), (2, "six seven eight nine ten")]
    items = [(1, "one two three four five six seven eight nine ten")]
    assert as_rows(decontaminate.contamination(docs(spark, rows), benchmark(spark, items))) == brute(rows, items)


def test_proximity_matches(spark):
    rows = [(1, PROSE), (2, PROSE.replace("brown fox", "brown and shy fox")), (3, "nothing of the kind")]
    items = [(1, "the quick brown fox jumps over the lazy dog near")]
    near = decontaminate.contamination(docs(spark, rows), benchmark(spark, items), decontaminate.Search(slop=2))
    assert [(row["n_hit"] > 0, row["n_near"] > 0) for row in near.orderBy("doc_id").collect()] == [(True, False), (False, True), (False, False)]


@pytest.mark.parametrize("slop", [1, 2])
def test_near_matches_dont_cross_documents(spark, slop):
    # With slop 1 the gap of one place let c be found one place off, in the next document.
    rows = [(1, "a b"), (2, "c d e"), (3, "x a b y c d e")]
    items = [(1, "a b c d e"), (2, "a b y c d e")]
    found = decontaminate.contamination(docs(spark, rows).coalesce(1), benchmark(spark, items), decontaminate.Search(slop=slop))
    found = {row["doc_id"]: (row["n_hit"], row["n_near"] > 0, row["near_items"]) for row in found.collect()}
    assert found == {1: (0, False, []), 2: (0, False, []), 3: (6, True, ["1"])}


def test_near_match_at_the_start_is_of_its_own_document(spark):
    # The rarest word is one place early, so the match would begin before its document.
    rows = [(1, "b b c c d d"), (2, "rare d"), (3, "b c d")]
    found = decontaminate.contamination(docs(spark, rows).coalesce(1), benchmark(spark, [(1, "rare b d")]), decontaminate.Search(slop=1))
    assert {row["doc_id"]: row["n_near"] for row in found.collect()} == {1: 0, 2: 0, 3: 0}
    found = decontaminate.contamination(docs(spark, rows).coalesce(1), benchmark(spark, [(1, "d rare")]), decontaminate.Search(slop=2))
    assert {row["doc_id"]: row["n_near"] > 0 for row in found.collect()} == {1: False, 2: True, 3: False}


def test_a_task_reads_few_blocks_of_the_index_at_once(spark):
    # Readers decode a row group's rows together, so a group has few of these large rows.
    long = F.repeat(F.lit("x"), decontaminate.BLOCK)
    texts = spark.range(0, 3 * decontaminate.TOGETHER + 1, 1, 1).select(F.col("id").alias("doc_id"), long.alias("text"))
    index = decontaminate.build_index(texts)
    (file,) = index.inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file:")).metadata
    sizes = [meta.row_group(at).num_rows for at in range(meta.num_row_groups)]
    assert sizes == [decontaminate.TOGETHER] * 3 + [1]
