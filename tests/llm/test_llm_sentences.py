import hashlib
import random
import re

import pytest
from cases import PROSE, TEXTS, docs, result
from compare import compare, connect

from starlift.llm import oracle, queries, sentences
from starlift.llm.sentences import Spans

SPACES = " \t\n\x0b\f\r"


def brute(rows, spans=Spans()):
    """(doc_id, kept, units, removed) from a plain reading of the rules."""
    cut = [[u for s in split(text) for u in parts(s, spans)] for _, text in rows]
    places = {}
    for row, ((doc_id, text), pieces) in enumerate(zip(rows, cut)):
        for at in range(len(pieces) - spans.run + 1):
            key = tuple(" ".join(u.strip(SPACES).split()) for u in pieces[at : at + spans.run])
            digest = hashlib.md5((text or "").encode()).hexdigest()[:15]
            places.setdefault(key, []).append((doc_id is None, doc_id or 0, at, digest, row))
    gone = [set() for _ in rows]
    for found in places.values():
        for _, _, at, _, row in sorted(found)[1:]:
            gone[row].update(range(at, at + spans.run))
    out = []
    for (doc_id, _), pieces, places in zip(rows, cut, gone):
        kept = "".join(p for k, p in enumerate(pieces) if k not in places)
        out.append((doc_id, kept, len(pieces), len(places)))
    return sorted(out, key=repr)


def split(text):
    """Character by character: a sentence ends after full stops before space, or at a line's end."""
    text, out, now = (text or "").lstrip(SPACES), [], ""
    for k, c in enumerate(text):
        now += c
        following = text[k + 1 : k + 2]
        if c in SPACES and following and following not in SPACES:
            body = now.rstrip(SPACES)
            if "\n" in now or body[-1:] in ".!?":
                out.append(now)
                now = ""
    return out + [now] if now else out


def parts(sentence, spans):
    words = re.findall(f"[^{SPACES}]+[{SPACES}]*", sentence)
    if len(words) <= spans.longest:
        return [sentence]
    hashes = [hashlib.md5(word.rstrip(SPACES).encode()).hexdigest()[:8] for word in words]
    out, now = [], []
    for k, word in enumerate(words):
        now.append(word)
        smaller = all(hashes[k] < h for h in hashes[max(0, k - spans.radius) : k])
        if len(now) == spans.most or (smaller and all(hashes[k] <= h for h in hashes[k + 1 : k + 1 + spans.radius])):
            out.append("".join(now))
            now = []
    return out + ["".join(now)] if now else out


SETTINGS = [Spans(), Spans(3, 25), Spans(2, 5, 1, 4), Spans(4, 1, 2, 3)]


@pytest.mark.parametrize("spans", SETTINGS)
def test_awkward_rows(spark, spans):
    assert result(sentences.without_repeats(docs(spark), spans)) == brute(TEXTS, spans)


def test_rows_of_one_id_are_texts_of_their_own(spark):
    rows = [(1, "A b. C d. E f."), (1, "G h. A b. C d. E f."), (2, "A b. C d. E f. Then."), (1, "A b. C d. E f. Later.")]
    assert result(sentences.without_repeats(docs(spark, rows))) == brute(rows)


def test_one_of_equal_rows_keeps_its_text(spark):
    rows = [(5, "A b. C d. E f. G h.")] * 3 + [(None, "I j. K l. M n.")] * 2 + [(6, "Two. Only.")] * 2
    found = result(sentences.without_repeats(docs(spark, rows)))
    assert found == brute(rows)
    assert [text for doc_id, text, *_ in found if doc_id == 5] == ["", "", rows[0][1]]


def test_empty_table(spark):
    assert result(sentences.without_repeats(docs(spark, []))) == []


@pytest.mark.parametrize("spans", SETTINGS)
def test_units_make_up_the_text(spans):
    draw = random.Random(3)
    texts = [text for _, text in TEXTS] + [" ".join(draw.choices("abcdefg", k=draw.randint(1, 90))) for _ in range(50)]
    for text in texts:
        assert "".join(sentences.units(text, spans)) == (text or "").lstrip(SPACES)
        assert sentences.units(text, spans) == [u for s in split(text) for u in parts(s, spans)]


def test_three_equal_sentences_go(spark):
    rows = [(1, "Own one. A b. C d. E f."), (2, "A b. C d. E f. Its own.")]
    assert result(sentences.without_repeats(docs(spark, rows)))[1][1] == "Its own."


def test_passages_over_fifty_words_within_sentences(spark):
    """Of 400 passages of 51 words put into the middle of sentences, unpunctuated or punctuated,
    nearly all lose at least half of their words in the later document, and none in the first."""
    draw = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "")]
    rows, passages = [], []
    for k in range(400):
        words = draw.choices(vocabulary, k=51)
        if k % 2:
            for at in range(draw.randint(3, 15), 51, draw.randint(6, 15)):
                words[at] += "."
        passages.append(words)
        for copy in (0, 1000):
            own = [f"{x}{k}{copy}" for x in draw.choices(vocabulary, k=draw.randint(1, 12))]
            rows.append((k + copy, f"{' '.join(own)} {' '.join(words)} {' '.join(reversed(own))} end."))
    kept = {doc_id: text for doc_id, text, *_ in result(sentences.without_repeats(docs(spark, rows)))}
    texts = dict(rows)
    assert all(kept[k] == texts[k] for k in range(400))
    lost = [len(texts[k + 1000].split()) - len(kept[k + 1000].split()) for k in range(400)]
    assert sum(n >= 26 for n in lost) >= 396 and sum(n > 0 for n in lost) >= 399


def test_a_long_passage_goes_wherever_its_sentence_began(spark):
    draw = random.Random(5)
    passage = " ".join(f"w{draw.randint(0, 10**6)}" for _ in range(3000))
    rows = [(1, f"one two {passage}"), (2, f"three {passage}"), (3, PROSE)]
    kept = {doc_id: text for doc_id, text, *_ in result(sentences.without_repeats(docs(spark, rows)))}
    assert kept[1] == rows[0][1] and len(kept[2].split()) < 40 and kept[3] == PROSE


def test_query_equals_sql(spark, sf_dir, tables):
    assert compare(queries.op10_sentences(spark, sf_dir), tables, oracle.oracle()["op10_sentences"]) is None


def test_rows_without_an_id_lose_only_their_own_units(spark, tmp_path):
    rows = [(None, "A b. C d. E f. G h. I j."), (None, "Own k. A b. C d. E f. G h."), (None, "Clean l. Clean m. Clean n. Clean o. Clean p. Clean q.")]
    rows += [(7, "A b. C d. E f. G h."), (7, "A b. C d. E f. G h."), (7, "A b. C d. E f. Z z.")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet/")
    spark.read.parquet(f"{tmp_path}/documents.parquet").coalesce(1).write.parquet(f"{tmp_path}/one")
    connection = connect("/nowhere")
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/one/*.parquet')")
    found = queries.op10_sentences(spark, str(tmp_path))
    assert compare(found, connection, oracle.oracle()["op10_sentences"]) is None
    assert result(found.select("doc_id", "text", "n_sentences", "n_removed")) == brute(rows)
