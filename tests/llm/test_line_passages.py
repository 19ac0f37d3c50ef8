import random
import re
import time

import pytest

from webmart.llm import line_dedup


def words(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


def sentences(found, size=9):
    return " ".join(" ".join(found[i : i + size]) + "." for i in range(0, len(found), size))


def found(spark, rows):
    out = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {row.doc_id: row for row in out}


@pytest.mark.parametrize("cut", [sentences, " ".join], ids=["sentences", "no punctuation"])
def test_passage_within_a_line(spark, cut):
    passage = cut(words(1, 55))
    texts = {
        1: f"{cut(words(2, 200))} {passage} {cut(words(3, 200))}",
        2: f"{cut(words(4, 300))} {passage} {cut(words(5, 450))}",
    }
    rows = found(spark, list(texts.items()))
    assert rows[1].unique_text == texts[1] and rows[1].repeated == []
    spans = [texts[2][s.start : s.end] for s in rows[2].repeated]
    assert len(spans) == 1 and spans[0].strip() in passage
    # without sentence ends, the units at both ends reach beyond the passage
    assert len(spans[0].split()) == 55 if cut is sentences else len(spans[0].split()) >= 20
    assert rows[2].unique_text == texts[2].replace(spans[0], "")
    assert rows[2].text == texts[2]


def test_near_copy_keeps_only_what_differs(spark):
    text = sentences(words(6, 90))
    copy = text.replace(text.split(". ")[4], "here are some other words instead")
    rows = found(spark, [(1, text), (2, copy)])
    assert rows[2].unique_text == "here are some other words instead. "


def test_repeated_lines_are_repeated_text(documents):
    texts = {(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()}
    texts = dict(texts)
    for row in line_dedup.without_repeats(documents).collect():
        at = {i for s in row.repeated for i in range(s.start, s.end)}
        assert all(at.issuperset(range(s.start, s.end)) for s in row.removed)
        assert len(row.unique_text) <= len(row.text) <= len(texts[row.doc_id])


def test_short_lines_and_scripts_without_spaces(spark):
    han = "".join(map(chr, range(0x4E00, 0x4E00 + 400)))
    copied = han[100:200]
    texts = {
        1: f"Home\n{han}\nOne. Two.\n-",
        2: f"A line of its own.\nhome\n{han}\nOne. Two.\n-\nend",
        3: f"{han[300:]}{copied}{han[:60]}\nOne. Three.",
        4: "HOME",
    }
    rows = found(spark, list(texts.items()))
    assert rows[1].unique_text == texts[1]
    assert rows[2].unique_text == "A line of its own.\nend"
    assert rows[4].unique_text == ""
    spans = [texts[3][s.start : s.end] for s in rows[3].repeated]
    assert sum(len(span) for span in spans if span in copied) >= 50
    assert rows[3].unique_text.endswith("\nOne. Three.")


#: Sentences by a form that gives characters back, as slow as the square of a run of end marks.
PLAIN_SENTENCE = re.compile(r".+?(?:[.!?…]+[\"')\]»”’]*(?=\s|\Z)|[。！？]+[」』”’]*|\Z)\s*")


def test_sentences_are_those_of_the_plain_form():
    draw = random.Random(8)
    for _ in range(40_000):
        line = "".join(draw.choices("ab .!?…。！」\"') \t日", k=draw.randint(1, 14)))
        wanted = [match.span() for match in PLAIN_SENTENCE.finditer(line)]
        assert [match.span() for match in line_dedup._SENTENCE.finditer(line)] == wanted, line


@pytest.mark.parametrize("mark", [".", "!", "?\"", "…", "。", ". ", "a.", ".)"])
def test_runs_of_end_marks_take_no_time(mark):
    began = time.time()
    line_dedup.passage_units(mark * 1_000_000 + "x")
    assert time.time() - began < (1 if mark in ".!…" else 20)
