"""Substring dedup by hashing lines and the passages within them.

Each line of at least ``least`` words is normalised (lower case, single spaces) and hashed to 96 bits. Occurrences are
ranked by doc_id and place; the first keeps its text and every later one is removed, wherever it stands. A first pass
counts 64 bits of each digest, before and after the shuffle, so a line that a third of all documents share sends one row
per task. A second pass hashes again and keeps the occurrences of the digests that the first pass met twice; these are saved,
and so is the first of each by all 96 bits, so that Spark splits both joins where one digest is crowded.

Lines are hashed a second time in sentence-sized units (``passage_units``), ranked in the same way, so that a passage
inside a longer line is found too. A sentence of over ``LONG_WORDS`` words is cut between two words chosen by the hash of
both, so that copies are cut alike wherever they stand. Each letter of a script without spaces counts as a word here. A
unit of fewer than ``LEAST_WORDS`` words counts as repeated only together with a neighbour in its line; if it is the whole
line, it counts alone: these units have no floor. Passages are found by their whole units: parts of sentences at both ends of a copy stay.

Offsets are code points in the original text, ends exclusive: ``removed`` lists the lines taken out, ``kept`` what is
left, and ``text`` is the kept stretches one after the other. A removed line takes the line end after it along.
``repeated`` lists all repeated units, touching ones as one span, and with them all of ``removed``; ``unique_text`` is the
original text without them, in which a line that is repeated throughout takes its line end along.
Null text stays null with no spans; an empty text has none. Rows with the same doc_id and text are one document, each
repeating its result. Rows without doc_id rank last. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import Columns, in_batches, saved

LEAST_WORDS = 5
#: Sentences of more words are cut further, one place in ``CUT`` on average.
LONG_WORDS = 32
CUT = 12
_LINE = re.compile(r"[^\n]+")
#: From a first character on: text without end marks, runs of end marks that no space follows, then what ends the sentence.
#: Nothing is given back, so a run of end marks is passed once.
_SENTENCE = re.compile(
    r".(?:[^.!?…。！？]++|[.!?…]++[\"')\]»”’]*+(?!\s|\Z))*+(?:[.!?…]++[\"')\]»”’]*+|[。！？]++[」』”’]*+|\Z)\s*+"
)
#: Letters of scripts written without spaces (Thai to Khmer, kana, Han); each counts as a word.
_LETTERS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_LETTERS}]")
_WORD = re.compile(rf"[{_LETTERS}]|[^\s{_LETTERS}]+")
SPANS = "array<struct<start: int, end: int>>"


def _digest(words: str, seed: int = 0) -> bytes:
    return xxhash.xxh3_128_digest(words.encode("utf-8"), seed)


def line_units(text: str | None, least: int = LEAST_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the lines with enough words."""
    found = []
    for match in _LINE.finditer(text or ""):
        words = match[0].lower().split()
        if len(words) >= least:
            found.append((match.start(), match.end(), _digest(" ".join(words))))
    return found


def _pieces(line: str) -> Iterator[tuple[int, int, str]]:
    """(end, number of words, normalised text) of the sentences of a line, long ones cut further."""
    for sentence in _SENTENCE.finditer(line):
        split = sentence[0].lower().split()
        n = len(_WORD.findall(sentence[0])) if _UNSPACED.search(sentence[0]) else len(split)
        if n <= LONG_WORDS:
            yield sentence.end(), n, " ".join(split)
            continue
        n, before, begin = 0, "", sentence.start()
        for match in _WORD.finditer(line, sentence.start(), sentence.end()):
            word = match[0].lower()
            if n and xxhash.xxh3_64_intdigest(f"{before} {word}".encode("utf-8")) % CUT == 0:
                yield match.start(), n, " ".join(line[begin : match.start()].lower().split())
                n, begin = 0, match.start()
            n, before = n + 1, word
        yield sentence.end(), n, " ".join(line[begin : sentence.end()].lower().split())


def passage_units(text: str | None, least: int = LEAST_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the sentence-sized units of each line; digests differ from those of lines.

    Units with fewer words have two digests, one with the unit before and one with the unit after, unless they are a line.
    """
    found = []
    for match in _LINE.finditer(text or ""):
        line, at = match[0], match.start()
        pieces, begin = [], 0
        for end, n, words in _pieces(line):
            if n:
                pieces.append((begin, end, n, words))
                begin = end
        for i, (begin, end, n, words) in enumerate(pieces):
            if n >= least or len(pieces) == 1:
                found.append((at + begin, at + end, _digest(words, 1)))
                continue
            if i:
                found.append((at + begin, at + end, _digest(f"{pieces[i - 1][3]} {words}", 2)))
            if i + 1 < len(pieces):
                found.append((at + begin, at + end, _digest(f"{words} {pieces[i + 1][3]}", 3)))
    return found


def cut_out(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the spans, and the spans, touching ones as one; whole lines take their line end along."""
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    left, at = [], 0
    for start, end in merged:
        left.append(text[at:start])
        whole = (start == 0 or text[start - 1] == "\n") and text[end : end + 1] == "\n"
        at = end + whole
    return "".join(left) + text[at:], merged


_KEY = ">qi"


def units(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row for each line with enough words and each unit within lines: key and rest of the digest, doc_id, text_hash,
    place (start, end and whether it is within a line, in one number that orders by start)."""

    def start():
        def apply(columns: Columns) -> Columns:
            rows = [
                (*struct.unpack_from(_KEY, digest), doc_id, text_hash, begin << 32 | end << 1 | inner)
                for doc_id, text_hash, text in zip(columns["doc_id"], columns["text_hash"], columns["text"])
                for inner, found in ((0, line_units(text, least)), (1, passage_units(text)))
                for begin, end, digest in found
            ]
            names = ("key", "rest", "doc_id", "text_hash", "place")
            return dict(zip(names, map(list, zip(*rows)))) if rows else {name: [] for name in names}

        return apply

    schema = "key long, rest int, doc_id long, text_hash long, place long"
    return in_batches(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), schema, start)


def keys(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The column key of ``units``."""

    def start():
        def apply(columns: Columns) -> Columns:
            found = (unit for text in columns["text"] for unit in (*line_units(text, least), *passage_units(text)))
            return {"key": [struct.unpack_from(_KEY, digest)[0] for _, _, digest in found]}

        return apply

    return in_batches(docs.select("text"), "key long", start)


def repeats(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Per document with text that occurred before: doc_id, text_hash, spans by start of lines and of units within lines."""
    often = saved(keys(docs, least).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    found = saved(units(docs, least).join(often, "key"))
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "place")
    # saved, so that the join is one of two plain shuffles, which Spark splits where one digest is crowded
    first = saved(found.groupBy("key", "rest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1"))
    later = found.withColumn("rank", rank).join(first, ["key", "rest"]).where(F.col("rank") != F.col("first"))
    begin = F.shiftright("place", 32).cast("int").alias("start")
    end = F.shiftright(F.col("place").bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int").alias("end")
    kind = F.col("place").bitwiseAND(F.lit(1))
    lines, inner = (F.collect_set(F.when(kind == k, F.struct(begin, end))) for k in (0, 1))
    return later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(lines).alias("removed"), F.array_sort(inner).alias("repeated")
    )


def without_repeats(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Per row: doc_id, text without repeated lines, n_removed, and the spans removed and kept; then the spans of all
    repeated text, and the text without it."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("d")
    found = repeats(docs, least).alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_hash") == F.col("r.text_hash"))
    marked = rows.join(found, same, "left").select("d.doc_id", "d.text", "r.removed", "r.repeated")

    def start():
        def apply(columns: Columns) -> Columns:
            texts, kept = [], []
            for text, spans in zip(columns["text"], columns["removed"]):
                left, at = [], 0
                for span in spans or ():
                    if span["start"] > at:
                        left.append((at, span["start"]))
                    at = span["end"] + (text[span["end"] : span["end"] + 1] == "\n")
                if text and at < len(text):
                    left.append((at, len(text)))
                kept.append([{"start": a, "end": b} for a, b in left])
                texts.append(text if not spans else "".join(text[a:b] for a, b in left))
            removed = [spans or [] for spans in columns["removed"]]
            repeated, unique = [], []
            for text, lines, inner in zip(columns["text"], removed, columns["repeated"]):
                spans = sorted((span["start"], span["end"]) for span in [*lines, *(inner or ())])
                rest, spans = cut_out(text, spans) if spans else (text, [])
                repeated.append([{"start": a, "end": b} for a, b in spans])
                unique.append(rest)
            return {
                "doc_id": columns["doc_id"],
                "text": texts,
                "n_removed": [len(spans) for spans in removed],
                "removed": removed,
                "kept": kept,
                "repeated": repeated,
                "unique_text": unique,
            }

        return apply

    schema = f"doc_id long, text string, n_removed int, removed {SPANS}, kept {SPANS}"
    return in_batches(marked, f"{schema}, repeated {SPANS}, unique_text string", start)
