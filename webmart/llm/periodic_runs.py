"""Periodic runs of words: suffix trees with constant-time extension queries over Lyndon-root candidates.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends keeping that period; runs of at least ``LEAST_WORDS`` words and ``LEAST_REPEATS`` periods are reported. A text is turned into numbers, one for each
word. Ukkonen's algorithm builds the suffix tree of the numbers and that of their reversal; a tour of each gives the order of
the suffixes and the depth of the shallowest node between neighbours, in which a sparse table answers how long two places agree. Every
run has a period that is a longest Lyndon word under the words' order or its reverse; those words end where the next
smaller suffix begins, so each order gives one candidate a place, extended in both directions.

Before that, words that cannot lie in a run are set aside, which is exact: a run of four periods holds each of its words
four times, so a word that is rarer within a stretch parts the stretch in two, and so on until nothing changes. What is left of
a text goes into its trees, stretches apart from each other by numbers that occur once.

Words are runs of anything but the characters 32 and 9 to 13, numbered from 0. Null and empty texts have no words and no
runs. Rows are independent: repeated rows repeat their result; other columns are ignored. Runs are listed by start, then by
period. Work on a text grows in proportion to its words (sparse tables: with their logarithm), memory likewise.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import Columns, in_batches

LEAST_WORDS = 6
LEAST_REPEATS = 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = "array<struct<start: long, length: long, period: long>>"
Run = tuple[int, int, int]


class SuffixTree:
    """Suffix tree of a list of numbers of one and more; 0 is put at the end, smaller than all."""

    def __init__(self, numbers: Sequence[int]):
        self.numbers = [*numbers, 0]
        self._build()

    def _build(self) -> None:
        text = self.numbers
        size = len(text)
        begin, stop, link = [0], [0], [0]  # the edge into each node, and the node of the suffix without its first number
        arcs: list[dict[int, int] | None] = [{}]  # None for leaves
        node = edge = length = remaining = 0
        for place, number in enumerate(text):
            remaining += 1
            waiting = 0
            while remaining:
                if not length:
                    edge = place
                first = text[edge]
                child = arcs[node].get(first)
                if child is None:
                    arcs[node][first] = len(arcs)
                    begin.append(place), stop.append(size), link.append(0), arcs.append(None)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    span = min(stop[child], place + 1) - begin[child]
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    split = begin[child] + length
                    if text[split] == number:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    middle, leaf = len(arcs), len(arcs) + 1
                    begin += (begin[child], place)
                    stop += (split, size)
                    link += (0, 0)
                    arcs += ({number: leaf, text[split]: child}, None)
                    arcs[node][first] = middle
                    begin[child] = split
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = place - remaining + 1
        self.begin, self.stop, self.arcs = begin, stop, arcs

    def tour(self, reverse: bool = False) -> tuple[list[int], list[int]]:
        """The suffixes in order, by where they begin, and the depth of the shallowest node between each and the next.

        The end is smaller than all numbers in either order.
        """
        begin, stop, arcs, size = self.begin, self.stop, self.arcs, len(self.numbers)
        suffixes, between = [], []
        shallowest = 0
        ahead = [(0, 0, 0)]  # node, its depth, the depth of its parent
        while ahead:
            node, depth, above = ahead.pop()
            shallowest = min(shallowest, above)
            if arcs[node] is None:
                if suffixes:
                    between.append(shallowest)
                suffixes.append(size - depth)
                shallowest = depth
                continue
            numbers = sorted(arcs[node], reverse=not reverse)  # the last one pushed is the first one visited
            if reverse and numbers[0] == 0:
                numbers = [*numbers[1:], 0]
            for number in numbers:
                child = arcs[node][number]
                ahead.append((child, depth + stop[child] - begin[child], depth))
        return suffixes, between


class Agreement:
    """How many numbers two suffixes of a text have in common at their beginnings, in constant time."""

    def __init__(self, suffixes: list[int], between: list[int]):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = [np.asarray(between, np.int32)]
        width = 1
        while 2 * width <= len(between):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For pairs of different places."""
        a, b = self.rank[left], self.rank[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            found[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k))])
        return found


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place but the last the next one of smaller rank; the last has the smallest of all."""
    later = [0] * (len(rank) - 1)
    open_places: list[int] = []
    for place, value in enumerate(rank):
        while open_places and rank[open_places[-1]] > value:
            later[open_places.pop()] = place
        open_places.append(place)
    return later


def runs_of(numbers: Sequence[int], least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[Run]:
    """(start, length, period) of the runs of a sequence of numbers of one and more, by start, then by period."""
    size = len(numbers)
    if size < least:
        return []
    tree = SuffixTree(numbers)
    suffixes, between = tree.tour()
    forward = Agreement(suffixes, between)
    backward_rank = np.empty(size + 1, np.int64)
    backward_rank[tree.tour(reverse=True)[0]] = np.arange(size + 1)
    del tree
    backward = Agreement(*SuffixTree(numbers[::-1]).tour())
    places = np.arange(size)
    found: set[Run] = set()
    for rank in (forward.rank, backward_rank):
        ends = np.asarray(_next_smaller(rank.tolist()))
        after = forward(places, ends)
        before = np.zeros(size, np.int64)
        inner = (places > 0) & (ends < size)
        # the reversal ends where the text begins: what lies before place p begins there at size - p
        before[inner] = backward(size - places[inner], size - ends[inner])
        period = ends - places
        length = before + period + after
        good = (length >= least) & (length >= repeats * period)
        found.update(zip((places - before)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(numbers: np.ndarray, owner: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """The places that may lie in a run, and the stretch that each is in.

    ``owner`` names the text of each number in ascending order; no stretch spans two. Each round drops the numbers that occur
    fewer than ``repeats`` times in their stretch, and stretches shorter than ``least``, until none is left to drop.
    """
    places = np.arange(len(numbers))
    while len(places):
        same = np.empty(len(places), bool)
        same[0] = False
        same[1:] = (np.diff(places) == 1) & (owner[places[1:]] == owner[places[:-1]])
        stretch = np.cumsum(~same) - 1
        key = stretch * (int(numbers.max()) + 1) + numbers[places]
        _, index, count = np.unique(key, return_inverse=True, return_counts=True)
        good = (count[index] >= repeats) & (np.bincount(stretch)[stretch] >= least)
        if good.all():
            return places, stretch
        places = places[good]
    return places, places


def find_in(texts: list[list[str]], least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[list[Run]]:
    """The runs of each of several lists of words."""
    codes: dict[str, int] = {}
    numbers = np.array([codes.setdefault(word, len(codes) + 1) for words in texts for word in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in texts]
    places, stretch = stretches(numbers, owner, least, repeats)
    if not len(places):
        return found
    cuts = np.flatnonzero(np.diff(owner[places])) + 1
    for part, parted in zip(np.split(places, cuts), np.split(stretch, cuts)):
        text = owner[part[0]]
        # a number of its own goes between stretches
        breaks = np.flatnonzero(np.diff(parted)) + 1
        inserted = np.insert(numbers[part], breaks, len(codes) + 1 + np.arange(len(breaks)))
        original = np.insert(part, breaks, -1) - first[text]
        runs = runs_of(inserted.tolist(), least, repeats)
        found[text] = [(int(original[start]), length, period) for start, length, period in runs]
    return found


def collapsed(words: list[str], runs: list[Run]) -> list[str]:
    """The words without those that some run repeats after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [word for word, dropped in zip(words, np.cumsum(drop[:-1]) > 0) if not dropped]


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> DataFrame:
    """Per row: doc_id, its runs, and its words without repeated periods, joined by single spaces."""

    def start():
        def apply(columns: Columns) -> Columns:
            texts = [_WORD.findall(text or "") for text in columns["text"]]
            found = find_in(texts, least, repeats)
            return {
                "doc_id": columns["doc_id"],
                "runs": [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found],
                "collapsed": [" ".join(collapsed(words, runs)) for words, runs in zip(texts, found)],
            }

        return apply

    return in_batches(docs.select("doc_id", "text"), f"doc_id long, runs {RUNS}, collapsed string", start, rows=64)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten, by the crc32 of its id, the words from some place on repeat with a period.

    Texts without words and rows without doc_id stay as they are.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = docs.select("doc_id", "text", crc.alias("h"), F.when(crc % 10 == 0, words).alias("words"))
    rows = rows.withColumns({"n": F.nullif(F.size("words"), F.lit(0)), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.col("g") % F.col("n")).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    )
    planted = F.transform(
        "words",
        lambda word, i: F.when(
            i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        ).otherwise(word),
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per row of :func:`find_runs`: doc_id, n_runs, the longest run, and sha256 of all runs and of the collapsed words."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")),
        )
    )
    rows = found.withColumn("longest", longest)
    length, start, period = F.col("longest.length"), -F.col("longest.start"), -F.col("longest.period")

    def line(run):
        return F.concat(F.concat_ws(",", *[run[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n"))

    lines = F.transform("runs", line)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
