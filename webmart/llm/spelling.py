"""Spelling variants: a vocabulary acceptor composed with a one-edit transducer and with itself.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The words are accepted by a
minimised automaton; the transducer copies code points, makes one edit at the first place where two words differ, and copies
again. A path of the composition (acceptor, transducer, acceptor) is a near pair, and as the edit stands at the first
difference each pair has one path only.

The composition is enumerated per partition of its initial states. A partition holds the words that have passed the same
first code points without an edit and that will pass the same last ones after it, so the edit lies between: at a place
from ``begin`` to before ``end``, counted in the shorter word. A word belongs to two partitions for each length that it can have in
a pair, one for an edit in either half. A partition of more than ``MOST_WORDS`` words, or of over ``WIDEST`` places, is cut at
its middle place, until it fits; one of a single place holds no more words than there are code points in use, twice.
So no task ever holds a large group, whatever words share, and no pair is lost or met twice. Within a partition only
the middle parts of the words are compiled.

A word's form is the near word of largest count (ties: the smallest in code-point order) if that count is at least
``DOMINANCE`` times its own; its root is the last of the forms that follow each other. A chain of forms is short, as counts grow by that factor.

Words are matched by code points. A null word or count takes no part; repeated words of a vocabulary add up their counts; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import Columns, in_batches, saved

LEAST_LETTERS = 7
LEAST_COUNT = 2
DOMINANCE = 10
MOST_WORDS = 2000
WIDEST = 32
PARTITION = ("shorter", "begin", "end", "head", "tail")


class Acceptor:
    """Minimal acyclic automaton of a set of strings, built from them in order.

    State 0 accepts the empty string and has no arcs; ``arcs[state]`` maps a code point to the next state.
    """

    def __init__(self, strings: Iterable[str]):
        self.final = [True]
        self.arcs: list[dict[str, int]] = [{}]
        self._known = {(True, ()): 0}
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]  # states that may still change, along the last string
        last = ""
        for text in strings:
            shared = 0
            while shared < len(last) and shared < len(text) and last[shared] == text[shared]:
                shared += 1
            self._close(path, last, shared)
            path += [(False, {}) for _ in range(len(text) - shared)]
            path[len(text)] = (True, path[len(text)][1])
            last = text
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path: list, last: str, depth: int) -> None:
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1][1][last[len(path) - 1]] = state

    def _state(self, made: tuple[bool, dict[str, int]]) -> int:
        key = (made[0], tuple(made[1].items()))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.final.append(made[0])
            self.arcs.append(made[1])
        return state


class Composition:
    """The acceptor, a transducer of one edit, and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self._common: dict[tuple[int, int], list[str]] = {}
        self._edited: dict[int, list[tuple[str, str]]] = {}

    def common(self, left: int, right: int) -> list[str]:
        """What both states accept: the transducer copies after its edit."""
        key = (left, right) if left < right else (right, left)
        found = self._common.get(key)
        if found is None:
            final, arcs = self.acceptor.final, self.acceptor.arcs
            found = [""] if final[left] and final[right] else []
            few, many = sorted((arcs[left], arcs[right]), key=len)
            for sign, state in few.items():
                if sign in many:
                    found += [sign + rest for rest in self.common(state, many[sign])]
            self._common[key] = found
        return found

    def _without(self, state: int, dropped: str, after: int) -> list[str]:
        """What ``after`` accepts and ``state`` too, not beginning with ``dropped``: that sign was deleted in between."""
        final, arcs = self.acceptor.final, self.acceptor.arcs
        found = [""] if final[state] and final[after] else []
        for sign, next_state in arcs[after].items():
            if sign != dropped and sign in arcs[state]:
                found += [sign + rest for rest in self.common(next_state, arcs[state][sign])]
        return found

    def edited(self, state: int) -> list[tuple[str, str]]:
        """Pairs that differ first at this state and by one edit; in pairs of different length the longer is first."""
        found = self._edited.get(state)
        if found is None:
            found = []
            arcs = list(self.acceptor.arcs[state].items())
            for i, (sign, after) in enumerate(arcs):
                found += [(sign + rest, rest) for rest in self._without(state, sign, after)]
                for other, other_after in arcs[i + 1 :]:
                    found += [(sign + rest, other + rest) for rest in self.common(after, other_after)]
            self._edited[state] = found
        return found

    def pairs(self, before: int) -> list[tuple[str, str]]:
        """All near pairs whose first difference stands before a place."""
        found = []
        ahead = [(self.acceptor.start, "")]
        while ahead:
            state, head = ahead.pop()
            found += [(head + left, head + right) for left, right in self.edited(state)]
            if len(head) + 1 < before:
                ahead += [(after, head + sign) for sign, after in self.acceptor.arcs[state].items()]
        return found


def near_pairs(words: list[str], begin: int, end: int, shorter: int) -> list[tuple[str, str]]:
    """Near pairs of one partition, each once, the shorter word of a pair having that length."""
    tail = max(shorter - end, 0)
    middles = {word[begin : len(word) - tail]: word for word in words}
    found = Composition(Acceptor(sorted(middles))).pairs(end - begin)
    pairs = ((middles[left], middles[right]) for left, right in found)
    return [(left, right) for left, right in pairs if min(len(left), len(right)) == shorter]


def _interval(begin: Column, end: Column) -> Column:
    return F.struct(begin.cast("int").alias("begin"), end.cast("int").alias("end"))


def _partitioned(rows: DataFrame) -> DataFrame:
    """Words of each length class and interval under the partition they belong to."""
    head = F.substring("word", F.lit(1), F.col("begin"))
    tail = F.right("word", F.greatest(F.col("shorter") - F.col("end"), F.lit(0)))
    return rows.select("word", "n", "shorter", "begin", "end", head.alias("head"), tail.alias("tail"))


def _pairs_of(groups: DataFrame) -> DataFrame:
    """Both directions of each near pair of the partitions."""

    def start():
        def apply(columns: Columns) -> Columns:
            made: Columns = {"word": [], "near": [], "near_n": []}
            for words, begin, end, shorter in zip(*(columns[name] for name in ("words", "begin", "end", "shorter"))):
                counts = {row["word"]: row["n"] for row in words}
                for left, right in near_pairs(list(counts), begin, end, shorter):
                    made["word"] += (left, right)
                    made["near"] += (right, left)
                    made["near_n"] += (counts[right], counts[left])
            return made

        return apply

    return in_batches(groups.select("words", "begin", "end", "shorter"), "word string, near string, near_n long", start)


def near_words(vocabulary: DataFrame, most: int = MOST_WORDS, widest: int = WIDEST) -> DataFrame:
    """word, near, near_n: every near word of every word, with its count. The words of ``vocabulary`` are distinct."""
    size = F.length("word")
    first = F.col("shorter") + 1
    half = F.floor(first / 2)
    rows = (
        vocabulary.select("word", "n", F.explode(F.array(size - 1, size)).alias("shorter"))
        .where("shorter >= 0")
        .select("word", "n", "shorter", F.inline(F.array(_interval(F.lit(0), half), _interval(half, first))))
        .where("begin < end")
    )
    found = []
    while True:
        rows = _partitioned(rows)
        crowded = (F.col("words") > most) | ((F.col("words") > 1) & (F.col("end") - F.col("begin") > widest))
        cut = saved(
            rows.groupBy(*PARTITION)
            .agg(F.count(F.lit(1)).alias("words"))
            .where(crowded & (F.col("end") - F.col("begin") > 1))
            .drop("words")
        )
        groups = rows.join(cut, [*PARTITION], "left_anti").groupBy(*PARTITION)
        whole = groups.agg(F.collect_list(F.struct("word", "n")).alias("words")).where(F.size("words") > 1)
        found.append(saved(_pairs_of(whole)))
        if cut.isEmpty():
            break
        middle = F.floor((F.col("begin") + F.col("end")) / 2)
        halves = F.array(_interval(F.col("begin"), middle), _interval(middle, F.col("end")))
        rows = saved(rows.join(cut, [*PARTITION], "left_semi").select("word", "n", "shorter", F.inline(halves)))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """word and root for words that have a form; each round doubles the steps that a root is away."""
    roots = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = saved(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"))
        roots = moved.drop("further")
        if moved.where("further IS NOT NULL").isEmpty():
            return roots


def group_variants(vocabulary: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """Per word of a vocabulary (word, n): word, form, root, n, n_near and form_n."""
    words = vocabulary.where("word IS NOT NULL AND n IS NOT NULL")
    words = saved(words.groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= dominance * F.col("n")
    formed = saved(
        words.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def misspelt_vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, occurrences: int = LEAST_COUNT) -> DataFrame:
    """word and n of letter runs in lower case (A-Z only); one run of 31, by the crc32 of doc_id and run, lacks a letter.

    Only runs of at least ``least`` letters can give words of that length; null texts have none, and a null doc_id is
    written as nothing.
    """
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    seen = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    ).select("id", F.translate("run", upper, lower).alias("run"))
    hashed = seen.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)
