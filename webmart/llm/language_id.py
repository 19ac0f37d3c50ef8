"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text recognises exactly the substrings of that text. A text is parsed
against it greedily: each phrase is the longest match from where the last one ended, or one unknown character, which
counts twice: as a phrase and for saying which character it is. A text in the language needs few long phrases; the
language with the fewest phrases, each weighed by the logarithm of its sample's length, wins. Texts are read as letters (case folded by the alphabet) with one space for all between; every letter of the
samples is a symbol of its own. Transitions of the commonest letters lie in an array, those of all others in a sorted list.

Blocks of ``BLOCK`` characters of all texts of a batch advance together, one character at a time, as if each began a
text. Then every block is begun again in the state that the block before it ended in, beside its first parse, until both
are in the same state, from where they agree; the phrases are corrected by the difference. A text in which two parses
of a block never meet is parsed in one piece. So the phrases are those of the unbroken text.

Learning takes at most ``SAMPLE_DOCS`` documents and ``SAMPLE_CHARS`` characters per language, those of the lowest hashed
ids: a bounded sample however large the table. Prediction reads whole texts and uses nothing but the text.

``und`` with score 0 if the text is null or has no letter, or if no labelled text exists; with one learned language that
one with score 1. Otherwise the score is the runner-up's entropy over the sum of the best two, from 0.5 to 1. Ties go to
the language first in order. Repeated rows repeat their result; rows without doc_id are predicted but never learned from.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from webmart.llm.common import Columns, crc_fold, held_out, in_batches, kept

SAMPLE_DOCS = 60
SAMPLE_CHARS = 40_000
BLOCK = 2048
#: Blocks that advance together.
TOGETHER = 2048
#: Letters whose transitions lie in the array.
LETTERS = 120
UNDECIDED = "und"
Samples = tuple[tuple[str, str], ...]

_SPACE, _END, _OTHER, _FIRST = 0, 1, 2, 3


def learn(docs: DataFrame) -> Samples:
    """(language, sample text) of labelled documents outside the held-out fold."""
    labelled = docs.where(F.col("lang").isNotNull() & (crc_fold() != 2))
    share = SAMPLE_CHARS // SAMPLE_DOCS
    middle = F.greatest(F.lit(1), ((F.length("text") - share) / 2).cast("int"))
    part = F.expr("text").substr(middle, F.lit(share)).alias("part")
    by_id = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    by_text = Window.partitionBy("lang", "doc_id").orderBy(F.xxhash64("text"))
    # limited before the shuffle; an id that repeats counts once, with the text whose hash is lowest
    ids = labelled.select("doc_id", "lang").distinct().withColumn("rank", F.row_number().over(by_id))
    chosen = F.broadcast(ids.where(F.col("rank") <= SAMPLE_DOCS).select("doc_id", "lang"))
    texts = labelled.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    rows = texts.withColumn("rank", F.row_number().over(by_text)).where("rank = 1").select("lang", part).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda row: (row.lang, row.part or "")):
        if row.part and any(c.isalpha() for c in row.part):
            samples.setdefault(row.lang, []).append(row.part)
    return tuple((lang, "\n".join(parts)) for lang, parts in sorted(samples.items()))


def _alphabet(samples: Samples) -> np.ndarray:
    """The class of every code point: the commonest letters of the samples have the lowest."""
    counts = Counter(c.lower() for _, text in samples for c in text if c.isalpha())
    own = {letter: _FIRST + place for place, letter in enumerate(sorted(counts, key=lambda c: (-counts[c], c)))}
    table = np.zeros(0x110000, dtype=np.uint16 if _FIRST + len(own) < 1 << 16 else np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            table[code] = own.get(letter.lower(), _OTHER)
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


def _one_space(classes: np.ndarray) -> np.ndarray:
    """Mask that keeps letters and the first of each run of spaces."""
    keep = np.ones(len(classes), dtype=bool)
    keep[1:] = (classes[1:] != _SPACE) | (classes[:-1] != _SPACE)
    return keep


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the least automaton, root first, that recognises all substrings."""
    moves: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                clone = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = clone
                    at = link[at]
                link[target] = link[state] = clone
        last = state
    return moves


class CrossParser:
    """Counts the phrases of texts against the samples of all languages at once."""

    def __init__(self, samples: Samples):
        self.languages = [lang for lang, _ in samples]
        self.table = _alphabet(samples)
        self.total = max(int(self.table.max()), _OTHER) + 1
        self.width = min(self.total, _FIRST + LETTERS)
        tables, roots, self.weight, keys, values, rare_roots = [], [], [], [], [], []
        begin = 0
        for _, text in samples:
            classes = self.table[_codes(text)]
            classes = classes[_one_space(classes)]
            self.weight.append(math.log2(len(classes) + 1))
            moves = suffix_automaton(classes.tolist())
            table, rare, rare_root = self._transitions(moves, begin)
            roots.append(begin * 2 * self.width)
            begin += len(moves)
            tables.append(table)
            keys += [key for key, _ in rare]
            values += [value for _, value in rare]
            rare_roots.append(rare_root)
        self.moves = np.concatenate(tables) if tables else np.zeros(0, dtype=np.int64)
        self.roots = np.array(roots, dtype=np.int64)
        self.unknown = np.ones((len(samples), self.total), dtype=bool)
        for row, (_, text) in enumerate(samples):
            self.unknown[row, self.table[_codes(text)]] = False
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.rare_keys = np.array(keys, dtype=np.int64)[order]
        self.rare_moves = np.array(values, dtype=np.int64)[order]
        self.rare_roots = np.array(rare_roots, dtype=np.int64)

    def _transitions(self, moves: list[dict[int, int]], begin: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
        """The array of the common letters, (key, move) of the rare ones, and where each rare letter leads from the root.

        A move is the next row times twice the width, plus 1 where a phrase ends before the character; END changes nothing.
        Where a state has no transition the phrase ends, and the next one starts at the root with this character. An
        unknown character is a phrase of its own, after which, as at the start of a text, any character starts a phrase.
        """
        width = self.width
        root = np.full(width, begin * 2 * width + 1, dtype=np.int64)
        rare_root = np.full(self.total - width, begin * 2 * width + 1, dtype=np.int64)
        for symbol, state in moves[0].items():
            if symbol < width:
                root[symbol] = (begin + state) * 2 * width + 1
            else:
                rare_root[symbol - width] = (begin + state) * 2 * width + 1
        table = np.tile(root, (len(moves), 1))
        rare = []
        for row, found in enumerate(moves):
            for symbol, state in found.items():
                if symbol < width:
                    table[row, symbol] = (begin + state) * 2 * width
                elif row:
                    rare.append(((begin + row) * self.total + symbol, (begin + state) * 2 * width))
        table[0] = root
        table[:, _END] = (begin + np.arange(len(moves))) * 2 * width
        return table.astype(np.int32 if table.max() < 2**31 else np.int64).ravel(), rare, rare_root

    def _step(self, state: np.ndarray, symbols: np.ndarray, rare: bool) -> np.ndarray:
        """Where states, one row per language, get by the symbol of each column; odd where a phrase ended before it."""
        if not rare:
            return self.moves[(state >> 1) + symbols]
        found = self.moves[(state >> 1) + np.where(symbols < self.width, symbols, _SPACE)]
        columns = np.flatnonzero(symbols >= self.width)
        symbol = symbols[columns].astype(np.int64)
        keys = (state[:, columns] // (2 * self.width)).astype(np.int64) * self.total + symbol
        at = np.minimum(np.searchsorted(self.rare_keys, keys), max(len(self.rare_keys) - 1, 0))
        known = self.rare_keys[at] == keys if len(self.rare_keys) else np.zeros(keys.shape, dtype=bool)
        moved = self.rare_moves[at] if len(self.rare_keys) else keys
        found[:, columns] = np.where(known, moved, self.rare_roots[:, symbol - self.width])
        return found

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases per language and text; characters and letters per text; unknown letters per language and text."""
        codes = [_codes(text or "") for text in texts]
        sizes = np.array([len(code) for code in codes])
        classes = self.table[np.concatenate(codes)] if sizes.sum() else self.table[:0]
        owner = np.repeat(np.arange(len(texts)), sizes)
        keep = _one_space(classes)
        if len(owner):
            keep[np.flatnonzero(np.diff(owner)) + 1] = True
        classes, owner = classes[keep], owner[keep]
        sizes = np.bincount(owner, minlength=len(texts))
        letters = np.bincount(owner, weights=classes != _SPACE, minlength=len(texts)).astype(np.int64)
        counts = np.zeros((len(self.languages), len(texts)), dtype=np.int64)
        strange = np.zeros_like(counts)
        for row, unknown in enumerate(self.unknown):
            places = np.flatnonzero(unknown[classes] & (classes != _SPACE))
            strange[row] = np.bincount(owner[places], minlength=len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        begins = np.concatenate([np.arange(starts[k], starts[k + 1], BLOCK) for k in range(len(texts))] or [[]]).astype(int)
        if not len(begins):
            return counts, sizes, letters, strange
        owners = owner[begins]
        lengths = np.minimum(begins + BLOCK, starts[owners + 1]) - begins
        ended = np.zeros((len(self.languages), len(begins)), dtype=np.int64)
        last = np.zeros_like(ended)
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), TOGETHER):
            chosen = order[at : at + TOGETHER]
            ended[:, chosen], last[:, chosen] = self._parse(classes, begins[chosen], lengths[chosen])
        goes_on = np.append(owners[1:] == owners[:-1], False)
        later = np.flatnonzero(goes_on) + 1
        apart: list[int] = []
        for at in range(0, len(later), TOGETHER):
            chosen = later[at : at + TOGETHER]
            more, met = self._carry(classes, begins[chosen], lengths[chosen], last[:, chosen - 1])
            ended[:, chosen] += more
            apart += owners[chosen[~met & goes_on[chosen]]].tolist()
        for row in range(len(counts)):
            counts[row] = np.bincount(owners, weights=ended[row], minlength=counts.shape[1]).astype(np.int64)
        for text in sorted(set(apart)):
            whole, _ = self._parse(classes, starts[text : text + 1], sizes[text : text + 1])
            counts[:, text] = whole[:, 0]
        return counts, sizes, letters, strange

    def _grid(self, classes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One column of symbols per block, END below, and which rows hold rare letters."""
        grid = np.full((int(sizes.max()), len(begins)), _END, dtype=classes.dtype)
        for column, (begin, size) in enumerate(zip(begins, sizes)):
            grid[:size, column] = classes[begin : begin + size]
        rare = (grid >= self.width).any(axis=1) if self.total > self.width else np.zeros(len(grid), dtype=bool)
        return grid, rare

    def _parse(self, classes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and last states of blocks, longest first, each parsed from its start."""
        grid, rare = self._grid(classes, begins, sizes)
        active = np.searchsorted(-sizes, -np.arange(1, len(grid) + 1), side="right")
        state = np.repeat(self.roots[:, None], len(begins), axis=1).astype(self.moves.dtype)
        ended = np.zeros_like(state)
        for step in range(len(grid)):
            live = int(active[step])
            found = self._step(state[:, :live], grid[step, :live], bool(rare[step]))
            ended[:, :live] += found & 1
            state[:, :live] = found & ~1
        return ended, state

    def _carry(self, classes, begins, sizes, carried) -> tuple[np.ndarray, np.ndarray]:
        """How many phrases blocks have more (or fewer) when they begin in the carried states, and which blocks' two parses met."""
        grid, rare = self._grid(classes, begins, np.minimum(sizes, BLOCK))
        more = np.zeros(carried.shape, dtype=np.int64)
        met = np.zeros(len(begins), dtype=bool)
        columns = np.arange(len(begins))
        true = carried.astype(self.moves.dtype)
        first = np.repeat(self.roots[:, None], len(begins), axis=1).astype(self.moves.dtype)
        for step in range(len(grid)):
            symbols, some = grid[step, columns], bool(rare[step])
            next_true, next_first = self._step(true, symbols, some), self._step(first, symbols, some)
            more[:, columns] += (next_true & 1) - (next_first & 1)
            true, first = next_true & ~1, next_first & ~1
            same = (true == first).all(axis=0)
            if same.any():
                met[columns[same]] = True
                columns, true, first = columns[~same], true[:, ~same], first[:, ~same]
                if not len(columns):
                    break
        return more, met

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNDECIDED] * len(texts), [0.0] * len(texts)
        counts, sizes, letters, strange = self.phrases(texts)
        entropy = (counts + strange) * np.array(self.weight)[:, None] / np.maximum(sizes, 1)
        order = np.argsort(entropy, axis=0, kind="stable")
        best = entropy[order[0], np.arange(len(texts))]
        second = entropy[order[1], np.arange(len(texts))] if len(order) > 1 else np.full(len(texts), np.inf)
        score = np.where(np.isinf(second), 1.0, second / np.maximum(best + second, 1e-12))
        known = letters > 0
        names = [self.languages[i] if ok else UNDECIDED for i, ok in zip(order[0], known)]
        return names, np.where(known, score, 0.0).tolist()


def parser(samples: Samples) -> CrossParser:
    """The automata of samples, kept in a Python worker between tasks."""
    return kept(("language", samples), lambda: CrossParser(samples))


def identify(docs: DataFrame, samples: Samples) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""

    def start():
        model = parser(samples)

        def apply(columns: Columns) -> Columns:
            names, scores = model.predict(columns["text"])
            return {"doc_id": columns["doc_id"], "held_out": columns["held"], "lang_pred": names, "score": scores}

        return apply

    rows = docs.select("doc_id", "text", held_out().alias("held"))
    return in_batches(rows, "doc_id long, held_out boolean, lang_pred string, score double", start)
