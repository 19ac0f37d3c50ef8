"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read as words of letters, runs of over ``WORD_CHARS`` letters as pieces of that many in turn. Each word's input is a word embedding (hashed) plus the mean of embeddings of its
character n-grams, word ends marked. Windows of ``WINDOW`` words, each starting ``STEP`` words after the last, cover the
whole text; a gated recurrent layer runs over a window in both directions, attention pools the states and a logistic
unit scores the window. A document's score is that of its highest window.

Labels belong to documents, so training alternates between scoring the windows of the sample and fitting the network to
the highest windows of either class and some others of clean documents. It learns from at most ``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` labelled documents outside the held-out fold, those of the lowest hashed ids among texts of at most
``SAMPLE_CHARS`` characters, and from at most ``SAMPLE_WINDOWS`` windows of each, ``FIRST_WINDOWS`` toxic ones in the first turn: a
bounded sample however large the table and its texts. Scoring covers every window of every text and
uses nothing but the text; its memory is bounded by a few texts and a store of words.

Null and empty texts, and texts without letters, have score 0. Without labels of both classes every score is 0. A
document that is labelled twice is toxic if one label says so. Repeated rows repeat their result; rows without doc_id are
scored but never learned from. The columns of documents pass through :func:`drop_toxic` unchanged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmart.llm.common import Columns, crc_fold, held_out, in_batches, kept, saved

SAMPLE_TOXIC = 1200
SAMPLE_CLEAN = 2000
SAMPLE_CHARS = 30_000
SAMPLE_WINDOWS = 60
FIRST_WINDOWS = 20_000
WINDOW, STEP = 24, 12
THRESHOLD = 0.3
WORD_ROWS = CHAR_ROWS = 1 << 14
EMBEDDING, HIDDEN, ATTENTION = 16, 8, 8
#: Letters of a word at most, longer runs give several; n-grams of these sizes.
WORD_CHARS, GRAMS = 16, (2, 3, 4)
#: Words whose inputs a Python worker keeps.
KEPT_WORDS = 150_000
#: Words whose windows are scored together.
TOGETHER = 100_000
ROUNDS, EPOCHS, BATCH, RATE = 3, 2, 256, 0.01
#: Steps of each round at least; small samples are read more often.
LEAST_STEPS = 40
#: Words and n-grams of fewer sample documents say nothing of others; their embeddings stay zero.
LEAST_DOCS = 3
_WORD = re.compile(rf"[^\W\d_]{{1,{WORD_CHARS}}}")
Weights = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _mix(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return values ^ (values >> np.uint64(29))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row of the word table for each word, and rows of the character table, -1 where a word has fewer n-grams."""
    width = WORD_CHARS + 2
    padded = "".join(f"\x02{word}\x03".ljust(width, "\0") for word in words)
    codes = np.frombuffer(padded.encode("utf-32-le", "replace"), dtype="<u4").reshape(-1, width).astype(np.uint64)
    sizes = np.count_nonzero(codes, axis=1)
    powers = np.uint64(0x100000001B3) ** np.arange(width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        whole = _mix((codes * powers).sum(axis=1, dtype=np.uint64))
        grams = []
        for size in GRAMS:
            value = np.zeros((len(words), width - size + 1), dtype=np.uint64)
            for k in range(size):
                value = value * np.uint64(0x100000001B3) + codes[:, k : width - size + 1 + k]
            rows = (_mix(value + np.uint64(size)) % np.uint64(CHAR_ROWS)).astype(np.int32)
            rows[np.arange(width - size + 1) > (sizes - size)[:, None]] = -1
            grams.append(rows)
    return (whole % np.uint64(WORD_ROWS)).astype(np.int32), np.concatenate(grams, axis=1)


def _all_features(words: list[str], rows: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The features of many words, so many at once."""
    word_rows = np.empty(len(words), np.int32)
    char_rows = np.empty((len(words), sum(WORD_CHARS + 3 - size for size in GRAMS)), np.int32)
    for begin in range(0, len(words), rows):
        word_rows[begin : begin + rows], char_rows[begin : begin + rows] = features(words[begin : begin + rows])
    return word_rows, char_rows


def _in_few(rows_of: np.ndarray, documents: list[np.ndarray], size: int) -> np.ndarray:
    """Which rows of a table of this size occur in fewer than ``LEAST_DOCS`` documents, given as words' places."""
    met = np.zeros(size, dtype=np.int32)
    for places in documents:
        rows = np.unique(rows_of[places])
        met[rows[rows >= 0]] += 1
    return met < LEAST_DOCS


def new_weights(seed: int = 7) -> Weights:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return draw.normal(0, scale, shape).astype(np.float32)

    return {
        "word": normal(WORD_ROWS, EMBEDDING, scale=0.1),
        "char": normal(CHAR_ROWS, EMBEDDING, scale=0.3),
        "into": normal(2, EMBEDDING, 3 * HIDDEN, scale=0.3),
        "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "back": normal(2, HIDDEN, 3 * HIDDEN, scale=0.3),
        "look": normal(2 * HIDDEN, ATTENTION, scale=0.3),
        "pick": normal(ATTENTION, scale=0.3),
        "out": normal(2 * HIDDEN, scale=0.3),
        "base": np.zeros(1, np.float32),
    }


def _embed(weights: Weights, word_rows: np.ndarray, char_rows: np.ndarray) -> np.ndarray:
    """One input vector for each word."""
    means = np.empty((len(word_rows), EMBEDDING), np.float32)
    for begin in range(0, len(word_rows), 8192):  # bounds the rows gathered at once
        part = char_rows[begin : begin + 8192]
        some = part >= 0
        many = some.sum(axis=1)  # every word has an n-gram
        starts = np.concatenate([[0], np.cumsum(many)[:-1]])
        sums = np.add.reduceat(weights["char"][part[some]], starts, axis=0)
        means[begin : begin + 8192] = sums / many[:, None].astype(np.float32)
    return weights["word"][word_rows] + means


def _gates(given: np.ndarray, state: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, ...]:
    """Update gate, reset gate, candidate and recurrent part of the candidate, for both directions."""
    recur = state @ back
    gates = given[..., : 2 * HIDDEN] + recur[..., : 2 * HIDDEN]
    gates *= np.float32(0.5)
    np.tanh(gates, out=gates)
    gates *= np.float32(0.5)
    gates += np.float32(0.5)
    keep, reset = gates[..., :HIDDEN], gates[..., HIDDEN:]
    recurrent = recur[..., 2 * HIDDEN :]
    return keep, reset, np.tanh(given[..., 2 * HIDDEN :] + reset * recurrent), recurrent


def _run(weights: Weights, given: np.ndarray, mask: np.ndarray | None, trace: bool = False):
    """Scores (logits) of windows; given: (direction, step, window, 3 hidden), mask: (place, window).

    The second direction's steps run from the last place to the first. Where the mask is 0 the state passes unchanged;
    None means that all places hold words.
    """
    _, places, windows, _ = given.shape
    state = np.zeros((2, windows, HIDDEN), np.float32)
    states = np.empty((places, windows, 2 * HIDDEN), np.float32)
    steps = []
    for t in range(places):
        u = places - 1 - t
        keep, reset, candidate, recurrent = _gates(given[:, t], state, weights["back"])
        move = 1 - keep
        if mask is not None:
            live = np.stack([mask[t], mask[u]])[:, :, None]
            move *= live
            if trace:
                steps.append((state, keep, reset, candidate, recurrent, live))
        state = state + move * (candidate - state)
        states[t, :, :HIDDEN] = state[0]
        states[u, :, HIDDEN:] = state[1]
    looked = np.tanh(states @ weights["look"])
    drawn = looked @ weights["pick"]
    if mask is not None:
        drawn = np.where(mask > 0, drawn, np.float32(-1e9))
    share = np.exp(drawn - drawn.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", share, states)
    logits = pooled @ weights["out"] + weights["base"][0]
    return (logits, (steps, states, looked, share, pooled)) if trace else logits


def gradients(weights: Weights, word_rows, char_rows, windows, labels) -> tuple[float, Weights]:
    """Mean cross entropy of windows (places of words in the feature rows, -1 beyond the end), and its gradients."""
    mask = (windows >= 0).T.astype(np.float32)
    inputs = _embed(weights, word_rows, char_rows)
    rows = np.where(windows >= 0, windows, 0).T
    seen = inputs[rows]
    given = np.stack([seen @ weights["into"][0], seen[::-1] @ weights["into"][1]]) + weights["bias"][:, :, None]
    logits, (steps, states, looked, share, pooled) = _run(weights, given, mask, trace=True)
    chance = 1 / (1 + np.exp(-logits))
    loss = float(np.mean(np.logaddexp(0, logits) - labels * logits))
    slope = ((chance - labels) / len(labels)).astype(np.float32)
    grads = {name: np.zeros_like(value) for name, value in weights.items()}
    grads["out"], grads["base"] = pooled.T @ slope, slope.sum(keepdims=True)
    to_pooled = slope[:, None] * weights["out"]
    to_share = (states * to_pooled).sum(axis=2)
    to_drawn = share * (to_share - (share * to_share).sum(axis=0))
    to_look = to_drawn[:, :, None] * weights["pick"] * (1 - looked**2)
    grads["pick"] = np.tensordot(to_drawn, looked, axes=([0, 1], [0, 1]))
    grads["look"] = np.tensordot(states, to_look, axes=([0, 1], [0, 1]))
    to_states = share[:, :, None] * to_pooled + to_look @ weights["look"].T
    to_given = np.zeros_like(given)
    carry = np.zeros((2, windows.shape[0], HIDDEN), np.float32)
    for t in reversed(range(len(mask))):
        u = len(mask) - 1 - t
        state, keep, reset, candidate, recurrent, live = steps[t]
        carry = carry + np.stack([to_states[t, :, :HIDDEN], to_states[u, :, HIDDEN:]])
        move = (1 - keep) * live
        to_candidate = carry * move * (1 - candidate**2)
        to_keep = -carry * (candidate - state) * live * keep * (1 - keep)
        to_reset = to_candidate * recurrent * reset * (1 - reset)
        pre = np.concatenate([to_keep, to_reset, to_candidate], axis=2)
        through = np.concatenate([to_keep, to_reset, to_candidate * reset], axis=2)
        to_given[:, t] = pre
        grads["back"] += np.swapaxes(state, 1, 2) @ through
        carry = carry * (1 - move) + through @ np.swapaxes(weights["back"], 1, 2)
    to_seen = np.zeros_like(seen)
    for d in (0, 1):
        read = seen if d == 0 else seen[::-1]
        grads["into"][d] = np.tensordot(read, to_given[d], axes=([0, 1], [0, 1]))
        grads["bias"][d] = to_given[d].sum(axis=(0, 1))[None, :]
        slope_of_read = to_given[d] @ weights["into"][d].T
        to_seen += slope_of_read if d == 0 else slope_of_read[::-1]
    to_inputs = np.zeros_like(inputs)
    np.add.at(to_inputs, rows.ravel(), (to_seen * mask[:, :, None]).reshape(-1, EMBEDDING))
    np.add.at(grads["word"], word_rows, to_inputs)
    some = char_rows >= 0
    each = to_inputs / some.sum(axis=1)[:, None].astype(np.float32)
    owner, _ = np.nonzero(some)
    np.add.at(grads["char"], char_rows[some], each[owner])
    return loss, grads


def window_places(size: int) -> np.ndarray:
    """Places of the words of each window of a text of so many words; -1 beyond the end."""
    if not size:
        return np.zeros((0, WINDOW), dtype=np.int64)
    starts = np.arange(0, max(size - WINDOW + STEP, 1), STEP)
    places = starts[:, None] + np.arange(WINDOW)
    return np.where(places < size, places, -1)


class Scorer:
    """Scores texts with fixed weights; inputs of words are kept between calls."""

    def __init__(self, weights: Weights):
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.given = np.zeros((2, 1024, 3 * HIDDEN), np.float32)
        self.filled = 1  # the first row stands for places beyond the end

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of the words' inputs, added where they are new."""
        found = list(map(self.places.get, words))
        if None in found:
            new = list(dict.fromkeys(word for word, place in zip(words, found) if place is None))
            end = self.filled + len(new)
            if end > self.given.shape[1]:
                grown = np.zeros((2, max(end, 2 * self.given.shape[1]), 3 * HIDDEN), np.float32)
                grown[:, : self.filled] = self.given[:, : self.filled]
                self.given = grown
            inputs = _embed(self.weights, *features(new))
            self.given[:, self.filled : end] = inputs @ self.weights["into"] + self.weights["bias"]
            self.places.update(zip(new, range(self.filled, end)))
            self.filled = end
            found = list(map(self.places.get, words))
        return np.array(found, dtype=np.int64)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Logits of windows given as rows of inputs, 0 beyond a text's end."""
        out = np.empty(len(windows), np.float32)
        whole = (windows > 0).all(axis=1)
        for kind in (True, False):
            chosen = np.flatnonzero(whole == kind)
            for begin in range(0, len(chosen), 1024):
                part = windows[chosen[begin : begin + 1024]].T
                given = np.stack([self.given[0][part], self.given[1][part[::-1]]])
                mask = None if kind else (part > 0).astype(np.float32)
                out[chosen[begin : begin + 1024]] = _run(self.weights, given, mask)
        return out

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """The highest window's probability for each text; 0 without words."""
        scores: list[float] = []
        words: list[str] = []
        sizes: list[int] = []
        for text in texts:
            found = words_of(text)
            words.extend(found)
            sizes.append(len(found))
            if len(words) >= TOGETHER:
                scores.extend(self._highest(words, sizes))
                words, sizes = [], []
        scores.extend(self._highest(words, sizes))
        return scores

    def _highest(self, words: list[str], sizes: list[int]) -> list[float]:
        rows = self._rows(words)
        windows, counts, at = [], [], 0
        for size in sizes:
            places = window_places(size)
            windows.append(np.where(places >= 0, rows[at : at + size][places], 0) if size else places)
            counts.append(len(places))
            at += size
        logits = self.logits(np.concatenate(windows)) if windows else np.zeros(0)
        if self.filled > KEPT_WORDS:
            self.clear()
        scores, at = [], 0
        for count in counts:
            best = float(logits[at : at + count].max()) if count else -np.inf
            scores.append(float(1 / (1 + np.exp(-best))))
            at += count
        return scores

class _Adam:
    def __init__(self, weights: Weights, frozen: Weights):
        self.weights, self.frozen, self.steps = weights, frozen, 0
        self.mean = {name: np.zeros_like(value) for name, value in weights.items()}
        self.square = {name: np.zeros_like(value) for name, value in weights.items()}

    def step(self, grads: Weights) -> None:
        self.steps += 1
        rate = RATE * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        for name, grad in grads.items():
            if name in self.frozen:
                grad[self.frozen[name]] = 0
            self.mean[name] += 0.1 * (grad - self.mean[name])
            self.square[name] += 0.001 * (grad * grad - self.square[name])
            self.weights[name] -= rate * self.mean[name] / (np.sqrt(self.square[name]) + 1e-8)


def train(texts: list[str], labels: list[int], seed: int = 11) -> Weights | None:
    """Weights learned from labelled texts; None without texts of both classes."""
    draw = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    kept = []
    for text, label in zip(texts, labels):
        if words := words_of(text):
            places = [vocabulary.setdefault(word, len(vocabulary)) for word in words]
            kept.append((np.array(places, dtype=np.int32), label))
    if len({label for _, label in kept}) < 2:
        return None
    word_rows, char_rows = _all_features(list(vocabulary))
    del vocabulary
    windows, owners = [], []
    for k, (rows, _) in enumerate(kept):
        places = window_places(len(rows))
        if len(places) > SAMPLE_WINDOWS:
            places = places[np.sort(draw.choice(len(places), SAMPLE_WINDOWS, replace=False))]
        windows.append(np.where(places >= 0, rows[places], -1))
        owners.append(np.full(len(places), k))
    windows, owners = np.concatenate(windows), np.concatenate(owners)
    toxic = np.array([label for _, label in kept])[owners] == 1
    weights = new_weights(seed)
    documents = [np.unique(rows) for rows, _ in kept]
    rare = {"word": _in_few(word_rows, documents, WORD_ROWS), "char": _in_few(char_rows, documents, CHAR_ROWS)}
    for name, rows in rare.items():
        weights[name][rows] = 0
    adam = _Adam(weights, rare)
    chosen = np.flatnonzero(toxic)
    chosen = draw.permutation(chosen)[:FIRST_WINDOWS]
    others = draw.permutation(np.flatnonzero(~toxic))[: len(chosen)]
    for turn in range(ROUNDS + 1):
        _fit(weights, adam, word_rows, char_rows, windows, chosen, others, draw, 1 if turn == 0 else EPOCHS)
        if turn == ROUNDS:
            break
        logits = _all_logits(weights, word_rows, char_rows, windows)
        order = np.lexsort((-logits, owners))
        first = order[np.concatenate([[True], np.diff(owners[order]) > 0])]
        chosen = first[toxic[first]]
        clean = first[~toxic[first]]
        more = draw.choice(np.flatnonzero(~toxic), min(2 * len(clean), int((~toxic).sum())), replace=False)
        others = np.concatenate([clean, more])
    return weights


def _all_logits(weights: Weights, word_rows, char_rows, windows) -> np.ndarray:
    scorer = Scorer(weights)
    scorer.given = np.zeros((2, len(word_rows) + 1, 3 * HIDDEN), np.float32)
    for begin in range(0, len(word_rows), 8192):  # bounds what stands beside the one table
        part = slice(begin, begin + 8192)
        inputs = _embed(weights, word_rows[part], char_rows[part])
        scorer.given[:, begin + 1 : begin + 1 + len(inputs)] = inputs @ weights["into"] + weights["bias"]
    return scorer.logits(windows + 1)


def _fit(weights, adam, word_rows, char_rows, windows, chosen, others, draw, epochs) -> None:
    rows = np.concatenate([chosen, others])
    labels = np.concatenate([np.ones(len(chosen)), np.zeros(len(others))]).astype(np.float32)
    for _ in range(max(epochs, math.ceil(LEAST_STEPS / math.ceil(len(rows) / BATCH)))):
        order = draw.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            batch = windows[rows[part]]
            used, places = np.unique(batch[batch >= 0], return_inverse=True)
            local = np.full(batch.shape, -1)
            local[batch >= 0] = places
            _, grads = gradients(weights, word_rows[used], char_rows[used], local, labels[part])
            adam.step(grads)


def learn(docs: DataFrame, labels: DataFrame) -> Weights | None:
    """Weights learned on the driver from the bounded sample of labelled documents."""
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_fold() != 2))
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("label"))
    known = saved(known.join(texts.select("doc_id"), "doc_id", "left_semi"))
    # each class by itself, so that every task keeps only its lowest ids; the number of rows bounds the broadcast
    sample = reduce(
        DataFrame.unionByName,
        [
            known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
            for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
        ],
    )
    found = texts.join(F.broadcast(sample), "doc_id")
    # of several texts under one id the one whose hash is lowest
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = found.groupBy("doc_id").agg(one, F.first("label").alias("label")).collect()
    rows.sort(key=lambda row: row.doc_id)
    return train([row.text for row in rows], [row.label for row in rows])


def _scorer(weights: Weights) -> Scorer:
    """The scorer of these weights, kept in a Python worker between tasks."""
    return kept(("toxicity", weights["out"].tobytes(), weights["base"].tobytes()), lambda: Scorer(weights))


def _score_all(weights: Weights | None, texts: list[str | None]) -> list[float]:
    return [0.0] * len(texts) if weights is None else _scorer(weights).scores(texts)


def score(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""

    def start():
        def apply(columns: Columns) -> Columns:
            scores = _score_all(weights, columns["text"])
            return {
                "doc_id": columns["doc_id"],
                "held_out": columns["held"],
                "score": scores,
                "predicted": [int(value >= THRESHOLD) for value in scores],
            }

        return apply

    rows = docs.select("doc_id", "text", held_out().alias("held"))
    return in_batches(rows, "doc_id long, held_out boolean, score double, predicted int", start)


def drop_toxic(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """The rows, all columns kept, that score below the threshold."""

    def start():
        def apply(columns: Columns) -> Columns:
            clean = [value < THRESHOLD for value in _score_all(weights, columns["text"])]
            return {name: [x for x, keep in zip(values, clean) if keep] for name, values in columns.items()}

        return apply

    return in_batches(docs, docs.schema, start)
