import math
import tracemalloc
import zlib

import numpy as np
import pytest

from webmart.llm import toxicity as T
from webmart.llm.queries import op3_toxicity


def test_gradients_agree_with_differences():
    weights = T.new_weights(3)
    words, grams = T.features(["aa", "bcd", "loser", "xyz", "hello", "q"])
    windows = np.array([[0, 1, 2, 3, -1], [4, 5, -1, -1, -1], [2, 2, 2, 1, 0]])
    labels = np.array([1, 0, 1], np.float32)
    _, grads = T.gradients(weights, words, grams, windows, labels)
    draw = np.random.default_rng(0)
    places = [(name, tuple(draw.integers(0, n) for n in weights[name].shape)) for name in weights for _ in range(4)]
    places += [("word", (words[2], 3)), ("char", (grams[2][0], 2))]
    for name, place in places:
        kept, values = weights[name][place], []
        for step in (1e-2, -1e-2):
            weights[name][place] = kept + step
            values.append(T.gradients(weights, words, grams, windows, labels)[0])
        weights[name][place] = kept
        assert abs((values[0] - values[1]) / 2e-2 - grads[name][place]) < 2e-4


def test_windows_overlap_and_cover():
    for size in (0, 1, T.STEP, T.WINDOW - 1, T.WINDOW, T.WINDOW + 1, 100, 1001):
        places = T.window_places(size)
        assert sorted(set(places[places >= 0].tolist())) == list(range(size))
        assert len(places) <= max(1, size // T.STEP)


def test_scores_do_not_depend_on_company():
    weights = T.new_weights(1)
    texts = ["one two three " * k for k in range(30)] + [None, "", "***"]
    together = T.Scorer(weights).scores(texts)
    alone = [T.Scorer(weights).scores([text])[0] for text in texts]
    assert np.allclose(together, alone, atol=1e-5) and together[-3:] == [0.0, 0.0, 0.0]


def test_words_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(T, "KEPT_WORDS", 10)
    monkeypatch.setattr(T, "TOGETHER", 50)
    texts = [f"word{'abcdefgh'[k % 8]}{'xyz'[k % 3]} other text of some words " * 9 for k in range(40)]
    scorer = T.Scorer(T.new_weights(1))
    assert np.allclose(scorer.scores(texts), [T.Scorer(T.new_weights(1)).scores([t])[0] for t in texts], atol=1e-5)
    assert scorer.filled <= 30


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return T.learn(docs, labels)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {row.doc_id: row for row in op3_toxicity(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [row for row in labels if zlib.crc32(str(row.doc_id).encode()) % 4 == 2]
    assert all(found[row.doc_id].held_out for row in held)
    toxic = [found[row.doc_id].score for row in held if row.toxic]
    clean = [found[row.doc_id].score for row in held if not row.toxic]
    auc = np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic])
    assert auc > 0.95
    assert all(row.predicted == (row.score >= 0.3) for row in found.values())


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_odd_rows(request, trained, name):
    docs = request.getfixturevalue(name)
    found = T.score(docs, trained).collect()
    assert len(found) == docs.count()
    assert all(0 <= row.score <= 1 for row in found)
    assert all(row.score == 0 for row in T.score(docs, None).collect())
    kept = T.drop_toxic(docs, trained)
    assert kept.columns == docs.columns
    assert kept.count() == sum(row.score < T.THRESHOLD for row in found)


def test_learning_needs_both_classes(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 1), (None, 0), (5, None)], "doc_id long, toxic int")
    assert T.learn(odd, labels) is None
    assert T.learn(none, labels) is None
    assert T.learn(odd, labels.limit(0)) is None


def plain_score(weights, text):
    """The highest window's probability, word by word and unit by unit."""

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def times(row, table):
        return [sum(float(a) * float(table[i][j]) for i, a in enumerate(row)) for j in range(len(table[0]))]

    words, best = T.words_of(text), 0.0
    for places in T.window_places(len(words)):
        inputs = []
        for word in (words[place] for place in places if place >= 0):
            own, grams = T.features([word])
            grams = [gram for gram in grams[0] if gram >= 0]
            means = [sum(float(weights["char"][gram][k]) for gram in grams) / len(grams) for k in range(T.EMBEDDING)]
            inputs.append([float(weights["word"][own[0]][k]) + means[k] for k in range(T.EMBEDDING)])
        sides = []
        for d, row in enumerate((inputs, inputs[::-1])):
            state, states = [0.0] * T.HIDDEN, []
            for x in row:
                given = [a + float(b) for a, b in zip(times(x, weights["into"][d]), weights["bias"][d][0])]
                back = times(state, weights["back"][d])
                size = T.HIDDEN
                keep = [sigmoid(given[k] + back[k]) for k in range(size)]
                reset = [sigmoid(given[size + k] + back[size + k]) for k in range(size)]
                new = [math.tanh(given[2 * size + k] + reset[k] * back[2 * size + k]) for k in range(size)]
                state = [keep[k] * state[k] + (1 - keep[k]) * new[k] for k in range(size)]
                states.append(state)
            sides.append(states if d == 0 else states[::-1])
        states = [a + b for a, b in zip(*sides)]
        drawn = [sum(math.tanh(v) * float(p) for v, p in zip(times(s, weights["look"]), weights["pick"])) for s in states]
        shares = [math.exp(value) for value in drawn]
        pooled = [sum(share * s[k] for share, s in zip(shares, states)) / sum(shares) for k in range(2 * T.HIDDEN)]
        best = max(best, sigmoid(sum(a * float(b) for a, b in zip(pooled, weights["out"])) + float(weights["base"][0])))
    return best


def test_scores_equal_a_plain_pass():
    weights = T.new_weights(4)
    texts = ["one two three " * 3, "A single window, of several words.", "x", " ".join(f"word{chr(97 + k % 26)}" for k in range(61)), "", "é" * 40]
    assert np.allclose(T.Scorer(weights).scores(texts), [plain_score(weights, text) for text in texts], atol=1e-5)


def test_every_letter_of_a_long_run_is_read():
    assert T.words_of("a" * 40 + " b") == ["a" * 16, "a" * 16, "a" * 8, "b"]
    weights = T.new_weights(2)
    base = "abcdefgh" * 5
    scores = T.Scorer(weights).scores([base] + [base[:k] + "z" + base[k + 1 :] for k in range(40)])
    assert len(set(scores)) == 41


def test_learning_reads_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(T, "SAMPLE_TOXIC", 3)
    monkeypatch.setattr(T, "SAMPLE_CLEAN", 4)
    monkeypatch.setattr(T, "SAMPLE_CHARS", 100)
    seen = []
    monkeypatch.setattr(T, "train", lambda texts, labels: seen.append((texts, labels)))
    rows = [(n, f"text {n}" + " long" * (30 if n % 10 == 0 else 0)) for n in range(200)] + [(n, "another") for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id long, toxic int")
    T.learn(docs, labels)
    T.learn(docs.repartition(3), labels.repartition(5))
    assert seen[0] == seen[1] and sorted(seen[0][1]) == [0] * 4 + [1] * 3
    assert max(map(len, seen[0][0])) <= 100


def test_features_of_many_words_are_those_of_each():
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopq'[k % 7]}" * (1 + k % 4) for k in range(50)]
    for one, other in zip(T._all_features(words, 7), T.features(words)):
        assert (one == other).all() and one.dtype == other.dtype


def test_training_scores_beside_one_table_of_inputs():
    draw = np.random.default_rng(0)
    many = 200_000
    words = draw.integers(0, T.WORD_ROWS, many).astype(np.int32)
    grams = draw.integers(0, T.CHAR_ROWS, (many, 12)).astype(np.int32)
    windows = draw.integers(0, many, (5, T.WINDOW))
    windows[0, 7:] = -1
    weights = T.new_weights(1)
    tracemalloc.start()
    logits = T._all_logits(weights, words, grams, windows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * (2 * many * 3 * T.HIDDEN * 4)
    used = np.unique(windows[windows >= 0])
    local = np.where(windows >= 0, np.searchsorted(used, windows), -1)
    assert np.allclose(logits, T._all_logits(weights, words[used], grams[used], local), atol=1e-5)
