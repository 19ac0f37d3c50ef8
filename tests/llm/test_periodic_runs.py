import hashlib
import random
import re
import time
import zlib

import pytest

from webmart.llm import periodic_runs
from webmart.llm.queries import op13_periodic_runs


def plain_runs(words, least=6, repeats=4):
    """Runs by comparing the words with themselves at every distance."""
    n, found = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            shorter = (r for r in range(1, q) if all(words[k] == words[k + r] for k in range(i, i + size - r)))
            if size >= max(least, repeats * q) and next(shorter, None) is None:
                found.add((i, size, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = []
    for row in rows:
        words = planted(row.doc_id, row.text)
        runs = plain_runs(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((row.doc_id, len(runs), *best, milli, sha(lines), sha(kept)))
    return sorted(out, key=repr)


def random_words(draw):
    size, kinds = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 5])
    words = [draw.randint(1, kinds) for _ in range(size)]
    if size and draw.random() < 0.5:
        a, p = draw.randrange(size), draw.randint(1, 6)
        words = [words[a + (i - a) % p] if a + p <= size and i >= a else words[i] for i in range(size)]
    return words


@pytest.mark.parametrize(("least", "repeats"), [(6, 4), (4, 2), (2, 2), (9, 3)])
def test_runs_equal_plain_search(least, repeats):
    draw = random.Random(5)
    texts = [random_words(draw) for _ in range(1500)]
    for words in texts:
        assert periodic_runs.runs_of(words, least, repeats) == plain_runs(words, least, repeats), words
    together = periodic_runs.find_in([[str(word) for word in words] for words in texts], least, repeats)
    assert together == [plain_runs(words, least, repeats) for words in texts]


def test_extension_queries():
    draw = random.Random(7)
    numbers = [draw.randint(1, 2) for _ in range(80)]
    agree = periodic_runs.Agreement(*periodic_runs.SuffixTree(numbers).tour())
    for i in range(80):
        for j in range(80):
            if i != j:
                size = next((k for k in range(80 - max(i, j)) if numbers[i + k] != numbers[j + k]), 80 - max(i, j))
                assert agree(periodic_runs.np.array([i]), periodic_runs.np.array([j]))[0] == size


def test_tours_list_suffixes_in_order():
    draw = random.Random(9)
    numbers = [draw.randint(1, 3) for _ in range(60)]
    tree = periodic_runs.SuffixTree(numbers)
    assert tree.tour()[0] == sorted(range(61), key=lambda i: [*numbers[i:], 0])
    assert tree.tour(reverse=True)[0] == sorted(range(61), key=lambda i: [*(-n for n in numbers[i:]), -9])


def test_long_texts_take_proportional_time():
    began = time.time()
    assert periodic_runs.find_in([["la"] * 100_000]) == [[(0, 100_000, 1)]]
    words = [str(i % 40_000) for i in range(200_000)]
    assert periodic_runs.find_in([words]) == [[(0, 200_000, 40_000)]]
    assert time.time() - began < 60


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_odd_rows(request, name):
    docs = request.getfixturevalue(name)
    small = docs.where("text IS NULL OR length(text) < 1000")
    found = periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_planted_periods(small)))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(small.select("doc_id", "text").collect())


def test_a_phrase_repeated_throughout(odd):
    found = periodic_runs.find_runs(odd.where("doc_id = 5")).collect()
    assert [tuple(run) for run in found[0].runs] == [(0, 36000, 12)]
    assert found[0].collapsed == "the quick brown fox jumps over the lazy dog and runs away"


def test_query_equals_plain_search(spark, small):
    found = op13_periodic_runs(spark, small)
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert found.columns == names
    assert {kind for name, kind in found.dtypes if name not in names[-2:]} == {"bigint"}
    rows = [row for row in spark.read.parquet(f"{small}/documents.parquet").collect() if len(row.text or "") < 30_000]
    kept = {row.doc_id for row in rows}
    assert sorted((tuple(row) for row in found.collect() if row.doc_id in kept), key=repr) == expected(rows)


def test_periods_are_planted_as_stated(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {row.doc_id: row.text for row in periodic_runs.with_planted_periods(docs).collect()}
    for row in docs.collect():
        assert re.findall(r"[^\x20\x09-\x0D]+", found[row.doc_id] or "") == planted(row.doc_id, row.text)


def test_texts_without_words_under_any_id(spark):
    rows = [(n, text) for n in range(-60, 60) for text in ("", None, " \t\n", "one", "one two  one two one two one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_planted_periods(docs)))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(docs.collect())
    assert any(zlib.crc32(str(n).encode()) % 10 == 0 for n in range(-60, 60))
