import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webmart.llm import spelling
from webmart.llm.queries import op11_spelling


def is_near(left, right):
    """One insertion, deletion or replacement, by trying every place."""
    short, long = sorted((left, right), key=len)
    if len(short) == len(long):
        return sum(a != b for a, b in zip(short, long)) == 1
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_pairs(words):
    """Near pairs by comparing all words whose lengths allow it."""
    by_size = {}
    for word in words:
        by_size.setdefault(len(word), []).append(word)
    for size, same in by_size.items():
        yield from (pair for pair in itertools.combinations(same, 2) if is_near(*pair))
        yield from (pair for pair in itertools.product(same, by_size.get(size + 1, ())) if is_near(*pair))


def plain_variants(counts, dominance=10):
    near = {word: set() for word in counts}
    for left, right in plain_pairs(counts):
        near[left].add(right)
        near[right].add(left)
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best is not None and counts[best] >= dominance * counts[word] else None
    out = []
    for word, form in forms.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        out.append((word, form, root, counts[word], len(near[word]), counts[form] if form else None))
    return sorted(out)


def plain_vocabulary(rows):
    """By one pass over all letter runs."""
    counts = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def test_composition_equals_all_pairs():
    draw = random.Random(2)
    for turn in range(2000):
        signs = "ab" if turn % 2 else "abcé"
        words = sorted({"".join(draw.choices(signs, k=draw.randint(0, 6))) for _ in range(draw.randint(1, 25))})
        found = spelling.Composition(spelling.Acceptor(words)).pairs(99)
        wanted = {frozenset(pair) for pair in itertools.combinations(words, 2) if is_near(*pair)}
        assert len(found) == len(wanted) and {frozenset(pair) for pair in found} == wanted


def test_acceptor_is_minimal_and_accepts_its_words_only():
    draw = random.Random(4)
    words = sorted({"".join(draw.choices("abc", k=draw.randint(0, 7))) for _ in range(300)})
    acceptor = spelling.Acceptor(words)

    def language(state):
        own = [""] if acceptor.final[state] else []
        return own + [sign + rest for sign, after in acceptor.arcs[state].items() for rest in language(after)]

    assert sorted(language(acceptor.start)) == words
    languages = [tuple(sorted(language(state))) for state in range(1, len(acceptor.arcs))]
    assert len(set(languages)) == len(languages)


@pytest.mark.parametrize(("most", "widest"), [(2000, 32), (3, 32), (1, 1), (2000, 2)])
def test_any_partitioning_gives_all_near_words(spark, most, widest):
    draw = random.Random(6)
    words = sorted({"".join(draw.choices("abç", k=draw.randint(0, 7))) for _ in range(250)} | {"", "é"})
    vocabulary = spark.createDataFrame([(word, 1 + len(word)) for word in words], "word string, n long")
    found = [tuple(row)[:2] for row in spelling.near_words(vocabulary, most, widest).collect()]
    wanted = {(a, b) for pair in plain_pairs(words) for a, b in (pair, pair[::-1])}
    assert len(found) == len(wanted) and set(found) == wanted


def test_long_words_and_chains_of_forms(spark):
    long = "x" * 5000
    counts = {"wordaaa": 1000, "wordaab": 100, "wordabb": 10, "wordbbb": 1, "alone": 5}
    counts |= {long: 50, long + "x": 3, long[:2500] + "y" + long[2501:]: 1}
    vocabulary = spark.createDataFrame([*counts.items(), ("alone", 2), (None, 3), ("empty", None)], "word string, n long")
    counts["alone"] = 7
    found = [tuple(row) for row in spelling.group_variants(vocabulary).collect()]
    assert sorted(found) == plain_variants(counts)
    assert dict((row[0], row[2]) for row in found)["wordbbb"] == "wordaaa"


def test_query_equals_all_pairs(spark, small):
    found = op11_spelling(spark, small)
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    counts = plain_vocabulary(spark.read.parquet(f"{small}/documents.parquet").collect())
    assert sorted(map(tuple, found.collect())) == plain_variants(counts)


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_odd_rows(request, name):
    docs = request.getfixturevalue(name)
    found = spelling.group_variants(spelling.misspelt_vocabulary(docs, least=3, occurrences=1))
    rows = docs.select("doc_id", "text").collect()
    counts = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]{3,}", row.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    assert sorted(map(tuple, found.collect())) == plain_variants({w: n for w, n in counts.items() if len(w) >= 3})


def test_other_columns_of_a_vocabulary_are_ignored(spark):
    names = "near near_n shorter begin end head tail words best less further root form n_near form_n".split()
    vocabulary = spark.createDataFrame([("colour", 40), ("color", 3)], "word string, n long")
    clashing = vocabulary.select("*", *[F.lit(1).alias(name) for name in names])
    assert sorted(map(tuple, spelling.group_variants(clashing).collect())) == plain_variants({"colour": 40, "color": 3})
