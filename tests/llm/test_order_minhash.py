import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webmart.llm import order_minhash as O
from webmart.llm.queries import op5_order_minhash


def plain_grams(text):
    """k-mers and their numbers, by counting."""
    size = min(O.GRAM, len(text))
    seen, out = Counter(), []
    for k in range(len(text) - size + 1 if text else 0):
        gram = text[k : k + size]
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def test_numbered_grams_are_equal_where_k_mers_and_numbers_are():
    draw = random.Random(8)
    texts = ["".join(draw.choices("ab", k=draw.randint(0, 300))) for _ in range(30)] + ["x" * 500, "é日😀" * 40, ""]
    hashes = {}
    for text in texts:
        plain, found = plain_grams(text), O.numbered_grams(O.codes(text)).tolist()
        assert len(plain) == len(found)
        for key, value in zip(plain, found):
            assert hashes.setdefault(key, value) == value
    assert len(set(hashes.values())) == len(hashes)


def plain_fingerprint(text):
    """Every order's least k-mers by sorting all."""
    grams = O.numbered_grams(O.codes(text)).tolist()
    out = ""
    for shift, multiply in zip(O._SHIFT.tolist(), O._MULTIPLY.tolist()):
        ranked = sorted(range(len(grams)), key=lambda k: (grams[k] ^ shift) * multiply % 2**64)
        value = O.np.zeros(1, dtype=O.np.uint64)
        for k in sorted(ranked[: O.PICKED]):
            value = O._mix(value * O._ROLL + O.np.uint64(grams[k]))
        out += f"{int(value[0]) >> 48:04x}"
    return out


def expected(rows):
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))
    out = []
    for row, following in zip(order, order[1:] + order[:1]):
        text, other = row.text or "", following.text or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + other[:third]
        prints = [O.fingerprint(t) for t in (text, changed, other)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = [O.likeness(prints[0], p) for p in prints[1:]]
        out.append((row.doc_id, len(text), digest, O.text_of(prints[0]), O.text_of(prints[1]), *near))
    return sorted(out, key=repr)


def test_fingerprints_equal_sorting():
    draw = random.Random(1)
    for size in (0, 1, 7, 8, 9, 100, 5000):
        text = "".join(draw.choices("abcde ", k=size))
        assert O.text_of(O.fingerprint(text)) == plain_fingerprint(text)


def test_order_counts():
    draw = random.Random(3)
    text = "".join(draw.choices("abcdefghij ", k=2000))
    swapped = text[1000:] + text[:1000]
    near = text[:500] + "X" + text[501:]
    assert O.likeness(O.fingerprint(text), O.fingerprint(text)) == 1
    assert O.likeness(O.fingerprint(text), O.fingerprint(near)) > 0.8
    assert O.likeness(O.fingerprint(text), O.fingerprint(swapped)) < 0.8


@pytest.mark.parametrize("name", ["documents", "odd", "none", "clashing"])
def test_pairs_equal_one_pass(request, name):
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    found = sorted((tuple(row) for row in O.edited_pairs(docs).collect()), key=repr)
    assert found == expected(rows)


def test_single_row_is_its_own_next(spark):
    (row,) = O.edited_pairs(spark.createDataFrame([(7, "abcdef" * 9)], "doc_id long, text string")).collect()
    assert row.near_next == 1.0 and row.n_chars == 54


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    assert sorted((tuple(row) for row in op5_order_minhash(spark, sf_dir).collect()), key=repr) == expected(rows)


def test_fingerprints_only(odd):
    assert all(len(row.fingerprint) == 4 * O.SKETCHES for row in O.fingerprints(odd).collect())
