import random
import zlib

import pytest

from webmart.llm import language_id as L
from webmart.llm.queries import op2_language


def plain_phrases(sample, text):
    """Greedy longest matches by search in the sample."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        count += 1
        at += size
    return count


def test_phrases_equal_plain_search():
    draw = random.Random(2)
    samples = (("x", "".join(draw.choices("abc", k=300))), ("y", "".join(draw.choices("abd", k=200))))
    model = L.CrossParser(samples)
    texts = ["".join(draw.choices("abcd", k=draw.randint(0, 400))) for _ in range(60)] + ["", None, "q", "aqqa"]
    counts, sizes, _, strange = model.phrases(texts)
    for k, text in enumerate(texts):
        assert sizes[k] == len(text or "")
        assert [sum(c not in sample for c in text or "") for _, sample in samples] == strange[:, k].tolist()
        assert [plain_phrases(sample, text or "") for _, sample in samples] == counts[:, k].tolist(), text


def test_long_texts_equal_one_unbroken_parse(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 64)
    monkeypatch.setattr(L, "TOGETHER", 5)
    draw = random.Random(4)
    sample = "".join(draw.choices("abc", k=500)) + "a" * 300 + "xy" * 200
    other = "".join(draw.choices("abd", k=400))
    texts = ["".join(draw.choices("abcd", k=draw.randint(0, 900))) for _ in range(30)]
    texts += ["a" * 1000, "xy" * 700, "aab" * 300, sample, other + sample, "a", None, "", "q" * 200, "a" * 64, "a" * 65]
    counts, *_ = L.CrossParser((("x", sample), ("y", other))).phrases(texts)
    for k, text in enumerate(texts):
        assert counts[:, k].tolist() == [plain_phrases(part, text or "") for part in (sample, other)], text


def test_every_letter_of_the_samples_counts():
    draw = random.Random(5)
    first, second = (list(map(chr, range(start, start + 1500))) for start in (0x4E00, 0x6E00))
    samples = tuple((lang, "".join(draw.choices(signs, k=4000))) for lang, signs in (("f", first), ("s", second)))
    model = L.CrossParser(samples)
    texts = ["".join(draw.choices(signs, k=300)) for signs in (first, second) for _ in range(5)]
    texts += [samples[1][1][100:2400], "".join(draw.choices("ab" + "".join(first[:40]), k=500))]
    counts, *_ = model.phrases(texts)
    for k, text in enumerate(texts):
        assert counts[:, k].tolist() == [plain_phrases(sample, text) for _, sample in samples]
    names, scores = model.predict(texts[:11])
    assert names == ["f"] * 5 + ["s"] * 6 and min(scores) > 0.5


def test_an_id_that_repeats_is_learned_once(spark):
    rows = [(1, "letters of one text", "en")] * 50 + [(1, "another text of it", "en"), (3, "and a third", "en")]
    (sample,) = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(sample[1].split("\n")) == 2


def test_case_and_signs_do_not_count():
    model = L.CrossParser((("x", "the cat"), ("y", "eine maus")))
    assert model.predict(["THE*** Cat!"])[0] == model.predict(["the cat"])[0] == ["x"]
    assert model.predict(["123 ***", None, ""]) == (["und"] * 3, [0.0] * 3)


def test_held_out_accuracy_and_folds(spark, sf_dir):
    found = {row.doc_id: row for row in op2_language(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    assert len(found) == len(rows)
    for row in rows:
        assert found[row.doc_id].held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= found[row.doc_id].score <= 1
    held = [row for row in rows if found[row.doc_id].held_out]
    assert sum(found[row.doc_id].lang_pred == row.lang for row in held) / len(held) > 0.95


def test_learning_leaves_out_the_held_out_fold(spark):
    out = [n for n in range(40) if zlib.crc32(str(n).encode()) % 4 == 2]
    rows = [(n, "held out words" if n in out else "other text", "en") for n in range(40)]
    (sample,) = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "held" not in sample[1] and "other" in sample[1]


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_odd_rows(request, name):
    docs = request.getfixturevalue(name)
    found = L.identify(docs, L.learn(docs)).collect()
    assert len(found) == docs.count()
    assert all((row.lang_pred == "und") == (row.score == 0) for row in found)
    assert all(row.lang_pred == "und" for row in L.identify(docs, ()).collect())
