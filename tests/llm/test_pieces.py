import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from webmart.llm import common, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.pieces(PATH)


def test_random_texts_encode_as_in_the_library(model):
    draw = random.Random(5)
    bits = [*"aetinos  \n\t.▁éß中日😀\x00\x85ſK0123xyz<>|_-", "the", "ing", " def", "    ", "тест", "한국", " " * 17]
    for _ in range(3000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 40)))
        ids = LIBRARY.encode(text, add_eos=True)
        assert model.encode(text) == ids
        assert model.decode(ids) == LIBRARY.decode(ids)
        assert model.round_trip(text) == model.decode(ids) == model.decode_decimal(" ".join(map(str, ids)))


def test_any_ids_decode_as_in_the_library(model):
    draw = random.Random(6)
    for _ in range(2000):
        ids = [draw.choice([draw.randint(0, 31999), draw.randint(0, 262), 28705]) for _ in range(draw.randint(0, 8))]
        assert model.decode(ids) == LIBRARY.decode(ids)
        if ids:
            assert model.decode_decimal(" ".join(map(str, ids))) == LIBRARY.decode(ids)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = []
    for row in rows:
        ids = LIBRARY.encode(row.text or "", add_eos=True)
        out.append((row.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "none", "clashing"])
def test_digests_equal_the_library(request, name):
    docs = request.getfixturevalue(name)
    found = sorted(map(tuple, pieces.encoding_digests(docs, PATH).collect()), key=repr)
    assert found == expected(docs.select("doc_id", "text").collect())


def test_full_results(odd):
    for row in pieces.encode_documents(odd, PATH).collect():
        assert row.n_tokens == len(row.ids) and LIBRARY.decode(row.ids) == row.decoded


def test_a_worker_keeps_one_model():
    first = pieces.pieces(PATH)
    assert pieces.pieces(PATH) is first
    assert common.kept("other", list) == []
    assert pieces.pieces(PATH) is not first


def test_words_are_kept_within_bounds(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHARS", 5 * pieces.ENTRY)
    own = pieces.Pieces(PATH)
    text = " ".join(f"word{n}\nnext{n}" for n in range(50))
    assert own.encode(text) == LIBRARY.encode(text, add_eos=True)
    assert len(own.new_words) <= 5 and len(own.old_words) <= 5 and len(own.lines) <= 5
