import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import SMALL, corpus, docs, edge_rows  # noqa: F401

from switchboard.llm import sentencepiece_bpe as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return S.BpeModel(file.read())


def texts(n, seed):
    rng = random.Random(seed)
    letters = "  \n\tabcdefghinorst'.,ABTHé▁ñ中文字日本😀\x00́ø1234567890-_</s>​�　\xa0"
    parts = ["the", "ing", "tion", "▁", "   ", "http://", "def ", "<s>", "</s>", "<0x41>", "ération", "привет", "日本語", "\r\n"]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.4:
            yield "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        elif kind < 0.7:
            yield "".join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(20)))
        elif kind < 0.85:
            yield " " * rng.randrange(70) + rng.choice(parts) + " " * rng.randrange(40)
        else:
            yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(30)))


def test_ids_and_text_are_those_of_the_library(model, library):
    for text in texts(6000, 3):
        ids = library.encode(text)
        assert model.encode(text) == ids, text
        assert model.decode(ids) == library.decode(ids), text


def test_decoding_any_ids(model, library):
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259)]) for _ in range(rng.randrange(12))]
        ids = [i for i in ids if i > 2]
        assert model.decode(ids) == library.decode(ids), ids


def test_pairs_are_apart_as_merging_says(model):
    rng = random.Random(5)
    pieces = sorted(p for p in model.left if len(p) < 8)
    for _ in range(20000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        assert model.apart(a, b) == (model.merge(a + b) == [a, b]), (a, b)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(S, "CACHED_SEGMENTS", 4)
    monkeypatch.setattr(S, "CACHED_PAIRS", 3)
    with open(PATH, "rb") as file:
        own = S.BpeModel(file.read())
    for text in texts(300, 6):
        assert own.encode(text) == library.encode(text)


def check(frame, library):
    got = S.encode_documents(frame, PATH, ids=True)
    assert got.columns[:len(frame.columns)] == frame.columns
    for r in got.collect():
        ids = library.encode(r.text or "")
        assert r._sp_ids == ids and r._sp_n == len(ids)
        assert r._sp_ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r._sp_text_sha256 == sha256(library.decode(ids).encode()).hexdigest()


def test_edge_cases(corpus, library):
    check(docs(corpus, edge_rows() + [(20, "x" * 5000), (21, " " * 3000)], clashing=True), library)
    assert S.encode_documents(docs(corpus, []), PATH).collect() == []


def test_documents_of_the_test_table(corpus, library):
    check(corpus.read.parquet(f"{SMALL}/documents.parquet"), library)
