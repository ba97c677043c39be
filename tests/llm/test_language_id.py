import zlib

import numpy as np
from llm_cases import corpus, docs, edge_rows, rows, words  # noqa: F401

from switchboard.llm import language_id as L

SYLLABLES = {"aa": "ka to mi ne ru so hi", "bb": "strum gelk wost brind", "cc": "eau oui elle ette", "dd": "xyz qwx zvk kzq"}


def text(lang, n, seed):
    rng = np.random.default_rng(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.integers(1, 4))) for _ in range(n))


def table(n):
    langs = list(SYLLABLES)
    return [(i, text(langs[i % 4 if i % 3 else 0], 20, i), langs[i % 4 if i % 3 else 0]) for i in range(n)]


def test_held_out_accuracy_and_split(corpus):
    data = table(400)
    got = {r.doc_id: r for r in L.identify(docs(corpus, data)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in data)
    held = [(got[i].lang_pred == lang) for i, _, lang in data if got[i].held_out]
    assert len(held) > 40 and np.mean(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_cases(corpus):
    data = table(120) + [(d + 1000 if d is not None else None, t, None if d == 4 else "aa") for d, t in edge_rows()]
    data += [(2000, "12 34 !!", "bb"), (2001, "ka to", None), (2002, "mixed " + text("bb", 9, 1) + text("cc", 9, 1), "cc")]
    frame = docs(corpus, data, clashing=True)
    got = L.identify(frame)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]
    got = got.collect()
    assert len(got) == len(data)
    none = {i for i, t, _ in data if not any(c.isalpha() for c in t or "")}
    for r in got:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (r.doc_id in none)
            assert r.lang_pred in {*SYLLABLES, "und"}
        else:
            assert not r.held_out


def test_held_out_rows_teach_nothing(corpus):
    data = table(200)
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in data]
    assert rows(L.identify(docs(corpus, data))) == rows(L.identify(docs(corpus, other)))


def test_no_rows_or_no_languages_or_one(corpus):
    assert L.identify(docs(corpus, [])).collect() == []
    (r,) = L.identify(docs(corpus, [(1, "some text", None)])).collect()
    assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, True)
    got = L.identify(docs(corpus, [(i, words(9, i), "only") for i in range(20)])).collect()
    assert {r.lang_pred for r in got} == {"only"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 7, 20, 60):
        code = L.codewords(n)
        assert code.shape[0] == n and (abs(code.sum(axis=0)) < n).all()
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= max(1, code.shape[1] // 5)


def test_decoding_corrects_a_wrong_bit_and_flags_ambiguity():
    model = L.Classifier(list("abcd"), np.ones((4, L.BUCKETS)))
    for k in range(4):
        margin = model.code[k] * 0.9
        margin[k] *= -1
        assert model.decode(margin)[0] == k
    sure, torn = model.decode(model.code[0] * 0.9), model.decode((model.code[0] + model.code[1]) * 0.45)
    assert not sure[2] and torn[2] and sure[1] > torn[1]


def test_grams_do_not_depend_on_case_digits_and_breaks():
    assert np.array_equal(L.grams("Été, 12 là"), L.grams("  été...là\n"))
    assert not len(L.grams("12 !")) and not len(L.grams(""))
