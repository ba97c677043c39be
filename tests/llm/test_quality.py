import random

import numpy as np
import pytest
from llm_cases import SMALL, corpus, docs, edge_rows, words  # noqa: F401

from switchboard.llm import quality as Q


def brute(text):
    import re
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    symbols = sum(c in "#*$%&|<>" for c in text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    cover = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    n = len(w)
    return n, sum(map(len, w)), symbols, dup, len(cover), n < 10 or 100 * len(cover) > 20 * n


def labels(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, quality int, toxic int, key string")


def test_base_counts(corpus):
    rows = edge_rows() + [(20, "a b c d e " * 5), (21, "x\n" * 12 + "y z\n\n\n y z\ny z"), (22, "#*$%&|<> é#"),
                          (23, "a b c d e f a b c d e g " + words(80, 1)), (24, words(11, 3) + "\x1c\x85\xa0" + words(5, 9))]
    got = Q.judge(docs(corpus, rows, clashing=True), labels(corpus, [(1, 1), (None, 1), (3, None)])).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got), key=repr) == sorted(((d, *brute(t)) for d, t in rows), key=repr)
    # without labels of both kinds only the base rule decides
    assert all(r.kept != r.base_failed for r in got)


def test_empty_tables(corpus):
    assert Q.judge(docs(corpus, []), labels(corpus, [])).collect() == []
    assert Q.keep_good(docs(corpus, []), labels(corpus, [(1, 1)])).collect() == []


def corpus_rows():
    rng = random.Random(1)
    good = [(i, " ".join(words(rng.randint(20, 90), 1000 + i + k) + "." for k in range(rng.randint(1, 5)))) for i in range(400)]
    bad = [(1000 + i, " ".join(w + rng.choice(["***", "%%", "|", "$"]) for w in words(60, 5000 + i).split())) for i in range(80)]
    return good, bad


def test_anomalies_go_and_good_rows_stay(corpus):
    good, bad = corpus_rows()
    known = [(d, 1) for d, _ in good[::2]] + [(d, 0) for d, _ in bad[::2]]
    frame = docs(corpus, good + bad, clashing=True)
    kept = Q.keep_good(frame, labels(corpus, known))
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & {d for d, _ in good}) >= 0.98 * len(good)
    assert len(ids & {d for d, _ in bad}) <= 0.05 * len(bad)


def test_few_bad_labels_still_calibrate_the_forest(corpus):
    good, bad = corpus_rows()
    known = [(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad[:3]]
    frame = docs(corpus, good + bad)
    got = Q.judge(frame, labels(corpus, known), fit_rows=32).collect()
    assert all(r.anomaly > 0 for r in got)
    assert sum(r.kept for r in got if r.doc_id >= 1000) <= 0.5 * len(bad)
    assert sum(r.kept for r in got if r.doc_id < 1000) >= 0.98 * len(good)


def test_paths_match_a_plain_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 4))
    forest = Q.Forest(rows[:200], rows, trees=5, tree_rows=64)

    def walk(tree, row):
        feature, cut, left, right, length = tree
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] < cut[at] else right[at]
        return length[at]

    expected = float(Q._average_path(64))
    want = [2 ** (-sum(walk(t, r) for t in forest.trees) / 5 / expected) for r in rows]
    assert np.allclose(forest.score(rows), want)
    far = forest.score(np.array([[9.0, 9, 9, 9], [0, 0, 0, 0]]))
    assert far[0] > far[1]


def test_calibration():
    good, bad = np.zeros(100, dtype=int), np.zeros(100, dtype=int)
    good[20:40], bad[60:80] = 50, 5
    assert 40 <= Q.calibrate(good, bad, 0.0) <= 60
    assert Q.calibrate(good, np.zeros(100, dtype=int)) == 100
    bad[:] = 0
    bad[10] = 5
    assert Q.calibrate(good, bad, 0.0) == 100       # bad rows that look better than good ones stay


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 40, 300])
def test_repeats_of_small_vocabularies(n):
    rng = random.Random(n)
    text = " ".join(rng.choice("abc") for _ in range(n))
    assert Q.text_stats(text.encode())[0][4] == brute(text)[4]


def test_documents_of_the_test_table(corpus):
    frame = corpus.read.parquet(f"{SMALL}/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in frame.collect()}
    got = Q.judge(frame, corpus.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
        assert not (r.kept and r.base_failed)
