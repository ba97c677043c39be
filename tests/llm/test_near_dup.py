import random

import numpy as np
import pytest
from llm_cases import SMALL, corpus, docs, edge_rows, words  # noqa: F401

from switchboard.llm import near_dup as N
from switchboard.llm.components import connected_components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, percent):
    """Component per row number; rows without words or id are alone."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    return sorted(((d, len(sets[i]), smallest.get(find(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=repr)


def check(spark, rows, percent):
    got = N.near_duplicates(docs(spark, rows, clashing=True), percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def altered(text, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else w + "x" for w in text.split())


def test_edge_cases(corpus):
    check(corpus, edge_rows(), 85)


def test_chains_of_near_copies(corpus):
    # each text is close to the next one only
    text, chain = words(200, 9), []
    for i in range(12):
        text = altered(text, 0.015, i)
        chain.append((100 - i, text))
    check(corpus, chain + [(200 + i, words(200, 50 + i)) for i in range(20)], 85)


def test_rows_that_share_an_id(corpus):
    a, b = words(200, 1), words(200, 2)
    rows = [(5, a), (5, b), (9, altered(a, 0.005, 1)), (8, altered(b, 0.005, 2)), (7, words(50, 3)), (7, words(50, 3))]
    check(corpus, rows, 85)
    kept = N.keep_one(docs(corpus, rows, clashing=True), 85).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, a), (5, b), (7, words(50, 3))])


@pytest.mark.parametrize("percent", [80, 85])
def test_a_large_group_around_the_threshold(corpus, percent):
    # more rows than a bucket has hubs, and more than a block holds, with similarities on both sides of the threshold
    base = words(120, 7)
    group = [(i, altered(base, 0.002 + 0.00012 * i, i)) for i in range(330)]
    check(corpus, group, percent)


def test_empty_table(corpus):
    assert N.near_duplicates(docs(corpus, [])).collect() == []
    assert N.keep_one(docs(corpus, [])).collect() == []


def test_keep_one_returns_the_input_columns(corpus):
    frame = docs(corpus, edge_rows(), clashing=True)
    kept = N.keep_one(frame, 85)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-12, 1, 2, 3, 4, 5, 6, 9, 10, 11]


def test_documents_of_the_test_table(corpus):
    frame = corpus.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    got = N.near_duplicates(frame, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 85)


def test_estimate_is_corrected_for_chance(corpus):
    from pyspark.sql import functions as F
    a = N.shingle_hashes(words(2000, 1))
    for share in (0.0, 0.5, 0.85):
        other = np.unique(np.concatenate([a[:round(len(a) * 2 * share / (1 + share))],
                                          N.shingle_hashes(words(2000, 2))[:len(a) - round(len(a) * 2 * share / (1 + share))]]))
        exact = len(np.intersect1d(a, other)) / len(np.union1d(a, other))
        x, y = (N.signature(N.minima(s))[1].tolist() for s in (a, other))
        frame = corpus.createDataFrame([(x, y)], "x array<long>, y array<long>")
        got = frame.select(N.estimate(F.col("x"), F.col("y"))).first()[0]
        assert abs(got - exact) < 0.15
        sigs = np.array([x, y], dtype=np.int64).view(np.uint64)
        assert abs(N._guess(sigs, 0, np.array([1]))[0] - got) < 1e-9


def test_components_of_long_paths_stars_and_rings(corpus):
    links = [(i, i + 1) for i in range(40)] + [(1000, 2000 + i) for i in range(50)] + [(500 + i, 500 + (i + 1) % 7) for i in range(7)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in connected_components(corpus.createDataFrame(links + links[:5], "a long, b long"),
                                                             "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 1000: 1000, **{2000 + i: 1000 for i in range(50)}, **{500 + i: 500 for i in range(7)}}
