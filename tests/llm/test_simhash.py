import itertools
import random

import numpy as np
import pytest
import xxhash
from llm_cases import SMALL, corpus, docs, edge_rows, rows, words  # noqa: F401

from switchboard.llm import simhash as S


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            found += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(table):
    prints = [plain_fingerprint(t) for _, t in table]
    root = list(range(len(table)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(table)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2 or table[i][0] is not None and table[i][0] == table[j][0]:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(table):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, prints[i], least.get(find(i))) for i, (d, _) in enumerate(table)), key=repr)


def check(spark, table):
    got = S.near_duplicates(docs(spark, table, clashing=True)).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == brute(table)


def test_edge_cases(corpus):
    check(corpus, edge_rows())
    assert S.near_duplicates(docs(corpus, [])).collect() == []
    check(corpus, [(3, None)])
    check(corpus, [(None, "a b c"), (None, "a b c"), (None, "x y z w")])


def test_rows_of_one_id_are_one_document(corpus):
    a, b, c = words(40, 1), words(40, 2), words(40, 3)
    check(corpus, [(5, a), (5, b), (9, a), (8, b), (7, c), (5, c), (None, c), (None, words(9, 4))])


def test_hash_is_that_of_spark(corpus):
    frame = corpus.sql("SELECT xxhash64('one two three') AS h")
    assert frame.first().h % 2**64 == S.fingerprint("One  two\tthree")


def test_pieces_of_long_texts(monkeypatch):
    text = words(700, 5) + "\n " + "é" * 300 + " " + words(300, 6)
    whole = S.fingerprint(text)
    assert whole == plain_fingerprint(text)
    for size in (1, 2, 7, 64, 1000):
        monkeypatch.setattr(S, "_CHUNK", size)
        assert S.fingerprint(text) == whole


def test_documents_of_the_test_table(corpus):
    frame = corpus.read.parquet(f"{SMALL}/documents.parquet")
    table = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    got = S.near_duplicates(frame).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == brute(table)


def crowd(rng, centre, n, most):
    out = set()
    while len(out) < n:
        out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most))))
    return out


@pytest.mark.parametrize("parts", [2, 3, 4])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_are_all_pairs_within_the_distance(corpus, monkeypatch, parts, distance):
    # crowded places, low entropy and plain random numbers; all ways of the allocation are taken
    monkeypatch.setattr(S, "CROWDED", 8)
    rng = random.Random(parts)
    numbers = crowd(rng, rng.getrandbits(64), 700, 4) | crowd(rng, 0, 150, 2) | {rng.getrandbits(64) for _ in range(300)}
    numbers |= {rng.getrandbits(12) << 40 for _ in range(200)}
    numbers |= {x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for x in rng.sample(sorted(numbers), 200)}
    numbers = np.array(sorted(numbers), dtype=np.uint64)
    near = np.bitwise_count(numbers[:, None] ^ numbers) <= distance
    want = {(int(a), int(b)) for a, b in zip(*map(numbers.view(np.int64).__getitem__, np.nonzero(np.triu(near, 1))))}
    frame = corpus.createDataFrame([(int(x),) for x in numbers.view(np.int64)], "fp long")
    got = {tuple(r) for r in S.links(frame, distance, parts).collect()}
    assert {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in want}
    assert all((b, a) in got for a, b in got)


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(3)
    work = np.cumsum(rng.random((200, 4, 3)), axis=2)
    limits, least = S.allocate(work)
    assert (limits.sum(axis=1) == 2 - 4 + 1).all()
    for k in range(200):
        costs = [sum(work[k, p, t] for p, t in enumerate(ts) if t >= 0)
                 for ts in itertools.product(range(-1, 3), repeat=4) if sum(ts) == -1]
        own = sum(work[k, p, t] for p, t in enumerate(limits[k]) if t >= 0)
        assert abs(own - least[k]) < 1e-12 and abs(least[k] - min(costs)) < 1e-12


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64))
    for k in range(1, 10):
        bits[:, 6 * k] = bits[:, 0]  # ten copies of bit 0
    groups = S.group_bits(bits.T @ bits, 4000, 3)
    assert sorted(itertools.chain(*groups)) == list(range(64)) and {len(g) for g in groups} == {21, 22}
    assert set(range(0, 60, 6)) <= set(groups[0])


def test_estimate_counts_neighbours():
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    groups = [list(range(16)), list(range(16, 64))]
    counts = np.array([np.bincount(S.gathered(numbers, b).astype(int), minlength=256) for _, b in S._short_blocks(groups)])
    guess = S.expected(numbers[:50], groups, S.near_shares(counts), len(numbers))[:, 0]
    value = numbers & np.uint64(0xFFFF)
    exact = np.array([[(np.bitwise_count(value ^ v) <= t).sum() for t in range(3)] for v in value[:50]])
    assert np.abs(guess - exact)[:, 2].mean() < 12
