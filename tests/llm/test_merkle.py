from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from llm_cases import corpus, docs, edge_rows, rows, words  # noqa: F401
from pyspark.sql import functions as F

from switchboard.llm import merkle as M


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, at):
    """Root of the nodes, and the siblings of node ``at`` as (left, right) per level."""
    path = []
    while len(nodes) > 1:
        run = at // 8 * 8
        path.append((nodes[run:at], nodes[at + 1:run + 8]))
        nodes, at = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], at // 8
    return nodes[0], path


def brute(table):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    fields = [(d, s, lang, n, t) for d, t, lang, s, n in table]
    langs = {}
    for f in fields:
        langs.setdefault(f[2], []).append(f)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for x in order:
        langs[x].sort(key=lambda f: (f[0] is not None, f[0] or 0, leaf(f)))
    subroots = [climb([leaf(f) for f in langs[x]], 0)[0] for x in order]
    out = []
    for k, x in enumerate(order):
        leaves = [leaf(f) for f in langs[x]]
        root, upper = climb(subroots, k)
        for i, f in enumerate(langs[x]):
            path = climb(leaves, i)[1] + upper
            changed = f[0] is not None and crc32(str(f[0]).encode()) % 3 == 0 and f[4] is not None
            node = leaf((*f[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in f[4]))) if changed else leaves[i]
            for left, right in path:
                node = h(*left, node, *right)
            out.append((f[0], leaves[i], subroots[k], root, h(*(s for a, b in path for s in a + b)), node, node == root))
    return sorted(out, key=repr)


def frame(spark, table):
    return spark.createDataFrame([(*r, "x") for r in table], "doc_id long, text string, lang string, source string, n_chars long, tree string")


def check(spark, table):
    assert rows(M.verify(frame(spark, table))) == brute(table)


def test_edge_cases(corpus):
    check(corpus, [(d, t, ["en", None, "de", ""][i % 4], [None, "s"][i % 2], [len(t or ""), None][i % 5 == 0])
                   for i, (d, t) in enumerate(edge_rows())])
    assert M.verify(frame(corpus, [])).collect() == []
    check(corpus, [(1, "A lone Document", "en", "s", 3)])
    check(corpus, [(i, "Aa", None, None, None) for i in range(9)])


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_trees_of_many_sizes(corpus, monkeypatch, levels):
    # full and partial runs, a last run of one node, trees that end within a round and at its end, and many trees
    monkeypatch.setattr(M, "LEVELS", levels)
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "e": 65, "f": 72, "g": 513, "h": 130, "i": 2, "j": 7, "k": 63, None: 73}
    check(corpus, [(3 * i + k, f"Text {i}", lang, "s", i) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)])


def test_equal_rows_and_ids(corpus):
    check(corpus, [(7, "Same", "en", "s", 4)] * 30 + [(7, f"other {i}", "en", "s", i) for i in range(30)])


def test_the_log_is_in_postorder(corpus, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)
    table = [(i, f"t{i}", "en" if i < 700 else "de", "s", i) for i in range(777)]
    _, segments, _ = M.manifest(frame(corpus, table))
    for n, log in {77: None, 700: None}.items():
        tree = 0 if n == 77 else 77
        got = [(r.level, r["index"]) for r in M.whole_log(segments).where(F.col("tree") == tree).orderBy("position").collect()]
        want, done = [], [0] * (M.height(n) + 1)
        for i in range(n):
            level = 0
            while True:
                want.append((level, done[level]))
                done[level] += 1
                if level == M.height(n) or done[level] % 8 and i < n - 1:
                    break
                level += 1
        assert got == want
        for level in range(M.height(n) + 1):
            index = np.array([i for k, i in want if k == level])
            assert M.position(level, index, n, M.height(n)).tolist() == [p for p, (k, _) in enumerate(want) if k == level]
