import math

import numpy as np
import pytest
from llm_cases import SMALL, corpus  # noqa: F401

from switchboard.llm import whiten as W


def brute(table, most=8):
    """{vec_id: (deviation, whitened by component)}, explained; by an independent eigensolver and whole numbers."""
    fine = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in table
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(fine), len(fine[0][1])
    sums = [sum(x[k] for _, x in fine) for k in range(d)]
    x = np.array([x for _, x in fine], dtype=float) - np.array([s / n for s in sums])
    cov = x.T @ x / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    dev = {i: sum((n * a - s) ** 2 for a, s in zip(row, sums)) for i, row in fine}
    return n, dev, dict(zip([i for i, _ in fine], x @ v / np.sqrt(e))), e / np.trace(cov)


def check(spark, table, frame=None):
    n, dev, white, explained = brute(table)
    frame = frame or spark.createDataFrame(table, "vec_id long, embedding array<float>")
    got = W.whiten(frame).collect()
    many = len(explained)
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, k + 1) for i in dev for k in range(many))
    assert all(r.n == n and int(r.deviation) == dev[r.vec_id] and r.identity_error < 1e-9 for r in got)
    for k in range(many):
        own = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        sign = np.sign(sum(own[i] * white[i][k] for i in own))
        assert max(abs(own[i] - sign * white[i][k]) for i in own) < 1e-8
        assert all(abs(r.explained - explained[k]) < 1e-9 for r in got if r.component == k + 1)


def data(n, d, seed):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) + 3 * rng.standard_normal(d)).astype(np.float32)


def test_against_brute_force(corpus):
    table = [(i, [float(c) for c in v]) for i, v in enumerate(data(300, 20, 1))]
    bad = [(1000, None), (1001, [None] + [1.0] * 19), (1002, [float("nan")] * 20), (1003, [float("inf")] + [0.0] * 19),
           (1004, [1.0] * 19 + [-float("inf")])]
    check(corpus, table + bad)


def test_the_test_table(corpus):
    frame = corpus.read.parquet(f"{SMALL}/embeddings.parquet")
    check(corpus, [(r.vec_id, r.embedding) for r in frame.collect()], frame)


def test_edge_cases(corpus):
    empty = corpus.createDataFrame([], "vec_id long, embedding array<float>")
    assert W.whiten(empty).collect() == []
    one = corpus.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [])], "vec_id long, embedding array<float>")
    assert W.whiten(one).collect() == []  # no variance at all
    # a rank of two, other lengths, clashing columns, repeated rows and null ids
    rows = [(i, [float(i % 7), float(i % 3), 1.0, float(i % 7)], "x", 1, 2, "y") for i in range(40)]
    rows += [(100, [1.0, 2.0], "x", 1, 2, "y"), (None, [3.0, 1.0, 1.0, 3.0], "x", 1, 2, "y"), rows[5], (101, [1e30] * 4, "x", 1, 2, "y")]
    frame = corpus.createDataFrame(rows, "vec_id long, embedding array<double>, vector string, n int, component int, whitened string")
    got = W.whiten(frame).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 2 * 42 and {r.n for r in got} == {42}
    assert sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 5 for r in got) == 4
    assert all(r.identity_error < 1e-9 for r in got) and abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_deviation_is_exact_at_any_size(n):
    rng = np.random.default_rng(n % 97)
    x = rng.integers(90_000, 110_000, (20, 64))
    sums = [int(100_000 * n + s) for s in rng.integers(-1000 * n, 1000 * n, 64)]
    assert W._deviations(x, n, sums) == [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]


def matrices():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 9, 40):
        a = rng.standard_normal((d, 2 * d))
        yield a @ a.T
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    for values in ([5.0] * 12 + [1.0] * 18, list(1 + 1e-13 * np.arange(30)), [1e8, 1.0] + [1e-3] * 28, [3.0] * 9 + [0.0] * 21):
        yield q @ np.diag(values) @ q.T
    yield np.diag(np.arange(20.0))
    yield np.kron(np.eye(4), np.array([[2.0, 1], [1, 2]]))
    yield np.eye(12)


@pytest.mark.parametrize("matrix", list(matrices()))
def test_leading_components(matrix):
    matrix = (matrix + matrix.T) / 2
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    values, vectors = W.leading_components(matrix, 8)
    size = np.abs(matrix).max() * len(matrix)
    assert np.abs(values - want[:len(values)]).max() < 1e-13 * size and np.all(want[len(values):] < 1e-10 * size)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * size


def test_sturm_counts():
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(a) + np.diag(b, 1) + np.diag(b, -1))
    x = np.linspace(-4, 4, 101)
    assert (W.sturm_count(a, b, x) == (values[None] < x[:, None]).sum(axis=1)).all()
