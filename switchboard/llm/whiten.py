"""Whitening of embeddings by their leading principal components (operator 12).

1. Entries become whole numbers (``quantised``); exact counts and sums per
   dimension in one pass.
2. Every task adds up the products of its centred rows; a row of the matrix
   per task and dimension goes out, and the rows of a dimension are folded as
   a stream. The covariance, of a size that depends on the dimension alone,
   goes to the driver.
3. Householder reflections make it tridiagonal. Sturm counts bisect the
   leading eigenvalues; inverse iteration gives their vectors, and vectors of
   close eigenvalues are made orthogonal again after every step.
4. Mean and components are broadcast, every row is projected, and the
   covariance of the projected rows is measured over all of them.

Defined results
  null vector, null or non-finite entries  dropped
  entries of 2**38 or more                 dropped (their fixed-point form has no exact product)
  vectors of several lengths               the most frequent length counts (of equally frequent ones the largest); others are dropped
  empty vectors                            dropped
  components of no variance                left out: eigenvalues of at most RANK times the largest
  repeated rows                            rows of their own; ties of eigenvalues: any basis of their space
  null ids                                 kept as null
  empty tables                             an empty result
  extra columns                            are not read
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import lean, settle

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LIMIT = 2.0**38
RANK = 1e-12
MAX_DIMENSIONS = 8192  # a covariance of 512 MB on the driver
_ROWS = 4096


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of a symmetric matrix's tridiagonal form, and the Householder vectors that led there."""
    a = np.array(matrix, dtype=np.float64)
    n, reflections = len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = math.sqrt(float(x @ x))
        v = x.copy()
        if size == 0 or not np.any(x[1:]):
            reflections.append(np.zeros_like(x))
            continue
        v[0] += math.copysign(size, x[0])
        v /= math.sqrt(float(v @ v))
        part = a[k + 1:, k + 1:]
        w = part @ v
        w -= (v @ w) * v
        part -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ x)
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each x: the negative pivots of T - x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(np.max(off**2, initial=0)))
    below = np.zeros(x.shape, dtype=np.int64)
    for k in range(len(diagonal)):
        pivot = diagonal[k] - x - (off[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, bisected to double precision."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = np.full(most, (diagonal - reach).min()), np.full(most, (diagonal + reach).max())
    size = max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - size * 1e-15, high + size * 1e-15
    wanted = n - np.arange(most)  # so many eigenvalues are at most the one sought
    for _ in range(200):
        middle = (low + high) / 2
        over = sturm_count(diagonal, off, middle) >= wanted
        high, low = np.where(over, middle, high), np.where(over, low, middle)
        if np.all(high - low <= 2 * np.finfo(float).eps * np.maximum(np.abs(low), np.abs(high))):
            break
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; a zero pivot becomes a tiny one."""
    n = len(diagonal)
    pivots, first, second, y = np.zeros(n), np.zeros(n), np.zeros(n), right.astype(float).copy()
    row = [diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0]
    for k in range(n - 1):
        below = [off[k], diagonal[k + 1] - shift, off[k + 1] if k + 2 < n else 0.0]
        if abs(below[0]) > abs(row[0]):
            row, below = below, row
            y[k], y[k + 1] = y[k + 1], y[k]
        if row[0] == 0:
            row[0] = tiny
        factor = below[0] / row[0]
        pivots[k], first[k], second[k] = row
        row = [below[1] - factor * row[1], below[2] - factor * row[2], 0.0]
        y[k + 1] -= factor * y[k]
    pivots[n - 1] = row[0] if abs(row[0]) > tiny else tiny
    for k in reversed(range(n)):
        if k + 1 < n:
            y[k] -= first[k] * y[k + 1]
        if k + 2 < n:
            y[k] -= second[k] * y[k + 2]
        y[k] /= pivots[k]
        big = np.max(np.abs(y[k:]))
        if big > 1e150:
            y /= big
    return y


def leading_eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 6) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as columns, by inverse iteration.

    Eigenvalues nearer than a thousandth of the matrix's size to the one before belong to one cluster. A vector is made
    orthogonal to the earlier ones of its cluster after every step, and close shifts are set apart.
    """
    n = len(diagonal)
    size = float(np.max(np.abs(diagonal)) + 2 * np.max(np.abs(off), initial=0)) or 1.0
    tiny = np.finfo(float).eps * size
    random, found, start, shift = np.random.default_rng(12), np.zeros((n, len(values))), 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            start = k
        shift = min(value, shift - 4 * tiny) if k > start else value
        y = random.standard_normal(n)
        for _ in range(steps):
            y = _solve(diagonal, off, shift, y / np.linalg.norm(y), tiny)
            y /= np.linalg.norm(y)
            for _ in range(2):
                y -= found[:, start:k] @ (found[:, start:k].T @ y)
            y /= np.linalg.norm(y)
        found[:, k] = y
    return found


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of the ``most`` leading components with variance."""
    n = len(matrix)
    scale = float(np.trace(matrix)) or 1.0
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(most, n))
    values = values[values > RANK * max(values[0], np.finfo(float).tiny)]
    vectors = leading_eigenvectors(diagonal, off, values)
    for k in reversed(range(len(reflections))):
        v = reflections[k]
        vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    return values * scale, vectors


def _vectors(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and entries, as doubles, of the vectors of d finite entries."""
    size = column.value_lengths()
    rows = np.flatnonzero(np.asarray(size.fill_null(-1)) == d)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    entries = flat.to_numpy(zero_copy_only=False).reshape(-1, d)  # null becomes NaN
    fine = np.isfinite(entries).all(axis=1) & (np.abs(entries) < LIMIT).all(axis=1)
    return rows[fine], entries[fine]


def quantised(entries: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + OFFSET."""
    return np.floor(SCALE * entries).astype(np.int64) + OFFSET


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _sums(name: str, d: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for part in _parts(batches):
            x = quantised(_vectors(part.column(name), d)[1])
            if len(x):
                n += len(x)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]  # 4,096 entries below 2**48 fit a long
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array([str(t) for t in total])], names=["dimension", "n", "total"])

    return lean(sums)


def _products(name: str, mean: np.ndarray):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(mean)
        matrix, seen = np.zeros((d, d)), False
        for part in _parts(batches):
            x = quantised(_vectors(part.column(name), d)[1]) - mean
            matrix += x.T @ x
            seen |= len(x) > 0
        for at in range(0, d if seen else 0, 64):
            some = range(at, min(at + 64, d))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(
                [matrix[i].tobytes() for i in some], pa.binary())], names=["dimension", "products"])

    return lean(products)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each dimension, which arrive one after the other."""
    now, total = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          names=["dimension", "products"])

    for batch in batches:
        for k, row in zip(batch.column("dimension").to_pylist(), batch.column("products").to_pylist()):
            if k != now and now is not None:
                yield done()
            total = np.frombuffer(row) + (total if k == now else 0)
            now = k
    if now is not None:
        yield done()


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S) ** 2, exact."""
    bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if bound**2 * x.shape[1] < 2**63:
        return (((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)).tolist()
    own = [int(s) for s in sums]
    # about the mean first, so that the numbers stay small; n * x - S = n * (x - q) - (S - n * q)
    q = np.array([s // n for s in own], dtype=np.int64)
    left = [s - n * int(a) for s, a in zip(own, q)]
    near = x - q
    if (n * int(np.abs(near).max(initial=0)) + n) ** 2 * x.shape[1] < 2**63:
        return (((n * near - np.array(left, dtype=np.int64)) ** 2).sum(axis=1)).tolist()
    # sum of n^2 a^2 - 2 n a r + r^2 with a = x - q and r = S - n q: whole numbers without bound
    tail = sum(r * r for r in left)
    return [n * n * sum(a * a for a in row) - 2 * n * sum(a * r for a, r in zip(row, left)) + tail for row in near.tolist()]


def _project(name: str, mean: np.ndarray, axes: np.ndarray, n: int, sums: list[int]):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows, entries = _vectors(part.column(name), len(mean))
            if not len(rows):
                continue
            x = quantised(entries)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(rows)), pa.array([str(v) for v in _deviations(x, n, sums)]),
                 pa.array(list((x - mean) @ axes), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    return lean(project)


def _length(vectors: DataFrame, name: str) -> int:
    """The most frequent length of usable vectors, 0 if there are none."""
    usable = F.col(name).isNotNull() & (F.size(name) > 0) & F.forall(
        name, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LIMIT)))
    best = vectors.where(usable).groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return best.d if best else 0


_RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, name: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    d = _length(vectors, name)
    if not d:
        return spark.createDataFrame([], _RESULT)
    if d > MAX_DIMENSIONS:
        raise ValueError(f"{d} dimensions; the covariance is held for at most {MAX_DIMENSIONS}")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(name).cast("array<double>").alias("vector"))
    counted = rows.mapInArrow(_sums("vector", d), "dimension int, n long, total string").groupBy("dimension").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # a row per dimension
    n, sums = counted[0]["n"], [0] * d
    for r in counted:
        sums[r["dimension"]] = int(r["total"])
    mean = np.array([s / n for s in sums])
    covariance = np.zeros((d, d))
    partial = rows.mapInArrow(_products("vector", mean), "dimension int, products binary")
    for r in partial.repartition("dimension").sortWithinPartitions("dimension").mapInArrow(
            _folded, "dimension int, products binary").toLocalIterator():
        covariance[r["dimension"]] = np.frombuffer(bytes(r["products"]))
    covariance = (covariance + covariance.T) / (2 * n)
    values, axes = leading_components(covariance, components) if covariance.any() else (np.zeros(0), np.zeros((d, 0)))
    share = [float(v / np.trace(covariance)) for v in values]
    projected = settle(rows.mapInArrow(_project("vector", mean, axes / np.sqrt(values), n, sums),
                                       "vec_id long, deviation string, whitened array<double>"), "whitened")
    many = len(values)
    if not many:
        return spark.createDataFrame([], _RESULT)
    pairs = [(i, j) for i in range(many) for j in range(i + 1)]
    found = projected.agg(*(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs)).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))
    return projected.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.posexplode("whitened")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("col").alias("whitened"), F.get(F.array(*map(F.lit, share)), F.col("pos")).alias("explained"),
        F.lit(float(error)).alias("identity_error"))
