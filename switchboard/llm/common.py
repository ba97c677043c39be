"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import io
import os
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.session import fresh_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of earlier
    steps), gives later joins an exchange of their own on this side, so that
    AQE can split a hot key, and lets several readers share one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores in front as it takes for ``frame`` to have none of them."""
    taken, front = {c.lower() for c in frame.columns}, ""
    while any((front + n).lower() in taken for n in names):
        front += "_"
    return [front + n for n in names]


# Bits of the filter of touched rows: 2048 buckets of 4 KB, 8 MB in all whatever the number of rows.
_TOUCHED_BITS, _BUCKET_BITS = 1 << 26, 1 << 15


def split_touched(docs: DataFrame, key: Column, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows whose ``key`` (a long) may be in the first column of ``touched``, and rows whose key
    is not in it. The second part, most of a large table where few rows are touched, needs no shuffle; the keys are
    folded into a bitmap of fixed size, which is what is broadcast. Past its capacity the first part grows.
    """
    place = F.pmod(key, F.lit(_TOUCHED_BITS))
    bucket, bits = free_names(docs, "bucket", "bits")
    own = F.pmod(F.col(touched.columns[0]), F.lit(_TOUCHED_BITS))
    map_ = touched.select(own.alias("p")).groupBy((F.col("p") / _BUCKET_BITS).cast("int").alias(bucket)).agg(
        F.bitmap_construct_agg(F.pmod("p", F.lit(_BUCKET_BITS))).alias(bits))
    map_ = settle(map_, "touched")
    inside = F.pmod(place, F.lit(_BUCKET_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), (inside / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.pmod(inside, F.lit(8))).cast("int")) != 0, F.lit(False))
    marked = docs.join(F.broadcast(map_), (place / _BUCKET_BITS).cast("int") == F.col(bucket), "left")
    return marked.where(hit).select(*_own(docs)), marked.where(~hit).select(*_own(docs))


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose id and ``row_key`` are in ``gone`` (doc_id, key); only rows that may be are shuffled."""
    doc_id, key = free_names(docs, "id", "key")
    gone = settle(gone.select(F.col("doc_id").alias(doc_id), F.col("key").alias(key)).distinct(), "gone")
    maybe, rest = split_touched(docs, row_key(), gone.select(key))
    left = maybe.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (row_key() == F.col(key)), "left_anti")
    return left.unionByName(rest)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row's id and text: tells rows apart that repeat an id."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Word hashing: a random value per byte, weighted by powers of an odd base, modulo 2**64.
_CHUNK = 1 << 17
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(5).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; kept for texts of ordinary length."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 14), base, dtype=np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if n <= 2 * _CHUNK:
            _powers[base] = table
    return table[:n]


def _hash_words(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _IS_SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(raw) and not space[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(raw))
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(_BASE, len(raw)), out=total[1:])
    return mix64((total[end] - total[start]) * _power(_INVERSE, len(raw))[start] + (end - start).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word ``[^\\x20\\x09-\\x0D]+`` of ``data``, equal for equal words wherever they stand.

    Long texts go through in chunks cut at white space, so tables stay small.
    """
    if len(data) <= _CHUNK:
        return _hash_words(data) if data else np.empty(0, dtype=np.uint64)
    found, at = [], 0
    while at < len(data):
        end = at + _CHUNK
        while end < len(data) and not _IS_SPACE[data[end]]:
            end += 1
        found.append(_hash_words(data[at:end]))
        at = end
    return np.concatenate(found)


def shingle_codes(words: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per run of ``size`` words; the whole sequence is one run where it is shorter."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(words))):
        part = words[k:k + n] * _PLACE[k]
        part ^= part >> np.uint64(29)
        total += part
    return mix64(total ^ np.uint64(min(len(words), size)))


_PLACE = np.random.default_rng(6).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def lean(rows: Callable, at_once: bool = True) -> Callable:
    """A function over batches that gives unused memory back to the system when its task ends: workers live on and
    would hold what their largest task has needed. ``at_once``: large blocks go back as soon as they are free, which
    costs functions that work on many strings a seventh of their time or more."""
    @functools.wraps(rows)
    def run(batches: Iterator) -> Iterator:
        libc = ctypes.CDLL(None)
        if at_once and hasattr(libc, "mallopt"):
            libc.mallopt(_MMAP_THRESHOLD, 1 << 20)  # larger blocks go back to the system as soon as they are free
        try:
            yield from rows(batches)
        finally:
            release_memory()
    return run


_MMAP_THRESHOLD = -3  # fixed value: M_MMAP_THRESHOLD of the C library


def release_memory() -> None:
    """Give memory that this process does not use back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)

# Bytes of a batch that goes to or comes from a Python worker; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Bound the batches between Spark and the Python workers, and send this package to the workers once per session,
    so that they can import the operators' helpers (from the shared folder). Where the cluster already installs the
    package, sending it changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_switchboard_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.join("switchboard", os.path.relpath(path, root)))
    archive = fresh_path(spark, "switchboard_package") + ".zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(archive)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    context.addPyFile(archive)
    context._switchboard_shipped = True
