"""Line deduplication across documents with two Bloom filters (operator 4).

1. Every task turns the hashes of its long lines, FLUSH at a time, into the
   places they set in two filters: seen once, and seen again. Filters are cut
   into slices of SLICE_BITS; a slice goes out as two-byte places while it is
   sparse and as bits where that is shorter. The partial slices of all tasks
   meet by slice and are folded one after the other (``twice |= once & next;
   once |= next``), one slice in memory at a time.
2. A second pass keeps only lines that the twice-seen filter holds. These
   suspects are shuffled as 128-bit digests of the whole key, with their
   document: exact counts and the place where the line stays (largest id).
3. Each document gets the digests of the lines it loses and is rebuilt; only
   documents that may lose a line are shuffled for that.

The filter is sized by the row count and bounded by MAX_FILTER_BITS (128 MB).
Past its capacity, about 67 million different long lines, more and more lines
are suspects: at ten times that nearly all, and the exact step then shuffles a
32-byte row per long line. The result is the same for any size.

Defined results
  null or empty text     one empty line, which is too short to be dropped
  very long text         processed whole, one text at a time
  repeats in a document  count as one document; all of them go, or all stay
  repeated rows          each row counts as a document; rows with the largest id keep the line
  null ids               count as documents, and sort below every other id
  empty tables           an empty result
  extra columns          kept as they are; added columns start with ``_line_`` or the given prefix, which no input column may have
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import free_names, lean, row_key, settle, split_touched

MIN_CHARS = 20
MIN_DOCS = 3
HASHES = 3
BITS_PER_ROW = 256            # about 16 long lines of a document at 16 bits each
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 20, 1 << 30
SLICE_BITS = 1 << 16
FLUSH = 1 << 19               # line hashes that a task keeps before their places go out
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes | None:
    """Stripped, A-Z lower-cased line, or None if it is shorter than MIN_CHARS code points.

    ``bytes.strip`` and ``bytes.lower`` know ASCII only: exactly the white space and letters of the rule.
    """
    key = line.strip()
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and len(key.translate(None, _CONTINUATION)) < MIN_CHARS):
        return None
    return key.lower()


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions per line hash, as columns (double hashing)."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(HASHES)])


def _holds(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    bit = (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
    return bit.all(axis=0)


def _line_hashes(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct keys of each text, their hashes, and the row of each."""
    keys, rows = [], []
    for i, text in enumerate(texts):
        own = {k for line in (text.as_py() or "").encode().split(b"\n") if (k := line_key(line)) is not None}
        keys.extend(own)
        rows.extend([i] * len(own))
    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
    return keys, hashes, np.array(rows, dtype=np.int64)


_SLICE = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _packed(places: np.ndarray) -> bytes:
    """Places in a slice, sorted: two bytes each, or the bits of the slice where those are shorter."""
    if 2 * len(places) < SLICE_BITS // 8:
        return places.astype(np.uint16).tobytes()
    bits = np.zeros(SLICE_BITS, dtype=bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    """The bits of a slice, eight to a byte."""
    if len(data) == SLICE_BITS // 8:
        return np.frombuffer(data, dtype=np.uint8)
    bits = np.zeros(SLICE_BITS, dtype=bool)
    bits[np.frombuffer(data, dtype=np.uint16)] = True
    return np.packbits(bits, bitorder="little")


def _partial_slices(hashes: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """The slices that these line hashes set: the places of all, and of those that occur more than once."""
    different, counts = np.unique(np.concatenate(hashes), return_counts=True)
    once = np.unique(_positions(different, bits))
    twice = np.unique(_positions(different[counts > 1], bits))
    slices, first = np.unique(once >> np.uint64(SLICE_BITS.bit_length() - 1), return_index=True)
    edge = slices << np.uint64(SLICE_BITS.bit_length() - 1)
    low = np.searchsorted(twice, edge)
    high = np.searchsorted(twice, edge + np.uint64(SLICE_BITS))
    ends = np.append(first[1:], len(once))
    for at in range(0, len(slices), 256):
        part = range(at, min(at + 256, len(slices)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(slices[at:at + 256].astype(np.int32)),
             pa.array([_packed(once[first[k]:ends[k]] - edge[k]) for k in part], pa.binary()),
             pa.array([_packed(twice[low[k]:high[k]] - edge[k]) for k in part], pa.binary())], schema=_SLICE)


def _fill(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            _, hashes, _ = _line_hashes(batch.column("text"))
            kept.append(hashes)
            size += len(hashes)
            if size >= FLUSH:
                yield from _partial_slices(kept, bits)
                kept, size = [], 0
        if size:
            yield from _partial_slices(kept, bits)

    return lean(fill)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold partial slices that arrive sorted by slice; holds one slice at a time."""
    now, once, twice = None, None, None

    def done():
        places = np.flatnonzero(np.unpackbits(twice, bitorder="little"))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_packed(places)], pa.binary())],
                                          names=["slice", "twice"])

    for batch in batches:
        for k, one, two in zip(*(batch.column(n) for n in ("slice", "once", "twice"))):
            k, one, two = k.as_py(), _unpacked(one.as_py()), _unpacked(two.as_py())
            if k != now:
                if now is not None and twice.any():
                    yield done()
                now, once, twice = k, one.copy(), two.copy()
            else:
                twice |= two | (once & one)
                once |= one
    if now is not None and twice.any():
        yield done()


def filter_bits(rows: int) -> int:
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (max(1, rows * BITS_PER_ROW) - 1).bit_length()))


def twice_seen(docs: DataFrame, bits: int) -> np.ndarray:
    """The twice-seen filter over the lines of all documents: ``bits`` bits, whatever the number of rows."""
    parts = docs.select("text").mapInArrow(_fill(bits), "slice int, once binary, twice binary")
    slices = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_fold, "slice int, twice binary")
    whole = np.zeros(max(bits, SLICE_BITS) // 8, dtype=np.uint8)
    per = SLICE_BITS // 8
    for r in slices.toLocalIterator():
        whole[r["slice"] * per:(r["slice"] + 1) * per] = _unpacked(bytes(r["twice"]))
    return whole.view(np.uint64)


_SUSPECT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("digest", pa.binary())])


def _suspects(shared, bits: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            keys, hashes, rows = _line_hashes(batch.column("text"))
            hit = np.flatnonzero(_holds(words, _positions(hashes, bits))) if len(keys) else []
            rows = pa.array(rows[hit] if len(keys) else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("key").take(rows),
                 pa.array([_digest(keys[i]) for i in hit], pa.binary())], schema=_SUSPECT)

    return lean(find)


def _rebuild(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
    out = []
    for t, lost in zip(text, drop):
        lines = (t or "").encode().split(b"\n")
        if lost is None or not len(lost):
            out.append((t or "", len(lines), 0))
            continue
        gone = set(lost)
        kept = [x for x in lines if (k := line_key(x)) is None or _digest(k) not in gone]
        out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, prefix: str = "_line") -> DataFrame:
    """``docs`` with ``_line_text`` (what stays), ``_line_n`` and ``_line_dropped``; ``prefix`` names them otherwise."""
    spark = docs.sparkSession
    bits = filter_bits(docs.count())
    shared = spark.sparkContext.broadcast(twice_seen(docs, bits))
    suspects = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text").mapInArrow(
        _suspects(shared, bits), "doc_id long, key long, digest binary"), "line-suspects")
    repeated = settle(suspects.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("stays"))
                      .where(F.col("n") >= min_docs).drop("n"), "line-repeated")
    doc_id, key, lost, found = free_names(docs, "lost_id", "lost_key", "lost", "found")
    gone = suspects.join(repeated, "digest").where(~F.col("doc_id").eqNullSafe(F.col("stays"))).select(
        F.col("key").alias(key), F.col("doc_id").alias(doc_id), "digest")
    by_doc = settle(gone.groupBy(key, doc_id).agg(F.collect_set("digest").alias(lost)), "line-lost")
    maybe, rest = split_touched(docs, row_key(), by_doc.select(key))
    rebuild = F.pandas_udf(_rebuild, "text string, n_lines long, n_dropped long")
    changed = maybe.join(by_doc, F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id))
                         & (row_key() == F.col(key)), "left").withColumn(found, rebuild("text", lost))
    own, names = [F.col(f"`{c}`") for c in docs.columns], [f"{prefix}_{c}" for c in ("text", "n", "dropped")]
    text = F.coalesce("text", F.lit(""))
    lines = F.octet_length(text) - F.octet_length(F.translate(text, "\n", "")) + 1
    return changed.select(*own, *(F.col(f"{found}.{c}").alias(n) for c, n in zip(("text", "n_lines", "n_dropped"), names))) \
        .unionByName(rest.select(*own, *(c.alias(n) for c, n in zip(
            (text, lines.cast("long"), F.lit(0).cast("long")), names))))
