"""Quality rules judged by an isolation forest (operator 10).

One pass over the texts computes the rule statistics of every row. Trees of
random splits are grown on a bounded sample of good labelled rows; a document
whose path through the trees is short is anomalous. The threshold on that score is
calibrated on all labelled rows. Rows that fail the base rule are rejected in
any case.

Defined results
  null or empty text      no words, all counts 0, base_failed (fewer than 10 words)
  very long text          processed whole; memory is proportional to one text
  repeated rows, null ids each row is judged by its own text
  empty tables            an empty result; without labelled rows of both kinds
                          that pass the base rule there is no calibration and
                          only the base rule decides
  extra columns           ``judge`` returns doc_id and its own columns only;
                          ``keep_good`` returns the columns of its input
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import lean, row_key, settle, shingle_codes, without_rows, word_hashes

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
# Bounds of the fit: rows sampled for growing trees, trees, rows of one tree.
FIT_ROWS = 8192
TREES = 64
TREE_ROWS = 256
# Share of good labelled rows that the calibrated threshold may reject.
MAX_GOOD_REJECTED = 0.005
SCORE_BINS = 2000

_SYMBOLS = b"#*$%&|<>"
_SPACE_AND_CONTINUATION = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))
_PUNCT = b".,;:!?"
_DIGITS = b"0123456789"

# Rates are drawn towards ordinary values as if this many ordinary words came
# with the text: a short text is not anomalous by chance alone.
PRIOR = 100
FEATURES = ["word_len", "symbols", "dup_lines", "repeats", "punct", "digits"]

_STATS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                    ("features", pa.list_(pa.float64()))])


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of WINDOW words found twice or more; ``words`` are word hashes."""
    if len(words) <= WINDOW:
        return 0
    codes = shingle_codes(words, WINDOW)
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, codes), len(twice) - 1)
    starts = np.flatnonzero(twice[at] == codes)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[starts] += 1
    cover[starts + WINDOW] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def text_stats(data: bytes) -> tuple[tuple[int, ...], list[float]]:
    """Base counts and features of one text in UTF-8."""
    words = word_hashes(data)
    n = len(words)
    chars = len(data.translate(None, _SPACE_AND_CONTINUATION))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    if not n:
        return (0, 0, symbols, 0, 0), [0.0] * len(FEATURES)
    repeats = repeated_words(words)
    punct = len(data) - len(data.translate(None, _PUNCT))
    digits = len(data) - len(data.translate(None, _DIGITS))
    features = [(chars + PRIOR * 5.0) / (n + PRIOR), math.log1p(100 * symbols / (n + PRIOR)),
                dup / (len(lines) + PRIOR / 10), repeats / (n + PRIOR), (punct + PRIOR * 0.15) / (n + PRIOR),
                math.log1p(100 * digits / (chars + 5 * PRIOR))]
    return (n, chars, symbols, dup, repeats), features


@lean
def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, features = [], []
        for text in batch.column("text"):
            c, f = text_stats((text.as_py() or "").encode())
            counts.append(c)
            features.append(f)
        columns = list(zip(*counts)) if counts else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), *(pa.array(c, pa.int64()) for c in columns),
             pa.array(features, pa.list_(pa.float64()))], schema=_STATS)


def rule_stats(docs: DataFrame) -> DataFrame:
    """One row per document: id, row key, base counts and forest features."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text").mapInArrow(
        _stats_batches, "doc_id long, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                        "n_repeat_words long, features array<double>")


def _average_path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe))


class Forest:
    """Isolation trees in flat arrays: feature, cut, children, and at leaves the depth plus what is left to split.

    Cuts are uniform over the node's box, which starts as the range of
    ``domain``: a cut may leave one side without sample rows, and a row that
    falls there is isolated at once.
    """

    def __init__(self, rows: np.ndarray, domain: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS,
                 seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = min(tree_rows, len(rows))
        self.limit = math.ceil(1.5 * math.log2(max(2, self.rows)))
        box = domain.min(axis=0), domain.max(axis=0)
        self.trees = [self._grow(rows[rng.choice(len(rows), self.rows, replace=False)], box, rng)
                      for _ in range(trees)]

    def _grow(self, rows: np.ndarray, box: tuple[np.ndarray, np.ndarray], rng: np.random.Generator):
        feature, cut, left, right, length = [], [], [], [], []
        todo = [(rows, *box, 0, -1, False)]
        while todo:
            part, low, high, depth, parent, is_right = todo.pop()
            me = len(feature)
            if parent >= 0:
                (right if is_right else left)[parent] = me
            left.append(-1)
            right.append(-1)
            open_ = np.flatnonzero(high > low)
            if depth >= self.limit or len(part) <= 1 or not len(open_):
                feature.append(-1)
                cut.append(0.0)
                length.append(depth + float(_average_path(len(part))))
                continue
            f = int(rng.choice(open_))
            c = float(rng.uniform(low[f], high[f]))
            feature.append(f)
            cut.append(c)
            length.append(0.0)
            goes = part[:, f] < c
            middle = np.where(np.arange(len(low)) == f, c, low)
            todo.append((part[goes], low, np.where(np.arange(len(high)) == f, c, high), depth + 1, me, False))
            todo.append((part[~goes], middle, high, depth + 1, me, True))
        return tuple(np.array(x) for x in (feature, cut, left, right, length))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]: 2 ** (- mean path length / expected path length)."""
        total = np.zeros(len(rows))
        index = np.arange(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                value = rows[index, np.where(inner, f, 0)]
                at = np.where(inner, np.where(value < cut[at], left[at], right[at]), at)
            total += length[at]
        expected = float(_average_path(self.rows)) or 1.0
        return np.exp2(-total / len(self.trees) / expected)


def calibrate(good: np.ndarray, bad: np.ndarray, max_good_rejected: float = MAX_GOOD_REJECTED) -> int:
    """First rejected score bin: rejects most bad rows while at most the given share of good ones goes.

    ``good`` and ``bad`` count labelled rows per score bin. Returns a bin past the end if no bad row can be rejected.
    """
    above_good = np.cumsum(good[::-1])[::-1]
    above_bad = np.cumsum(bad[::-1])[::-1]
    allowed = np.flatnonzero(above_good <= max_good_rejected * max(1, good.sum()))
    if not len(allowed) or not bad.sum():
        return len(good)
    first = int(allowed[0])
    if not above_bad[first]:
        return len(good)
    # of the bins that reject equally many bad rows, the one farthest from the good rows
    same = np.flatnonzero((above_bad == above_bad[first]) & (np.arange(len(good)) >= first))
    return int((same[0] + same[-1] + 1) // 2)


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, trees: int = TREES,
          tree_rows: int = TREE_ROWS, max_good_rejected: float = MAX_GOOD_REJECTED) -> DataFrame:
    """Verdict per row of ``docs``: doc_id, key, base counts, base_failed, anomaly, kept.

    The fit reads at most ``fit_rows`` labelled rows (by hash of the id, good
    and bad ones each for themselves): trees grow on the good ones, in the range of both. The calibration reads
    every labelled row, as counts per score bin.
    """
    spark = docs.sparkSession
    stats = settle(rule_stats(docs), "quality-stats").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    labelled = settle(stats.where(~F.col("base_failed")).join(marks, "doc_id").select(
        "doc_id", "key", "quality", "features"), "quality-labelled")
    kinds = {True: 0, False: 0}
    for r in labelled.groupBy((F.col("quality") > 0).alias("is_good")).count().collect():
        kinds[r.is_good] += r["count"]
    if not kinds[True] or not kinds[False]:
        return stats.select(*_BASE, F.lit(0.0).alias("anomaly"), (~F.col("base_failed")).alias("kept"))
    # each kind has its share of the bound, but not less than an eighth of it if it has as many rows
    least = fit_rows // 8
    n_bad = min(kinds[False], max(1, least, fit_rows * kinds[False] // sum(kinds.values())), max(1, fit_rows - min(kinds[True], least)))
    n_good = min(kinds[True], max(1, fit_rows - n_bad))
    parts = []
    for is_good, n in ((True, n_good), (False, n_bad)):
        # thinned by hash to about twice the bound first, so that the ordering does not send a bound's worth from every task
        thin = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, (2 * n + 64) / kinds[is_good]))
        kind = labelled.where((F.col("quality") > 0) == F.lit(is_good))
        order = F.xxhash64("doc_id"), "doc_id", "key"
        # rows of few ids may all fall out of the thinned part
        rows = kind.where(thin).orderBy(*order).limit(n).select("features").collect() or kind.orderBy(*order).limit(n).select(
            "features").collect()
        parts.append(np.array([r.features for r in rows], dtype=float))
    good, domain = parts[0], np.concatenate(parts)
    forest = spark.sparkContext.broadcast(
        Forest(good, domain, trees=trees, tree_rows=tree_rows))

    @F.pandas_udf("double")
    def anomaly(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=float)
        return pd.Series(forest.value.score(np.stack(features.to_numpy())))

    counts = labelled.select("quality", F.least(F.lit(SCORE_BINS - 1), F.floor(anomaly("features") * SCORE_BINS)).cast(
        "int").alias("bin")).groupBy("quality", "bin").count().collect()
    by = {k: np.zeros(SCORE_BINS, dtype=np.int64) for k in (True, False)}
    for r in counts:
        by[r.quality > 0][r.bin] += r["count"]
    limit = calibrate(by[True], by[False], max_good_rejected) / SCORE_BINS
    return stats.withColumn("anomaly", anomaly("features")).select(
        *_BASE, "anomaly", (~F.col("base_failed") & (F.col("anomaly") < limit)).alias("kept"))


_BASE = ["doc_id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep, with their columns."""
    return without_rows(docs, judge(docs, labels).where(~F.col("kept")))
