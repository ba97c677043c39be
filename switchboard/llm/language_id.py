"""Language identification by error-correcting output codes (operator 6).

Every language gets a codeword of bits. One binary classifier per bit, a naive
Bayes model over letter n-grams hashed into BUCKETS, predicts whether a text's
language has the bit set. Decoding chooses the language whose codeword loses
least against the classifiers' margins; each bit's loss is weighted by how
well that bit tells the training rows of the language apart. A text whose
best two languages lose nearly the same is flagged as ambiguous.

Counts come from a sample of the learning rows with SAMPLE_ROWS rows per
language in expectation (all rows where there are fewer), chosen by a hash of
the id; the bit weights from the rows of a second sample of that size. Fitted
tables have languages times BUCKETS entries, whatever the number of rows.

Defined results
  null text or no letters      ``und`` with score 0, ambiguous
  very long text               all n-grams count; memory is proportional to one text
  ties                         the language that sorts first
  no learning rows             ``und`` for every row
  one language                 that language for every text with letters
  repeated rows, null ids      judged row by row; a null id is not held out
  extra columns                are not read
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import lean, settle

ORDERS = (2, 3)
BUCKETS = 1 << 15
SAMPLE_ROWS = 3000
AMBIGUOUS = 0.2
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Per code point: its lower-case letter, or a space for what is no letter."""
    if not _letters:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _letters.append(table)
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """Buckets of the letter n-grams of a text; runs of other characters count as one space. Empty without letters."""
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    space = codes == 32
    if space.all():
        return np.empty(0, dtype=np.int64)
    inner = np.flatnonzero(~space)[[0, -1]]
    codes, space = codes[inner[0]:inner[1] + 1], space[inner[0]:inner[1] + 1]
    codes = np.concatenate([[32], codes[~space | np.append(True, ~space[:-1])], [32]]).astype(np.uint32)
    found = []
    for n in ORDERS:
        if len(codes) < n:
            continue
        mixed = np.full(len(codes) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k:k + len(mixed)]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        found.append(mixed & np.uint32(BUCKETS - 1))
    return np.concatenate(found).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language: all splits in two up to 6 languages, well-spread random splits beyond."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = range(1, 2 ** (n - 1))
        return np.array([[1 if i == 0 or not s >> (i - 1) & 1 else -1 for s in splits] for i in range(n)], dtype=float)
    rng, bits = np.random.default_rng(11), max(15, math.ceil(10 * math.log2(n)))
    best, spread = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        if (abs(code.sum(axis=0)) == n).any():
            continue
        distance = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if distance > spread:
            best, spread = code, distance
    return best


class Classifier:
    """Weights per n-gram bucket and bit, codewords, and the bits' weights per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        """``counts``: n-gram counts by language and bucket."""
        self.languages = languages
        self.code = codewords(len(languages))
        self.trust = np.ones_like(self.code)
        if not languages:
            return
        rates = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = []
        for bit in self.code.T:
            # each side is the even mixture of its languages, so frequent languages do not win by number
            plus = rates[bit > 0].mean(axis=0)
            minus = rates[bit < 0].mean(axis=0) if (bit < 0).any() else plus
            weights.append(np.log(plus / minus))
        self.weights = np.stack(weights, axis=1).astype(np.float32)

    def margins(self, text: str) -> np.ndarray | None:
        """Each bit's margin in (-1, 1): the mean log-odds, damped for short texts."""
        found = grams(text)
        if not len(found):
            return None
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(found), 1 << 14):
            total += self.weights[found[at:at + (1 << 14)]].sum(axis=0)
        return np.tanh(total / (2 * math.sqrt(len(found))))

    def weigh(self, right: np.ndarray, rows: np.ndarray) -> None:
        """Set the bits' weights from how many of a language's rows each bit got right."""
        share = (right + 1) / (rows[:, None] + 2)
        trust = np.maximum(share - 0.5, 0.01)
        self.trust = trust / trust.sum(axis=1, keepdims=True) * self.code.shape[1]

    def decode(self, margin: np.ndarray) -> tuple[int, float, bool]:
        """Language number, score, and whether the choice is ambiguous."""
        loss = (self.trust * np.exp(-self.code * margin)).mean(axis=1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(-4 * (loss - loss[order[0]]))
        close = len(order) > 1 and loss[order[1]] - loss[order[0]] < AMBIGUOUS * loss[order[0]]
        return int(order[0]), float(share[order[0]] / share.sum()), bool(close)


def _count_batches(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                table[number[lang.as_py()]] += np.bincount(grams(text.as_py()), minlength=BUCKETS)
        lang, bucket = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()),
                                          pa.array(table[lang, bucket], pa.int64())], names=["lang", "bucket", "n"])

    return lean(count)


def _right_batches(shared):
    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = {x: i for i, x in enumerate(model.languages)}
        hits, rows = np.zeros(model.code.shape), np.zeros(len(number))
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                margin, k = model.margins(text.as_py()), number[lang.as_py()]
                if margin is not None:
                    hits[k] += model.code[k] * margin > 0
                    rows[k] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int32()), pa.array(rows.astype(np.int64)),
             pa.array(hits.astype(np.int64).tolist(), pa.list_(pa.int64()))], names=["lang", "rows", "hits"])

    return right


def _predict_batches(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                margin = model.margins(text.as_py() or "") if model.languages else None
                if margin is None:
                    out.append((UNKNOWN, 0.0, True))
                else:
                    k, score, close = model.decode(margin)
                    out.append((model.languages[k], score, close))
            lang, score, close = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(close, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return lean(predict)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Classifier from the columns doc_id, text and lang of the learning rows."""
    spark = rows.sparkSession
    usable = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Classifier([], np.zeros((0, BUCKETS)))
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.element_at(F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample_rows / sizes[k]))))),
                        F.col("lang"))
    # one scan for both samples: chance below the rate for the counts, the next stretch of the same length for the weights
    picked = settle(usable.select("text", "lang", chance.alias("_c"), rate.alias("_r")).where(
        F.col("_c") < 2 * F.col("_r")), "language-sample")
    counts = np.zeros((len(languages), BUCKETS))
    learnt = picked.where(F.col("_c") < F.col("_r")).select("text", "lang").mapInArrow(
        _count_batches(languages), "lang int, bucket int, n long")
    for r in learnt.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["lang"], r["bucket"]] = r["n"]
    model = Classifier(languages, counts)
    shared = spark.sparkContext.broadcast(model)
    checked = picked.where((F.col("_c") >= F.col("_r")) | (F.col("_r") >= 1.0)).select("text", "lang").mapInArrow(
        _right_batches(shared), "lang int, rows long, hits array<long>")
    rows_of, hits = np.zeros(len(languages)), np.zeros(model.code.shape)
    for r in checked.groupBy("lang").agg(F.sum("rows").alias("rows"), *(
            F.sum(F.col("hits")[b]).alias(f"h{b}") for b in range(model.code.shape[1]))).collect():
        rows_of[r["lang"]] = r["rows"]
        hits[r["lang"]] = [r[f"h{b}"] for b in range(model.code.shape[1])]
    model.weigh(hits, rows_of)
    return model


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row; learns from the rows that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(rows.where(~held_out()), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _predict_batches(shared), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
