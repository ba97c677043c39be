"""Secrets in texts: fixed patterns, and long tokens that a randomness test battery finds random (operator 7).

Patterns (``assign``, ``access``, ``hex``) always count. The battery tests
what they leave of every other token, in pieces of MIN_TOKEN or more
characters (not of digits only: nothing in a run of digits tells a secret
from a number). From the characters used follows the encoding and its
alphabet, and against independent uniform characters of that alphabet come a
chi-squared test of the character counts, a runs test around the alphabet's
middle, and the serial correlation; Fisher's method combines the three. A
secret is a token for which this does not look unlikely.

How often ordinary text looks as random as that depends on its length and on
whether it mixes cases, digits and signs. The null sample is made of the
corpus's own words: in every document, words that stand together are joined
in four ways (plainly, with hyphens, as a path, in camel case), and each
joined text is cut whole into pieces of the length, once for every length
class; where it does not come out even, the last piece ends with the text. No
character is left out, unless the text is shorter than the class. So every
length has a large null however rare long words are, and the least p-value is
far below what the false-discovery step asks for. Tokens of letters
of one case and all others are two families with a null each. Among the
others the share of all null pieces of a length class that have a token's
encoding and are at least as random is its p-value: words joined in some way
seldom have the encoding of hexadecimal or of mixed digits at all. Pieces have
the least length of their class, which errs to the ordinary side. The
Benjamini-Hochberg step, for each encoding against all tested tokens of the
family, keeps the expected share of ordinary tokens among the finds at FDR.
All counts come from the whole corpus; only histograms (family and encoding
by length class by randomness) reach the driver.

Defined results
  null or empty text      no spans
  very long text          scanned whole; a token is tested whole
  ties                    tokens of one histogram cell are found together or not at all
  repeated rows, null ids each row has its own spans; its tokens count in the statistics
  empty tables            an empty result
  extra columns           are not read
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import lean, row_key, settle

KINDS = ["assign", "access", "hex", "random"]
MIN_TOKEN = 16
FDR = 0.01
CELLS = 400                      # randomness in steps of a hundredth of a decade, down to 1e-4
LENGTHS = [16, 18, 20, 24, 28, 32, 40, 64, 96]
MIN_NULL = 200                   # pieces a length class needs for a null of its own; else shorter ones join in
LONGEST_WORD = 40                # letters; keys of lower-case letters beyond it are not among the words they are held against
PIECES = 8192                    # null pieces tested at once
AT_ONCE = 4_000_000              # characters of texts whose pieces are cut at once (a longer text by itself)

# The base patterns.
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
_WORD = re.compile(rb"[A-Z]?[a-z]+")
_APART = bytes(c if chr(c).isascii() and chr(c).isalnum() else 32 for c in range(256))

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ENCODINGS = [_DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER + "234567", _DIGITS + _LOWER,
              _DIGITS + _UPPER, _UPPER + _LOWER, _UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "+/",
              _UPPER + _LOWER + _DIGITS + "-_", _UPPER + _LOWER + _DIGITS + "+/-_="]
_SETS = [frozenset(e) for e in _ENCODINGS]
_INDEX = [{c: i for i, c in enumerate(e)} for e in _ENCODINGS]


# By character code: the encodings that hold the character, as bits (low and high byte); and its place in each of them.
_HOLDS = [sum(1 << i for i, chars in enumerate(_SETS) if chr(c) in chars) for c in range(256)]
_HOLDS_BYTES = [bytes(h >> shift & 255 for h in _HOLDS) for shift in (0, 8)]
_PLACE = [bytes(places.get(chr(c), 0) for c in range(256)) for places in _INDEX]
_FIRST = np.array([(h & -h).bit_length() - 1 if h else 0 for h in range(1 << len(_SETS))])
_IS_DIGITS, _IS_LOWER = 1 << _ENCODINGS.index(_DIGITS), 1 << _ENCODINGS.index(_LOWER)
_TABLE_ROWS = 64                 # rows from which on a test's values are looked up
_erfc = np.frompyfunc(math.erfc, 1, 1)


def _held(text: bytes) -> np.ndarray:
    """Of each character the encodings that hold it, as bits."""
    low, high = (np.frombuffer(text.translate(t), dtype=np.uint8) for t in _HOLDS_BYTES)
    return low | high.astype(np.uint16) << 8


def _normal_tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2)).astype(float)


def _chi2_tail(x: np.ndarray, k: int) -> np.ndarray:
    """Upper tail of the chi-squared distribution (Wilson-Hilferty)."""
    return _normal_tail((np.cbrt(np.maximum(x, 0) / k) - (1 - 2 / (9 * k))) / np.sqrt(2 / (9 * k)))


def _nats(p: np.ndarray) -> np.ndarray:
    return -np.log(np.clip(p, 1e-30, 1.0))


def _constant(n: int) -> float:
    """Chance of n characters all alike, or all in one half of the alphabet."""
    return 2.0 ** max(1 - n, -1000)


def _uniform_nats(squares: np.ndarray, n: int, size: int) -> np.ndarray:
    """Chi-squared test of n characters, from the sum of their squared counts."""
    return _nats(_chi2_tail(size / n * squares - n, size - 1))


def _run_nats(ups: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    expected = 1 + 2 * ups * (n - ups) / n
    variance = np.maximum(1e-9, (expected - 1) * (expected - 2) / (n - 1))
    return _nats(np.where((ups > 0) & (ups < n),
                          2 * _normal_tail(np.maximum(0.0, np.abs(runs - expected) - 0.5) / np.sqrt(variance)), _constant(n)))


@lru_cache(maxsize=None)
def _uniform_table(n: int, size: int) -> np.ndarray:
    return _uniform_nats(np.arange(n * n + 1.0), n, size)


@lru_cache(maxsize=None)
def _run_table(n: int) -> np.ndarray:
    at = np.arange(n + 1.0)
    return _run_nats(np.repeat(at, n + 1), np.tile(at, n + 1), n)


_FINE = 1000                     # serial correlation: steps per standard deviation between which is interpolated
_SERIAL = _nats(2 * _normal_tail(np.arange(12 * _FINE + 2) / _FINE))


def _serial_nats(z: np.ndarray) -> np.ndarray:
    at = np.minimum(z, 12.0) * _FINE
    low = at.astype(np.int64)
    return _SERIAL[low] + (at - low) * (_SERIAL[low + 1] - _SERIAL[low])


def _tests_nats(at: np.ndarray, size: int) -> np.ndarray:
    """Half of Fisher's statistic, from the characters' places in an alphabet (a column a row of characters)."""
    n, m = at.shape
    many = m >= _TABLE_ROWS and n < 256
    if many:        # squared counts add up to n and twice the pairs of equal characters
        squares = np.full(m, n, dtype=np.int64)
        for d in range(1, n):
            squares += 2 * np.add.reduce((at[d:] == at[:-d]).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64)
    else:
        counts = np.bincount((at + np.arange(0, m * size, size)).ravel(), minlength=m * size).reshape(m, size)
        squares = np.einsum("ij,ij->i", counts, counts)
    high = at >= size / 2
    wide = np.uint8 if n < 256 else np.int64
    ups = np.add.reduce(high.view(np.uint8), axis=0, dtype=wide).astype(np.int64)
    runs = 1 + np.add.reduce((high[1:] != high[:-1]).view(np.uint8), axis=0, dtype=wide).astype(np.int64)
    if many:
        half = _uniform_table(n, size)[squares] + _run_table(n)[ups * (n + 1) + runs]
    else:
        half = _uniform_nats(squares, n, size) + _run_nats(ups, runs, n)
    # sums of whole numbers, exact in single precision up to 256 characters
    x = at.astype(np.float32 if n < 256 else float)
    total = np.add.reduce(x, axis=0).astype(float)
    power = n * np.einsum("ij,ij->j", x, x).astype(float) - total ** 2
    neighbours = np.einsum("ij,ij->j", x[1:], x[:-1]).astype(float)
    lag = n * n * neighbours - n * total * (2 * total - x[0] - x[-1]) + (n - 1) * total ** 2
    z = np.abs(lag) / np.where(power > 0, n * power, 1.0) * math.sqrt(n)
    return half + np.where(power > 0, _serial_nats(z), float(_nats(np.array(_constant(n)))))


def _combined(half: np.ndarray) -> np.ndarray:
    return np.exp(-half) * (1 + half + half ** 2 / 2)


def battery(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combined p-value of the tests, and the encoding, of each row of character codes (rows of one length, of 2 or more characters).

    The encoding is the first that holds them all. The p-value is 0 for rows
    with characters of no encoding.
    """
    codes = np.ascontiguousarray(codes, dtype=np.uint8)
    holds = np.bitwise_and.reduce(_held(codes.tobytes()).reshape(codes.shape), axis=1)
    which, p = _FIRST[holds], np.zeros(len(codes))
    for w in np.unique(which[holds > 0]):
        mine = np.flatnonzero((which == w) & (holds > 0))
        places = np.frombuffer(codes[mine].tobytes().translate(_PLACE[w]), dtype=np.uint8).reshape(len(mine), -1)
        p[mine] = _combined(_tests_nats(np.ascontiguousarray(places.T), len(_ENCODINGS[w])))
    return p, which


def judged(token: str) -> tuple[float, int]:
    """Combined p-value of the battery, and the encoding, of one token."""
    body = token.rstrip("=") or token
    if len(body) < 2 or not body.isascii():
        return 0.0, 0
    p, which = battery(np.frombuffer(body.encode(), dtype=np.uint8)[None, :])
    return float(p[0]), int(which[0])


def randomness(token: str) -> float:
    """Combined p-value of the battery: small where the token is unlike random characters of its encoding."""
    return judged(token)[0]


# Slot 0: letters of one case (or one capital in front), whatever their encoding; slot 1 + i: all others, of encoding i.
SLOTS = 1 + len(_ENCODINGS)


def one_case(token: str) -> bool:
    return token.isalpha() and (token[1:].islower() or token.isupper())


def joined_words(text: str) -> list[bytes]:
    """The words of a text joined in the four ways that ordinary long tokens are.

    Long runs that are not plain letters, or too long for a word, may be secrets and are left out.
    """
    words = text.encode("ascii", "replace").translate(_APART).split()
    if words and len(max(words, key=len)) >= MIN_TOKEN:
        words = [w for w in words if len(w) < MIN_TOKEN or len(w) <= LONGEST_WORD and _WORD.fullmatch(w)]
    joined = b"-".join(words)
    low = joined.lower()
    return [low.replace(b"-", b""), joined, low.replace(b"-", b"/"), joined.title().replace(b"-", b"")]


def piece_starts(begins: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Starts of the pieces that streams (from begin to end) are cut into: no character of a stream that is long enough is left out."""
    fits = ends - begins >= length
    begins, ends = begins[fits], ends[fits]
    n = -(-(ends - begins) // length)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.minimum(np.repeat(begins, n) + nth * length, np.repeat(ends - length, n))


def _count_pieces(streams: list[bytes], out: np.ndarray) -> None:
    ends = np.cumsum([len(s) for s in streams], dtype=np.int64)
    begins = ends - [len(s) for s in streams]
    text = b"".join(streams)
    held, span = _held(text), 1             # the encodings of all ``span`` characters from each on
    planes: dict[int, np.ndarray] = {}
    for k, length in enumerate(LENGTHS):
        starts = piece_starts(begins, ends, length)
        while 2 * span <= length and 2 * span <= len(text):
            held, span = held[:-span] & held[span:], 2 * span
        holds = held[starts] & held[starts + length - span]
        starts, holds = starts[holds & _IS_DIGITS == 0], holds[holds & _IS_DIGITS == 0]
        which = _FIRST[holds]
        slot = np.where(holds & _IS_LOWER, 0, 1 + which)
        for w in np.flatnonzero(np.bincount(which, minlength=1)):
            if w not in planes:
                planes[w] = np.frombuffer(text.translate(_PLACE[w]), dtype=np.uint8)
            rows = np.lib.stride_tricks.sliding_window_view(planes[w], length)
            mine = np.flatnonzero(which == w)
            for first in range(0, len(mine), PIECES):
                some = mine[first:first + PIECES]
                p = _combined(_tests_nats(np.ascontiguousarray(rows[starts[some]].T), len(_ENCODINGS[w])))
                out[:, k] += np.bincount(slot[some] * CELLS + cells(p), minlength=SLOTS * CELLS).reshape(SLOTS, CELLS)


def null_counts(texts: list[str]) -> np.ndarray:
    """All pieces of joined words by slot, length class and cell."""
    out = np.zeros((SLOTS, len(LENGTHS), CELLS), dtype=np.int64)
    some, size = [], 0
    for i, text in enumerate(texts):
        some.append(joined_words(text))
        size += len(text)
        if size >= AT_ONCE or i == len(texts) - 1:
            for streams in zip(*some):
                _count_pieces(streams, out)
            some, size = [], 0
    return out


def base_spans(text: str, tokens: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns. Access ids and hex runs lie inside long tokens."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS) or not text.isascii():
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    for token in tokens:
        for kind, pattern in ((1, _ACCESS), (2, _HEX)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, token.start(), token.end())]
    return sorted(found)


def length_class(n: int) -> int:
    return sum(n >= low for low in LENGTHS) - 1


def cells(p: np.ndarray) -> np.ndarray:
    """0 for the most random tokens; CELLS - 1 for all below 1e-4."""
    return np.minimum(CELLS - 1, (-100 * np.log10(np.clip(p, 1e-30, 1.0))).astype(int))


def cell(p: float) -> int:
    return int(cells(np.array(p)))


def left_of(start: int, end: int, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What base spans leave of a token: pieces of MIN_TOKEN or more characters."""
    for s, _, e in taken:
        if s < end and start < e:
            if s - start >= MIN_TOKEN:
                yield start, s
            start = max(start, e)
    if end - start >= MIN_TOKEN:
        yield start, end


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_TEST = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("slot", pa.int32()), ("length", pa.int32()), ("cell", pa.int32())])
_NULL = pa.struct([("slot", pa.int32()), ("length", pa.int32()), ("cell", pa.int32()), ("n", pa.int64())])
_SCANNED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("base", pa.list_(_SPAN)), ("tested", pa.list_(_TEST)),
                      ("words", pa.list_(_NULL))])
_SCANNED_SQL = ("doc_id long, key long, base array<struct<start:int,kind:int,end:int>>, "
                "tested array<struct<start:int,end:int,slot:int,length:int,cell:int>>, "
                "words array<struct<slot:int,length:int,cell:int,n:long>>")


def tested_tokens(text: str, tokens: list[re.Match], base: list[tuple[int, int, int]]) -> list[dict]:
    out = []
    for t in tokens:
        for start, end in left_of(t.start(), t.end(), base):
            piece = text[start:end]
            if not piece.isdigit():
                letters = one_case(piece)
                # a capital in front of a word is no sign of an alphabet with both cases
                p, which = judged(piece.lower() if letters else piece)
                out.append({"start": start, "end": end, "slot": 0 if letters else 1 + which, "length": length_class(end - start),
                            "cell": cell(p)})
    return out


@lean
def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text.as_py() or "" for text in batch.column("text")]
        bases, tests = [], []
        for text in texts:
            tokens = list(_TOKEN.finditer(text))
            base = base_spans(text, tokens)
            bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
            tests.append(tested_tokens(text, tokens, base))
        # the counts of a batch go with its first row; only their sum over all rows is used
        counts = null_counts(texts)
        words = [[{"slot": s, "length": k, "cell": c, "n": counts[s, k, c]} for s, k, c in np.argwhere(counts)]
                 if not i else [] for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(bases, pa.list_(_SPAN)), pa.array(tests, pa.list_(_TEST)),
             pa.array(words, pa.list_(_NULL))], schema=_SCANNED)


def found_cells(words: np.ndarray, tested: np.ndarray, fdr: float = FDR) -> list[int]:
    """Per length class, how many of the most random cells are finds (Benjamini-Hochberg over all tested tokens).

    ``words`` and ``tested`` count null pieces and tokens of a family by length
    class and cell. With an encoding in front (three axes) the classes of
    every encoding come one after the other. Where ``share`` of all ordinary
    tokens would be finds, ``share * tested`` of the finds are expected to be
    ordinary; that holds for each encoding, so it holds for all together.
    """
    null, count = (a if a.ndim == 3 else a[None] for a in (words, tested))
    share = np.ones(count.shape)
    for k in range(count.shape[1]):
        pieces, low = null[:, k].copy(), k
        while pieces.sum() < MIN_NULL and low:
            low -= 1
            pieces += null[:, low]
        share[:, k] = (np.cumsum(pieces, axis=1) + 1) / (pieces.sum() + 1)
    out = []
    for p, n in zip(share, count):
        order = np.argsort(p, axis=None, kind="stable")
        passes = p.ravel()[order] <= fdr * np.cumsum(n.ravel()[order]) / max(1, count.sum())
        limit = p.ravel()[order][passes][-1] if passes.any() else -1.0
        out += [int((row <= limit).sum()) for row in p]
    return out


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, key, base and spans (arrays of start, kind, end in the order of start and kind) of every row."""
    found = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text").mapInArrow(
        _scan_batches, _SCANNED_SQL), "secrets-scanned")
    tables = []
    for column, n in (("words", F.sum("t.n")), ("tested", F.count(F.lit(1)))):
        counts = np.zeros((SLOTS, len(LENGTHS), CELLS), dtype=np.int64)
        for r in found.select(F.explode(column).alias("t")).groupBy("t.slot", "t.length", "t.cell").agg(n.alias("n")).collect():
            counts[r["slot"], r["length"], r["cell"]] = r["n"]
        tables.append(counts)
    words, tested = tables
    limits = F.array(*(F.lit(n) for n in found_cells(words[0], tested[0], fdr) + found_cells(words[1:], tested[1:], fdr)))
    found_at = lambda t: F.element_at(limits, t["slot"] * len(LENGTHS) + t["length"] + 1)
    random = F.transform(F.filter("tested", lambda t: t["cell"] < found_at(t)), lambda t: F.struct(
        t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    return found.select("doc_id", "key", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def spans_text(spans: str):
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
