"""SentencePiece BPE encoding by a prefix table, and decoding (operator 3).

For merge-type vocabularies every prefix of a text has one last token. The
table stores it: an automaton finds the pieces that end at each position (a
single character is the last resort), and
a piece is the last token if it is compatible with the last token of the
prefix before it, that is if merging the two side by side leaves them apart.
The ids are then read backwards from the end of the table.

No piece goes over a boundary before a space mark that follows another
character, nor over a character that is in no piece, so such segments are
encoded one by one; frequent segments are remembered within a worker, up to a
fixed number.

Defined results
  null or empty text      no ids; decodes to the empty text
  very long text          processed whole; memory is proportional to one text
  repeated rows, null ids each row is encoded by itself
  empty tables            an empty result
  extra columns           kept but those that start with ``_sp_``; added columns are ``_sp_n``, ``_sp_ids_sha256``, ``_sp_text_sha256``, and with
                          ``ids=True`` ``_sp_ids``
"""

from __future__ import annotations

import re
import struct
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import free_names, lean

SPACE = "▁"
# Types of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHED_SEGMENTS = 300_000
CACHED_CHARS = 64
CACHED_PAIRS = 300_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message in protocol buffer wire format."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, at = varint(at)
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class BpeModel:
    """A BPE model with byte fallback, no normalisation but the space mark and the mark before the text."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        add_dummy, trainer = True, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
                add_dummy = bool(normalizer.get(3, 1))
                if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
                    raise ValueError("only models that keep the text as it is are supported")
        if trainer.get(3) != 2:
            raise ValueError("not a BPE model")
        self.prefix = SPACE if add_dummy else ""
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.scores = {p: s for p, s, kind in self.pieces if kind == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        if len(self.bytes) != 256 or any(kind == USER_DEFINED for _, _, kind in self.pieces):
            raise ValueError("only models with byte fallback and without user-defined pieces are supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes over a word boundary")
        known = {c for p in self.ids for c in p}
        self.segment = re.compile(f"{SPACE}+[{re.escape(''.join(sorted(known - {SPACE})))}]*"
                                  f"|[{re.escape(''.join(sorted(known - {SPACE})))}]+|[^{re.escape(''.join(sorted(known)))}]",
                                  re.DOTALL)
        self.known = known
        self.pairs: dict[int, bool] = {}
        self.segments: dict[str, str] = {}
        self.older: dict[str, str] = {}
        # what an id alone decodes to: pieces, and the bytes that are characters by themselves
        self.surface = {str(i): p.replace(SPACE, " ") for p, i in self.ids.items()}
        self.surface |= {str(i): chr(b) for b, i in self.bytes.items() if b < 0x80}
        self.left: dict[str, list[tuple[str, float]]] = {}
        self.right: dict[str, list[tuple[str, float]]] = {}
        for c in known:
            self._add_spines(c)
        # a piece that its own merging does not give never is a token
        tokens = [p for p in sorted(self.ids, key=len) if len(p) > 1 and self.merge(p) == [p]]
        for p in tokens:
            self._add_spines(p)
        # tokens by number: the characters, then the longer ones
        self.tokens_by_number = sorted(known) + tokens
        self.number = {t: i for i, t in enumerate(self.tokens_by_number)}
        self.sizes = [len(t) for t in self.tokens_by_number]
        self.written = [str(self.ids[t]) if t in self.ids else self._bytes_of(t) for t in self.tokens_by_number]
        self._build_automaton(tokens)

    def _build_automaton(self, tokens: list[str]) -> None:
        """Aho-Corasick automaton: per state its next states, the state to fall back to, and the tokens that end there.

        Single characters match everywhere and stay out. Dictionaries per state, because states of a large
        vocabulary have hundreds of branches, which libraries search one after the other.
        """
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for token in tokens:
            state = 0
            for c in token:
                following = self.next[state].get(c)
                if following is None:
                    following = self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                state = following
            self.ends[state].append((self.number[token], len(token)))
        self.fall = [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            state = queue.popleft()
            for c, following in self.next[state].items():
                queue.append(following)
                back = self.fall[state]
                while back and c not in self.next[back]:
                    back = self.fall[back]
                self.fall[following] = self.next[back].get(c, 0)
                # longest first
                self.ends[following] += self.ends[self.fall[following]]

    def _add_spines(self, piece: str) -> None:
        """What stands at each end of a piece while it is merged: the parts, and the score at which each is used up.

        Only where merging went from better to worse scores, so that the score tells the order.
        """
        if len(piece) == 1:
            self.left[piece] = self.right[piece] = [(piece, float("-inf"))]
            return
        first, second = self.merge(piece, last_step=True)
        score = self.scores[piece]
        if first in self.left and second in self.left and max(map(len, (first, second))) < len(piece) and score < min(
                self.scores.get(first, float("inf")) if len(first) > 1 else float("inf"),
                self.scores.get(second, float("inf")) if len(second) > 1 else float("inf")):
            self.left[piece] = [*self.left[first][:-1], (first, score), (piece, float("-inf"))]
            self.right[piece] = [*self.right[second][:-1], (second, score), (piece, float("-inf"))]

    def merge(self, text: str, last_step: bool = False) -> list[str]:
        """Join the best-scored neighbours, the leftmost of equals, until none make a piece, or until two parts are left."""
        parts = list(text)
        while len(parts) > 1 + last_step:
            score, at = max((self.scores.get(a + b, float("-inf")), -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if score == float("-inf"):
                break
            parts[-at:-at + 2] = [parts[-at] + parts[-at + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay as they are when the text of both is merged.

        Follows the parts next to the boundary from single characters upwards: at each moment the two parts would
        join if that scored better than what uses either of them up (the left of equals goes first).
        """
        if left not in self.right or right not in self.left:
            return self.merge(left + right) == [left, right]
        ours, theirs = self.right[left], self.left[right]
        i = j = 0
        none, scores = float("-inf"), self.scores
        while True:
            (a, next_a), (b, next_b) = ours[i], theirs[j]
            joined = scores.get(a + b, none)
            if joined > next_a and joined >= next_b:
                return False
            if next_a == none and next_b == none:
                return True
            if next_a >= next_b:
                i += 1
            else:
                j += 1

    def tokens(self, segment: str) -> list[int]:
        """Numbers of the tokens of a segment, from its prefix table."""
        pairs, following, fall, ends, number = self.pairs, self.next, self.fall, self.ends, self.number
        if len(pairs) >= CACHED_PAIRS:
            pairs.clear()
        last: list[int] = []
        state, many = 0, len(number)
        for end, c in enumerate(segment):
            to = following[state].get(c)
            while to is None and state:
                state = fall[state]
                to = following[state].get(c)
            state = to or 0
            for piece, size in ends[state]:
                before = end - size
                if before < 0:
                    last.append(piece)
                    break
                pair = last[before] * many + piece
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.apart(self.tokens_by_number[last[before]], self.tokens_by_number[piece])
                if fits:
                    last.append(piece)
                    break
            else:  # where no longer piece is the last token, the character itself is
                last.append(number[c])
        out, at, sizes = [], len(segment) - 1, self.sizes
        while at >= 0:
            out.append(last[at])
            at -= sizes[last[at]]
        out.reverse()
        return out

    def encode_segment(self, segment: str) -> str:
        """Ids of one segment, as decimal numbers joined by commas."""
        got = self.older.get(segment)
        if got is None:
            got = (",".join([self.written[t] for t in self.tokens(segment)]) if segment[0] in self.known
                   else self._bytes_of(segment))
        if len(segment) <= CACHED_CHARS:
            if len(self.segments) >= CACHED_SEGMENTS // 2:
                self.older, self.segments = self.segments, {}
            self.segments[segment] = got
        return got

    def _bytes_of(self, text: str) -> str:
        """Ids of a text's bytes, for characters that are no pieces."""
        return ",".join(str(self.bytes[b]) for b in text.encode())

    def encode_text(self, text: str) -> str:
        """Ids of a text, as decimal numbers joined by commas."""
        if not text:
            return ""
        out, known = [], self.segments.get
        for s in self.segment.findall(self.prefix + text.replace(" ", SPACE)):
            got = known(s)
            if got is None:
                got = self.encode_segment(s)
                known = self.segments.get
            out.append(got)
        return ",".join(out)

    def encode(self, text: str) -> list[int]:
        ids = self.encode_text(text)
        return [int(i) for i in ids.split(",")] if ids else []

    def decode_text(self, ids: str) -> str:
        """``decode`` of ids as ``encode_text`` writes them."""
        if not ids:
            return ""
        numbers = ids.split(",")
        surface = self.surface.get
        try:
            text = "".join([surface(i) for i in numbers])
        except TypeError:  # bytes of longer characters have a surface only together
            return self.decode([int(i) for i in numbers])
        return text[1:] if self.prefix and self.pieces[int(numbers[0])][0].startswith(SPACE) else text

    def decode_pieces(self, ids: list[int] | tuple[int, ...]) -> str:
        """Surface of the ids, space marks as spaces; runs of byte pieces are read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                run.append(int(piece[3:5], 16))
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if kind not in (CONTROL, UNUSED):
                out.append(" ⁇ " if kind == UNKNOWN else piece)
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        text = self.decode_pieces(ids)
        marked = bool(ids) and self.pieces[ids[0]][0].startswith(SPACE)
        return text[1:] if self.prefix and marked else text


def _utf8(data: bytes) -> str:
    """Bytes as text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=4)
def _model(name: str) -> BpeModel:
    with open(SparkFiles.get(name), "rb") as file:
        return BpeModel(file.read())


def _rows(name: str, with_ids: bool):
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(name)
        for texts in batches:
            out = []
            for text in texts:
                ids = model.encode_text(text or "")
                row = (ids.count(",") + 1 if ids else 0, sha256(ids.encode()).hexdigest(),
                       sha256(model.decode_text(ids).encode()).hexdigest())
                out.append((*row, ids) if with_ids else row)
            yield pd.DataFrame(out, columns=["n", "ids_sha256", "text_sha256"] + ["ids"] * with_ids)

    rows = lean(rows, at_once=with_ids)  # rows with ids are large
    rows.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return rows


def encode_documents(docs: DataFrame, model_path: str, ids: bool = False) -> DataFrame:
    """``docs`` with the number of ids and the digests of ids and decoded text, with ``ids`` the ids as well.

    The model file is sent to the workers by Spark; it is read there once per worker.
    """
    context = docs.sparkSession.sparkContext
    context.addFile(model_path)
    name = model_path.rsplit("/", 1)[-1]
    fields = "n long, ids_sha256 string, text_sha256 string" + (", ids string" if ids else "")
    encode = F.pandas_udf(_rows(name, ids), fields)
    found, = free_names(docs, "_sp")
    # ids travel as one text per row: lists of numbers are far larger in a worker
    written = F.when(F.col(f"{found}.n") == 0, F.array().cast("array<int>")).otherwise(
        F.split(f"{found}.ids", ",").cast("array<int>"))
    added = [F.col(f"{found}.n").alias("_sp_n"), F.col(f"{found}.ids_sha256").alias("_sp_ids_sha256"),
             F.col(f"{found}.text_sha256").alias("_sp_text_sha256")] + ([written.alias("_sp_ids")] if ids else [])
    return docs.withColumn(found, encode("text")).select(*(F.col(f"`{c}`") for c in docs.columns if not c.startswith("_sp_")), *added)
