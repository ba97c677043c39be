"""Merkle manifest of a dataset as a postorder append log (operator 11).

Every language has a tree of fan-out ORDER over its leaves in the order of
doc_id; the subroots, in the order of the language, have a tree of their own.

1. Leaf digests take one pass over the texts; only digests are shuffled.
   Leaves get their place in the tree by ``numbered`` (dealt out by ranges).
2. Aligned builders: each takes ORDER ** LEVELS neighbouring leaves of a tree
   and appends nodes in the order in which they are complete: a leaf, then
   every run that ends with it. The builders' tops are the leaves of the next
   round, until one node of a tree is left, so no task sees more than one
   aligned block and a tree of any size takes few rounds.
3. The place of a node in the postorder log follows from its level, its index
   and the number of leaves alone (``position``): the nodes that lie to its
   left, or below it, are complete before it, and their number per level is a
   division. Proofs address the siblings of a leaf by these places: within a
   block from the block's own segment of the log, above it by the path of the
   block's top, which all its leaves share.

Defined results
  null text, lang, ...   the field is ``-``; null lang is a language of its own, the first one
  null ids               come first in their language, and are never tampered with
  very long text         hashed whole, on the JVM
  repeated rows          leaves of their own; equal ids are ordered by leaf, and equal rows are interchangeable
  empty tables           an empty result
  extra columns          are not read
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import settle
from switchboard.llm.sharding import numbered

ORDER = 8
LEVELS = 4  # levels of a builder's block: 4,096 leaves
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:binary,after:binary>>"


def joined(digests: list[bytes]) -> bytes:
    """H of digests, which go in as hex text."""
    return sha256(b"".join(digests).hex().encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n = -(-n // ORDER)
        levels += 1
    return levels


def position(level: int, index: np.ndarray, n: int, levels: int) -> np.ndarray:
    """Place of nodes of one level in the postorder log of a tree of n leaves and ``levels`` levels."""
    end = np.minimum((index + 1) * ORDER**level, n)
    below = sum(-(-end // ORDER**k) for k in range(level + 1))
    return below + sum((index // ORDER ** (k - level) for k in range(level + 1, levels + 1)), np.zeros_like(index)) - 1


_LOG = ("tree long, n long, block long, position long, level int, index long, digest binary")
_LOG_ARROW = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("block", pa.int64()), ("position", pa.int64()),
                        ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.binary())])


def _builder(base: int, deep: int):
    """Appends the nodes of one aligned block of ``deep`` levels, whose leaves are the tree's nodes of level ``base``."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        tree, n, block = (table.column(c)[0].as_py() for c in ("tree", "n", "block"))
        levels = height(n)
        top = min(deep, levels - base)
        pending: list[list[bytes]] = [[] for _ in range(top + 1)]
        done = [block * ORDER ** (deep - k) for k in range(top + 1)]
        log = []
        last = table.num_rows - 1
        for i, digest in enumerate(table.column("digest").to_pylist()):
            level = 0
            while True:
                pending[level].append(digest)
                log.append((level, done[level], digest))
                done[level] += 1
                if level == top or len(pending[level]) < ORDER and i < last:
                    break
                digest, pending[level] = joined(pending[level]), []
                level += 1
        at, index = (np.array(x, dtype=np.int64) for x in list(zip(*log))[:2])
        places = np.zeros(len(log), dtype=np.int64)
        for k in range(top + 1):
            places[at == k] = position(base + k, index[at == k], n, levels)
        same = np.ones(len(log), dtype=np.int64)
        return pa.Table.from_arrays(
            [pa.array(same * tree), pa.array(same * n), pa.array(same * block), pa.array(places),
             pa.array((at + base).astype(np.int32)), pa.array(index), pa.array([x[2] for x in log], pa.binary())],
            schema=_LOG_ARROW)

    return build


def build_log(leaves: DataFrame) -> list[DataFrame]:
    """Segments of the log, one table per round, from ``leaves`` (tree, n, index, digest): n is the tree's leaf count.

    A segment has the nodes of its round in the blocks that built them, and first the block's leaves, which for later
    rounds are the tops of the round before.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    segments, base = [], 0
    while not segments or base < height(most):
        blocks = leaves.withColumn("block", (F.col("index") / ORDER**LEVELS).cast("long"))
        segments.append(settle(blocks.groupBy("tree", "block").applyInArrow(_builder(base, LEVELS), _LOG), "merkle-log"))
        base += LEVELS
        # a tree is done when a round has left one node
        leaves = segments[-1].where((F.col("level") == base) & (F.col("n") > ORDER**base)).select("tree", "n", "index", "digest")
    return segments


def whole_log(segments: list[DataFrame]) -> DataFrame:
    """The log of all trees: tree, position, level, index, digest; each node once."""
    parts = [s.where(F.col("level") > LEVELS * k) if k else s for k, s in enumerate(segments)]
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log.select("tree", "position", "level", "index", "digest")


def tops(segments: list[DataFrame]) -> DataFrame:
    """(tree, n, digest): the root of each tree."""
    found = None
    for k, s in enumerate(segments):
        low = ORDER ** (LEVELS * k)
        own = s.where((F.col("index") == 0) & (F.col("n") > (low if k else 0)) & (F.col("n") <= low * ORDER**LEVELS)).groupBy(
            "tree", "n").agg(F.max_by("digest", "level").alias("digest"))
        found = own if found is None else found.unionByName(own)
    return found


def _steps(segment: pa.Table, base: int, deep: int) -> list[tuple[int, list[bytes]]]:
    """Per level of a block below its top: the first index, and the digests, addressed by their places in the log."""
    tree_n, block = segment.column("n")[0].as_py(), segment.column("block")[0].as_py()
    levels = height(tree_n)
    places = segment.column("position").to_numpy()
    order = np.argsort(places)
    digests = segment.column("digest")
    out = []
    for k in range(min(deep, levels - base) + 1):
        first = block * ORDER ** (deep - k)
        in_level = -(-tree_n // ORDER ** (base + k))
        index = np.arange(first, min(first + ORDER ** (deep - k), in_level))
        at = order[np.searchsorted(places[order], position(base + k, index, tree_n, levels))]
        out.append((first, digests.take(pa.array(at)).to_pylist()))
    return out


def _path(steps: list[tuple[int, list[bytes]]], index: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Siblings to the left and to the right of a leaf's ancestors, level by level below the block's top."""
    for first, digests in steps[:-1]:
        run = index // ORDER * ORDER - first
        own = index - first
        yield digests[run:own], digests[own + 1:run + ORDER]
        index //= ORDER


def _split(key_table: pa.Table) -> tuple[pa.Table, dict]:
    """The nodes of a block's segment, and the row that tells what lies above the block."""
    above = key_table.column("level").to_numpy() < 0
    row = key_table.filter(pa.array(above)).to_pylist()[0]
    return key_table.filter(pa.array(~above)), row


_ABOVE = f"tree long, block long, path {_PATH}, subroot binary, root binary"


def _with_above(segment: DataFrame, above: DataFrame) -> DataFrame:
    """A segment, and one more row per block (level -1) with what lies above it."""
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("path", _PATH), ("subroot", "binary"), ("root", "binary"))]
    return segment.select("tree", "block", "n", "position", "level", "index", "digest", *nothing).unionByName(above.select(
        "tree", "block", F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("position"),
        F.lit(-1).alias("level"), F.lit(0).cast("long").alias("index"), F.lit(None).cast("binary").alias("digest"),
        "path", "subroot", "root"))


def _paths(base: int, deep: int):
    """Path of every leaf of a block up to the root."""

    def paths(table: pa.Table) -> pa.Table:
        nodes, above = _split(table)
        steps, tree = _steps(nodes, base, deep), above["tree"]
        first, digests = steps[0]
        rows = [{"tree": tree, "block": i, "path": [{"before": b"".join(b), "after": b"".join(a)} for b, a in _path(
            steps, i)] + above["path"], "subroot": above["subroot"], "root": above["root"]}
            for i in range(first, first + len(digests))]
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("tree", pa.int64()), ("block", pa.int64()),
            ("path", pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))),
            ("subroot", pa.binary()), ("root", pa.binary())]))

    return paths


def descend(segments: list[DataFrame], above: DataFrame) -> DataFrame:
    """What lies above each block of the first round, from what lies above each tree (``above``: tree, path, subroot, root).

    The leaves of a round's block are the tops of the blocks of the round before, so each round hands its paths down.
    """
    known = None
    for k in reversed(range(len(segments))):
        low = ORDER ** (LEVELS * k)
        # trees whose last round this is have one block here
        own = segments[k].where((F.col("index") == 0) & (F.col("level") == LEVELS * k) & (F.col("n") <= low * ORDER**LEVELS)
                                ).select("tree").join(above, "tree").select(
            "tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        known = own if known is None else known.unionByName(own)
        if k:
            known = settle(_with_above(segments[k], known).groupBy("tree", "block").applyInArrow(
                _paths(LEVELS * k, LEVELS), _ABOVE), "merkle-above")
    return settle(known, "merkle-above")


_HEX = [("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
        ("folded_root", pa.string()), ("verified", pa.bool_())]


def _verify(deep: int):
    """Proof of every leaf of a block, folded from the tampered leaf where there is one."""

    def verified(leaves: pa.Table, segment: pa.Table) -> pa.Table:
        nodes, above = _split(segment)
        steps = _steps(nodes, 0, deep)
        top = steps[-1][1][0]
        upper = [(p["before"], p["after"]) for p in above["path"]]
        upper_text = b"".join(b + a for b, a in upper).hex().encode()
        folded_tops: dict[bytes, bytes] = {}

        def fold_up(node: bytes) -> bytes:
            if node not in folded_tops:
                at = node
                for b, a in upper:
                    at = joined([b, at, a])
                if node != top:  # kept for the block's own top only
                    return at
                folded_tops[node] = at
            return folded_tops[node]

        out = []
        for index, leaf, tampered in zip(*(leaves.column(c).to_pylist() for c in ("index", "leaf", "tampered"))):
            node, proof = leaf if tampered is None else tampered, sha256()
            for before, after in _path(steps, index):
                proof.update(b"".join(before + after).hex().encode())
                node = joined([*before, node, *after])
            proof.update(upper_text)
            folded = fold_up(node)
            out.append((leaf.hex(), above["subroot"].hex(), above["root"].hex(), proof.hexdigest(), folded.hex(),
                        folded == above["root"]))
        columns = list(zip(*out))
        return pa.Table.from_arrays([leaves.column("doc_id")] + [pa.array(c, t) for c, (_, t) in zip(columns, _HEX)],
                                    schema=pa.schema([("doc_id", pa.int64()), *_HEX]))

    return verified


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and, for tampered documents, the leaf of the changed text."""
    def leaf(text: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*(_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), _field(text)), 256))

    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf(F.col("text")).alias("leaf"),
                       F.when(changed, leaf(F.translate("text", _UPPER, _LOWER))).alias("tampered"))


def manifest(docs: DataFrame) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """The leaves with their places, the log segments of the languages' trees and those of the tree above them.

    A tree's number is that of its first leaf among all leaves, so that trees are ordered like their languages.
    """
    rows = settle(numbered(settle(leaf_digests(docs), "merkle-leaves"), ["lang", "doc_id", "leaf"]), "merkle-numbered")
    trees = settle(rows.groupBy(F.col("lang").alias("_lang")).agg(F.min("number").alias("tree"), F.count("*").alias("n")), "merkle-trees")
    placed = settle(rows.join(trees, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "doc_id", "leaf", "tampered", "tree", "n", (F.col("number") - F.col("tree")).alias("index")), "merkle-placed")
    segments = build_log(placed.select("tree", "n", "index", F.col("leaf").alias("digest")))
    subroots = settle(tops(segments), "merkle-subroots")
    n = subroots.count()
    ranked = settle(numbered(subroots.select(F.col("tree").alias("of"), "digest"), ["of"]).select(
        F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("number").alias("index"), "digest", "of"), "merkle-ranked")
    return placed, segments, [ranked, *build_log(ranked.drop("of"))]


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row."""
    spark = docs.sparkSession
    placed, segments, (ranked, *crown) = manifest(docs)
    root = [r["digest"] for r in tops(crown).collect()]  # one row
    if not root:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    start = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.array().cast(_PATH).alias("path"),
                                  F.lit(root[0]).alias("subroot"), F.lit(root[0]).alias("root"))
    by_rank = _with_above(crown[0], descend(crown, start)).groupBy("tree", "block").applyInArrow(_paths(0, LEVELS), _ABOVE)
    above = settle(by_rank.select(F.col("block").alias("index"), "path", "root").join(ranked, "index").select(
        F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "merkle-subroot-paths")
    blocks = _with_above(segments[0], descend(segments, above))
    leaves = placed.select("tree", (F.col("index") / ORDER**LEVELS).cast("long").alias("block"), "index", "doc_id", "leaf", "tampered")
    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _verify(LEVELS), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
