"""Near-duplicate documents by SimHash and the generalised pigeonhole principle (operator 13).

1. One pass over the texts: XXH64 of every three-word shingle, repeats
   included; a fingerprint bit is 1 if it is set in over half of the hashes.
   Equal fingerprints become one node, so copies are compared once.
2. The 64 bits are dealt to a few partitions. Bits that go together (absolute
   correlation over all nodes) are put into one partition, so that some
   partitions of a frequent pattern are crowded and others are not.
3. If thresholds T_1 .. T_m sum to DISTANCE - m + 1 (-1: the partition is left
   out), two fingerprints within DISTANCE differ in at most T_i bits of some
   partition i. Each node takes the thresholds of its own with the least
   estimated work, by dynamic programming over the partitions: work is the
   values to look up plus the nodes expected there. Expectations come from the
   counts of short blocks of bits over all nodes, and for crowded values from
   exact counts. Where every allocation costs more than looking up all
   fingerprints within DISTANCE, that is done, so no node's work depends on how
   crowded its surroundings are.
4. The values that a node looks up are joined with the partition values of all
   nodes, and pairs are verified on whole fingerprints. Links of nodes, and of
   rows that share an id, are joined to components.

Defined results
  null or empty text, white space only   fingerprint zero, linked like any other
  fewer than three words                 the whole sequence as one shingle
  very long text                         hashed whole, in pieces cut at white space
  repeated rows                          rows of one id are one document; each row has its own fingerprint
  null ids                               no document to be named, but links lead through their texts; null where no id is reached
  empty tables                           an empty result
  extra columns                          are not read
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import lean, settle
from switchboard.llm.components import connected_components

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
SHORT = 8          # bits of a block whose values are counted for the estimate
CROWDED = 256      # nodes of a partition value that are counted exactly
WIDE_NODES = 1 << 24  # nodes from which two wide partitions take the place of three
_CHUNK = 1 << 17
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; ``bytes.split`` cuts at exactly the white space of the rule."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + _CHUNK) if len(data) - at > _CHUNK else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None) -> int:
    """The fingerprint of a text, as an unsigned number."""
    ones, n, words = np.zeros(BITS, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in _pieces((text or "").encode().lower()):
        words = words[1 - SHINGLE:] + piece
        if len(words) >= SHINGLE:
            hashes = np.array([digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))],
                              dtype="<u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(hashes)
    if not n:
        return digest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@lean
def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "fp"])


def _bit_matrix(numbers: np.ndarray) -> np.ndarray:
    return np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


@lean
def _bit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bit is set together with each other one: a row per bit and task."""
    total = np.zeros((BITS, BITS), dtype=np.int64)
    for batch in batches:
        bits = _bit_matrix(batch.column("fp").to_numpy().view(np.uint64)).astype(np.float32)
        for at in range(0, len(bits), 1 << 14):
            part = bits[at:at + (1 << 14)]
            total += (part.T @ part).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int32()), pa.array(list(total), pa.list_(pa.int64()))],
                                     names=["bit", "pairs"])


def group_bits(pairs: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of nearly equal size, correlated ones together.

    ``pairs[i, j]`` counts the nodes that have both bits. A group starts with the free bit that has the strongest
    partner and takes in the bit with the largest sum of absolute correlations to it (ties: the lower bit).
    """
    share = np.diag(pairs) / n
    spread = np.sqrt(share * (1 - share))
    with np.errstate(divide="ignore", invalid="ignore"):
        related = np.abs(np.nan_to_num((pairs / n - np.outer(share, share)) / np.outer(spread, spread), posinf=0, neginf=0))
    np.fill_diagonal(related, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (related[b, free].max(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (related[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def gathered(numbers: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each number, packed from the lowest."""
    out = np.zeros(len(numbers), dtype=np.uint64)
    for place, bit in enumerate(bits):
        out |= ((numbers >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def flips(width: int, most: int) -> np.ndarray:
    """Masks of at most ``most`` of ``width`` bits, fewest first."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(range(width), k)],
                    dtype=np.uint64)


def _short_blocks(groups: list[list[int]]) -> list[tuple[int, list[int]]]:
    """(partition, bits) of the short blocks of all partitions."""
    return [(p, g[at:at + SHORT]) for p, g in enumerate(groups) for at in range(0, len(g), SHORT)]


def _block_counts(groups: list[list[int]]):
    blocks = _short_blocks(groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(blocks), 1 << SHORT), dtype=np.int64)
        for batch in batches:
            numbers = batch.column("fp").to_numpy().view(np.uint64)
            for k, (_, bits) in enumerate(blocks):
                total[k] += np.bincount(gathered(numbers, bits).astype(np.int64), minlength=1 << SHORT)
        block, value = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), pa.array(value.astype(np.int32)),
                                          pa.array(total[block, value])], names=["block", "value", "n"])

    return lean(count)


def near_shares(counts: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Per block, value and d of 0 .. distance: the share of nodes whose value differs in exactly d bits."""
    out = np.zeros((*counts.shape, distance + 1))
    values = np.arange(counts.shape[1], dtype=np.uint64)
    for k in range(len(counts)):
        for d in range(distance + 1):
            for mask in flips(SHORT, d):
                if int(mask).bit_count() == d:
                    out[k, :, d] += counts[k][(values ^ mask).astype(np.int64)]
    return out / max(1, counts[0].sum())


def expected(numbers: np.ndarray, groups: list[list[int]], shares: np.ndarray, n: int) -> np.ndarray:
    """Nodes expected within 0 .. DISTANCE bits in each partition, taking short blocks as independent: [number, partition, t]."""
    depth = shares.shape[2]
    out = np.zeros((len(numbers), len(groups), depth))
    out[:, :, 0] = 1
    for (p, bits), table in zip(_short_blocks(groups), shares):
        own, mixed = table[gathered(numbers, bits).astype(np.int64)], np.zeros((len(numbers), depth))
        for a in range(depth):
            for b in range(depth - a):
                mixed[:, a + b] += out[:, p, a] * own[:, b]
        out[:, p] = mixed
    return np.cumsum(out, axis=2) * n


def allocate(work: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds per partition (-1: left out) with the least total work, and that work.

    ``work[node, partition, t]`` is the work of threshold t. Thresholds plus one sum to distance + 1.
    """
    nodes, parts, _ = work.shape
    units = distance + 1
    least = np.full((nodes, units + 1), np.inf)
    least[:, 0] = 0
    chosen = np.zeros((parts, nodes, units + 1), dtype=np.int8)
    for p in range(parts):
        now = np.full_like(least, np.inf)
        for total in range(units + 1):
            for u in range(total + 1):
                cost = least[:, total - u] + (work[:, p, u - 1] if u else 0)
                better = cost < now[:, total]
                now[better, total] = cost[better]
                chosen[p, better, total] = u
        least = now
    at, out = np.full(nodes, units), np.zeros((nodes, parts), dtype=np.int8)
    for p in reversed(range(parts)):
        out[:, p] = chosen[p, np.arange(nodes), at]
        at = at - out[:, p]
    return out - 1, least[:, units]


_PROBE = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("fp", pa.int64())])


def _rows(part: int, values: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), part, dtype=np.int32)), pa.array(values.view(np.int64)),
                                       pa.array(numbers.view(np.int64))], schema=_PROBE)


def _index(groups: list[list[int]]):
    """The value of each partition of each node; the whole fingerprint is partition number len(groups)."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("fp").to_numpy().view(np.uint64)
            for p, bits in enumerate(groups):
                yield _rows(p, gathered(numbers, bits), numbers)
            yield _rows(len(groups), numbers.copy(), numbers)

    return index


def _probes(groups: list[list[int]], shares: np.ndarray, n: int, distance: int):
    """The values that each node looks up."""
    masks = [[flips(len(g), t) for t in range(distance + 1)] for g in groups]
    whole = flips(BITS, distance)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                numbers = part.column("fp").to_numpy().view(np.uint64)
                near = expected(numbers, groups, shares, n)
                for row, crowded in enumerate(part.column("crowded").to_pylist()):
                    for c in crowded or ():
                        near[row, c["part"]] = np.maximum(near[row, c["part"]], c["near"])
                near += [[len(m) for m in of] for of in masks]
                limits, work = allocate(near, distance)
                alone = work > 2 * len(whole)
                limits[alone] = -1
                for p, of in enumerate(masks):
                    values = gathered(numbers, groups[p])
                    for t, mask in enumerate(of):
                        rows = np.flatnonzero(limits[:, p] == t)
                        if len(rows):
                            yield _rows(p, (values[rows, None] ^ mask).ravel(), np.repeat(numbers[rows], len(mask)))
                for row in np.flatnonzero(alone):
                    yield _rows(len(groups), numbers[row] ^ whole, np.repeat(numbers[row], len(whole)))

    return lean(probe)


def _near_crowded(counts: DataFrame, groups: list[list[int]], distance: int) -> DataFrame:
    """(part, value, near): for values near crowded ones, how many nodes are there within 0 .. distance bits."""
    widths = F.create_map(*(F.lit(x) for p, g in enumerate(groups) for x in (p, len(g))))
    spread = None
    for d in range(distance + 1):
        masks = {len(g): [int(m) for m in flips(len(g), d) if int(m).bit_count() == d] for g in groups}
        for width, own in masks.items():
            some = counts.where(widths[F.col("part")] == width).select(
                "part", "n", F.lit(d).alias("d"), F.explode(F.transform(F.array(*map(F.lit, own)), lambda m: F.col(
                    "value").bitwiseXOR(m.cast("long")))).alias("value"))
            spread = some if spread is None else spread.unionByName(some)
    return spread.groupBy("part", "value").agg(F.array(
        *(F.sum(F.when(F.col("d") <= d, F.col("n")).otherwise(0)).cast("double") for d in range(distance + 1))).alias("near"))


def links(nodes: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """(u, v): all pairs of different fingerprints of ``nodes`` (fp, each once) within ``distance`` bits."""
    spark = nodes.sparkSession
    n = nodes.count()
    if n < 2:
        return spark.createDataFrame([], "u long, v long")
    parts = parts or (3 if n < WIDE_NODES else 2)
    sums = nodes.mapInArrow(_bit_pairs, "bit int, pairs array<long>").groupBy("bit").agg(
        F.array(*(F.sum(F.col("pairs")[k]) for k in range(BITS))).alias("pairs"))
    pairs = np.zeros((BITS, BITS))
    for r in sums.collect():
        pairs[r["bit"]] = r["pairs"]
    groups = group_bits(pairs, n, parts)
    counts = np.zeros((len(_short_blocks(groups)), 1 << SHORT))
    for r in nodes.mapInArrow(_block_counts(groups), "block int, value int, n long").groupBy("block", "value").agg(
            F.sum("n").alias("n")).collect():  # at most 256 values of 9 blocks
        counts[r["block"], r["value"]] = r["n"]
    schema = "part int, value long, fp long"
    index = settle(nodes.mapInArrow(_index(groups), schema), "simhash-index")
    crowded = settle(index.where(F.col("part") < parts).groupBy("part", "value").agg(F.count("*").alias("n"))
                     .where(F.col("n") >= CROWDED), "simhash-crowded")
    if crowded.isEmpty():
        known = nodes.select("fp", F.lit(None).cast("array<struct<part:int,near:array<double>>>").alias("crowded"))
    else:
        near = settle(_near_crowded(crowded, groups, distance), "simhash-near")
        around = index.join(near, ["part", "value"]).groupBy("fp").agg(
            F.collect_list(F.struct("part", "near")).alias("crowded"))  # a row per partition at most
        known = nodes.join(around, "fp", "left").select("fp", "crowded")
    probes = settle(known.mapInArrow(_probes(groups, near_shares(counts, distance), n, distance), schema), "simhash-probes")
    if probes.where(F.col("part") == parts).isEmpty():
        index = index.where(F.col("part") < parts)
    other = index.withColumnRenamed("fp", "v")
    return probes.withColumnRenamed("fp", "u").join(other, ["part", "value"]).where(
        (F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)).select("u", "v")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and component_id of every row."""
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprint_batches, "doc_id long, fp long"), "simhash-rows")
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    by_id = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("u"), F.max("fp").alias("_last")).where(
        F.col("u") != F.col("_last")).drop("_last")
    shared = rows.join(by_id, "doc_id").select("u", F.col("fp").alias("v")).where("u != v")
    found = settle(links(nodes.select("fp"), distance).unionByName(shared), "simhash-links")
    grouped = settle(nodes.join(connected_components(found, "u", "v").withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("component", "fp").alias("component")), "simhash-grouped")
    least = settle(grouped.groupBy("component").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    named = settle(grouped.join(least, "component").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
