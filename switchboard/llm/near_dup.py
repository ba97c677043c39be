"""Near-duplicate documents by b-bit MinHash (operator 9).

1. One pass over the texts: the distinct five-word shingles as 64-bit hashes,
   an id of the whole set, K minima, and from these the band hashes and a
   signature of the low BITS bits of each minimum, packed into longs.
2. Rows of equal sets become one node (a plain grouping), so a group of
   copies, whatever its size, takes part in the search as one row.
3. Rows of a band bucket are compared with four nodes of the bucket, its hubs,
   by their signatures; the estimate is corrected for chance agreement of the
   low bits. Rows like none of the hubs are compared with each other, in
   blocks of bounded size. Nearby rows form candidate clusters.
4. Inside a cluster the full shingle sets are compared, in blocks of bounded
   size, and only links that join what a block has not yet joined are kept:
   no pair lists, no group in one task. Connected links give the components.

Why no link is lost in step 3: if two texts are as similar as the threshold,
their distances to any third one differ by at most 1 - threshold (Jaccard
distance is a metric). A row is done with a bucket only at an estimate of
LEAVE or more to a hub, and its partner is then above JOIN of the same hub,
with room for the estimate's error.
A pair with similarity s shares no band with probability (1 - s**ROWS)**BANDS,
1e-9 at s = 0.85.

Defined results
  null or empty text, white space only   0 shingles, linked with nothing
  fewer than five words                  the whole sequence as one shingle
  very long text                         processed whole, one text at a time
  repeated rows                          equal sets share a component; rows of one id are judged one by one
  null ids                               null component and kept = true, linked with nothing
  empty tables                           an empty result
  extra columns                          ``keep_one`` returns the columns of its input
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import free_names, lean, mix64, row_key, settle, shingle_codes, split_touched, word_hashes
from switchboard.llm.components import connected_components

SHINGLE = 5
BANDS = 40
ROWS = 6
K = 256          # minima; BANDS * ROWS of them make the bands, all of them the signature
BITS = 2
JOIN, LEAVE = 0.45, 0.80
VERIFY_SLACK = 0.15
BLOCK = 256      # rows of a cluster whose sets are compared at once,
BLOCK_BYTES = 32 << 20  # and bytes of these sets; a larger set is a block's only one but by chance
SIGNATURE_BLOCK = 1024  # rows of a bucket whose signatures are compared at once

_SEED = np.random.default_rng(20240229).integers(0, 2**63, K + ROWS, dtype=np.uint64)
_FACTOR = (_SEED[:K] | np.uint64(1)).astype(np.uint32)
_ORDERS = [0, 0x2C9277B5A1E3D64F, 0x5851F42D4C957F2D, 0x13198A2E03707344]  # four orders of ids: by id XOR constant
_LOW = np.uint64(0x5555555555555555)  # the low bit of every two-bit field
_BAND = (np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32))[:, None]
_ROW = _SEED[K:] | np.uint64(1)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text (A-Z lower-cased)."""
    codes = np.sort(shingle_codes(word_hashes((text or "").encode().lower()), SHINGLE))
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def minima(hashes: np.ndarray) -> np.ndarray:
    """The K smallest values of K hash functions over the set; each mixes the two halves of the shingle hash."""
    high, low = (hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32)
    out = np.full(K, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(hashes), 1024):
        values = _FACTOR[:, None] * high[None, at:at + 1024]
        values += low[None, at:at + 1024]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def signature(mins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes, and the low BITS bits of all minima packed into longs."""
    bands = mins[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = mix64((mix64(bands + _BAND) * _ROW).sum(axis=1, dtype=np.uint64))
    per_long = 64 // BITS
    low = (mins & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, per_long)
    packed = (low << (np.arange(per_long, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    return key.view(np.int64), packed.view(np.int64)


_SIGS = "doc_id long, key long, n_shingles long, set_a long, set_b long, bands array<long>, sig array<long>"


@lean
def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, a, b, bands, sigs = [], [], [], [], []
        for text in batch.column("text"):
            hashes = shingle_hashes(text.as_py())
            n.append(len(hashes))
            if not len(hashes):
                a.append(0), b.append(0), bands.append(None), sigs.append(None)
                continue
            whole = xxhash.xxh3_128_digest(hashes.tobytes())
            a.append(int.from_bytes(whole[:8], "little", signed=True))
            b.append(int.from_bytes(whole[8:], "little", signed=True))
            band, sig = signature(minima(hashes))
            bands.append(band)
            sigs.append(sig)
        long, longs = pa.int64(), pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(n, long), pa.array(a, long), pa.array(b, long),
             pa.array(bands, longs), pa.array(sigs, longs)],
            names=["doc_id", "key", "n_shingles", "set_a", "set_b", "bands", "sig"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: share of equal low-bit groups, less what chance gives."""
    fields = F.lit(int(_LOW))
    differ = F.zip_with(a, b, lambda x, y: F.bit_count(
        (x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1))).bitwiseAND(fields)).cast("long"))
    equal = 1 - F.aggregate(differ, F.lit(0).cast("long"), lambda total, d: total + d) / K
    chance = 2.0 ** -BITS
    return (equal - chance) / (1 - chance)


def _dealt(rows: DataFrame, blocks: str = "blocks") -> DataFrame:
    """Each row once for every pair of blocks of its group that its own block is in: block_a <= block_b, and its side."""
    own = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda other: F.struct(
        F.least(F.col("_own"), other).alias("block_a"), F.greatest(F.col("_own"), other).alias("block_b"),
        (other < F.col("_own")).cast("int").alias("side")))
    rest = [c for c in rows.columns if c != blocks]
    return rows.withColumn("_own", own).select(*rest, F.explode(pairs).alias("_p")).select(*rest, "_p.*")


def _candidate_edges(nodes: DataFrame) -> DataFrame:
    """(u, v) pairs that make candidate clusters connected: estimates of JOIN or more within a band bucket."""
    sigs = nodes.select("node", "sig")
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = settle(rows.groupBy("bucket").agg(
        F.count("*").alias("rows"), *(F.min(F.col("node").bitwiseXOR(F.lit(c))).alias(f"h{k}") for k, c in enumerate(_ORDERS)))
        .where("rows > 1").select("bucket", F.array_distinct(F.array(
            *(F.col(f"h{k}").bitwiseXOR(F.lit(c)) for k, c in enumerate(_ORDERS)))).alias("hubs")), "near-hubs")
    shared = settle(rows.join(hubs, "bucket"), "near-rows")
    pairs = shared.select("node", F.explode("hubs").alias("hub")).where("node != hub").distinct()
    judged = settle(
        pairs.join(sigs.withColumnRenamed("sig", "_a"), "node")
        .join(sigs.select(F.col("node").alias("hub"), F.col("sig").alias("_b")), "hub")
        .select("node", "hub", estimate(F.col("_a"), F.col("_b")).alias("similarity")), "near-judged")
    near = judged.where(F.col("similarity") >= JOIN).select(F.col("node").alias("u"), F.col("hub").alias("v"))
    # rows that no hub of the bucket is like; hubs themselves have met the whole bucket
    left = shared.where(~F.array_contains("hubs", F.col("node"))).select("bucket", "node", F.explode("hubs").alias("hub")).join(
        judged.select("node", "hub", "similarity"), ["node", "hub"]).groupBy("bucket", "node").agg(
        F.max("similarity").alias("most")).where(F.col("most") < LEAVE).select("bucket", "node")
    left = settle(left, "near-left")
    sizes = left.groupBy("bucket").agg(F.ceil(F.count("*") / SIGNATURE_BLOCK).cast("int").alias("blocks"),
                                       F.count("*").alias("rows")).where("rows > 1").drop("rows")
    rest = _dealt(left.join(settle(sizes, "near-left-sizes"), "bucket").join(sigs, "node"), ).groupBy(
        "bucket", "block_a", "block_b").applyInArrow(_similar, "u long, v long")
    return near.unionByName(rest)


def _block_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Node ids, signatures, and the row numbers of both sides of a pair of blocks, which may be one block twice."""
    ids = table.column("node").to_numpy()
    sigs = np.array(table.column("sig").to_pylist(), dtype=np.int64).reshape(len(ids), -1).view(np.uint64)
    side = table.column("side").to_numpy()
    same = table.column("block_a")[0].as_py() == table.column("block_b")[0].as_py()
    rows = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    return ids, sigs, rows, rows if same else np.flatnonzero(side == 1), same


def _guess(sigs: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """``estimate`` of one row against others."""
    x = sigs[others] ^ sigs[one]
    x |= x >> np.uint64(1)
    chance = 2.0 ** -BITS
    return (1 - np.bitwise_count(x & _LOW).sum(axis=1) / K - chance) / (1 - chance)


def _link_table(out: list[tuple[int, int]]) -> pa.Table:
    u, v = zip(*out) if out else ((), ())
    return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_LINK)


def _similar(table: pa.Table) -> pa.Table:
    """Pairs of one pair of blocks with estimates of JOIN or more that join what is not joined yet."""
    ids, sigs, rows, cols, same = _block_pairs(table)
    root, out = np.arange(len(ids)), []
    for i in rows:
        others = cols[cols > i] if same else cols
        others = others[root[others] != root[i]]
        for j in others[_guess(sigs, i, others) >= JOIN]:
            if root[i] != root[j]:
                out.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return _link_table(out)


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _compare(percent: int):
    """Links of one pair of blocks of a cluster that join what is not joined yet."""

    def links(table: pa.Table) -> pa.Table:
        ids, sigs, rows, cols, same = _block_pairs(table)
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("hashes")]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        root, out = np.arange(len(ids)), []
        for i in rows:
            others = cols[cols > i] if same else cols
            others = others[root[others] != root[i]]
            small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
            others = others[100 * small >= percent * large]
            others = others[_guess(sigs, i, others) >= percent / 100 - VERIFY_SLACK]
            for j in others:
                if root[i] == root[j]:
                    continue
                both = np.sort(np.concatenate([sets[i], sets[j]]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (size[i] + size[j] - common):
                    out.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return _link_table(out)

    return links


@lean
def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_hashes(t.as_py()).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("node", "cluster", "blocks", "sig")] + [pa.array(found, pa.binary())],
            names=["node", "cluster", "blocks", "sig", "hashes"])


def _verified_links(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of a cluster, confirmed on full shingle sets, block against block."""
    sized = settle(clusters.join(nodes.drop("bands"), "node"), "near-members")
    sizes = settle(sized.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")), "near-sizes")
    members = sized.join(sizes, "cluster").select("node", "doc_id", "key", "cluster", "blocks", "sig")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    sets = members.join(texts, ["doc_id", "key"]).dropDuplicates(["node"]).select(
        "node", "cluster", "blocks", "sig", "text").mapInArrow(
        _hash_batches, "node long, cluster long, blocks int, sig array<long>, hashes binary")
    return _dealt(sets).groupBy("cluster", "block_a", "block_b").applyInArrow(
        _compare(percent), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept for every row; links need ``percent`` or more similarity."""
    sigs = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
                  .mapInArrow(_signature_batches, _SIGS), "near-sigs")
    usable = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # a set of shingles is a node, named by half its id; the row with the smallest id stands for it
    first = settle(usable.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "key")).alias("f")).select(
        F.col("set_a").alias("node"), "set_b", F.col("f.doc_id").alias("doc_id"), F.col("f.key").alias("key")), "near-first")
    nodes = settle(usable.drop("set_a", "set_b").join(first.drop("set_b"), ["doc_id", "key"]).dropDuplicates(["node"]).select(
        "node", "doc_id", "key", "n_shingles", "bands", "sig"), "near-nodes")
    clusters = connected_components(_candidate_edges(nodes), "u", "v").select(
        "node", F.col("component").alias("cluster"))
    links = settle(_verified_links(docs, nodes, clusters, percent), "near-links")
    components = settle(first.join(connected_components(links, "u", "v"), "node", "left").select(
        F.col("node").alias("set_a"), "set_b", "doc_id", F.coalesce("component", "node").alias("component")), "near-components")
    least = settle(components.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-least")
    by_set = settle(components.drop("doc_id").join(least, "component").select("set_a", "set_b", "component_id"), "near-sets")
    return sigs.join(by_set, ["set_a", "set_b"], "left").select(
        "doc_id", "key", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("_c")).select(
        "doc_id", "key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("_c")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("_c"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that represent their component, with their columns; one of several equal rows with an id."""
    doc_id, key = free_names(docs, "id", "key")
    found = settle(near_duplicates(docs, percent).where("doc_id IS NOT NULL").groupBy(
        F.col("key").alias(key), F.col("doc_id").alias(doc_id)).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        .where("NOT kept OR n > 1"), "near-touched")
    maybe, rest = split_touched(docs, row_key(), found.select(key))
    left = maybe.join(found.where("NOT kept").select(key, doc_id), (F.col("doc_id").cast("long") == F.col(doc_id))
                      & (row_key() == F.col(key)), "left_anti").withColumn(key, row_key())
    one = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", key]).unionByName(left.where("doc_id IS NULL")).drop(key)
    return one.unionByName(rest)
