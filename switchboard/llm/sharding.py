"""Reproducible shuffle into shards by a Feistel permutation of row numbers (operator 5), in DataFrame functions only.

Rows get global numbers 0 .. n-1 in the order of their id (ties: checksum and
size). A Feistel network over the pairs (number div b, number mod b) permutes
0 .. a*b-1, where a*b is at least n; a result of n or more is permuted again
(cycle walking) until it is below n. Place p of the shuffle lies in shard
p mod shards at slot p div shards, so shard and slot of a row follow from its
number, n and the seed alone, and shard sizes differ by one row at most.

Global numbers take one pass over (id, size, checksum) of a table dealt out by
ranges: counts per range, their running sum, and a row number inside the range.
The only single task sums one count per range.

Defined results
  null text        no bytes: size 8, checksum 0
  null ids         come first in the order
  repeated rows    get places of their own; equal rows are interchangeable
  empty tables     an empty result
  extra columns    are not read
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchboard.llm.common import settle

ROUNDS = 6
MAX_WALK = 64


def sides(n: int) -> tuple[int, int]:
    """a and b with a * b >= n, both near the square root of n."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _once(place: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network: the rounds shift either half by a hash of the other, modulo its size."""
    right = F.pmod(place, F.lit(b))
    halves = F.array(((place - right) / b).cast("long"), right)

    def round_(h: Column, i: Column) -> Column:
        left = F.array(F.pmod(h[0] + F.pmod(F.xxhash64(F.lit(seed), i, h[1]), F.lit(a)), F.lit(a)), h[1])
        right = F.array(h[0], F.pmod(h[1] + F.pmod(F.xxhash64(F.lit(seed), i, h[0]), F.lit(b)), F.lit(b)))
        return F.when(i % 2 == 0, left).otherwise(right)

    mixed = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, round_)
    return F.aggregate(mixed, F.lit(0).cast("long"), lambda total, half: total * b + half)


def permuted(number: Column, n: int, seed: int) -> Column:
    """Place of row ``number`` in the shuffle of n rows.

    A walk takes at most a * b - n steps past the first; where that is more than MAX_WALK (n in the thousands at
    least), a walk of MAX_WALK steps has a chance below 1e-100, and would raise an error.
    """
    a, b = sides(n)
    place = _once(number.cast("long"), a, b, seed)
    steps = min(a * b - n, MAX_WALK)
    if steps > 0:
        place = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), place,
                            lambda p, _: F.when(p < n, p).otherwise(_once(p, a, b, seed)))
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``number``: 0 .. n-1 in the order of ``order`` (null first)."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    # the tie breaker lets a range end inside a run of equal rows
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranges = settle(tied.repartitionByRange(*keys, "_tie").withColumn("_range", F.spark_partition_id()), "shard-ranges")
    counts = ranges.groupBy("_range").count()
    first = counts.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys, "_tie")) - 1
    return ranges.withColumn("_inside", inside).join(F.broadcast(first), "_range").withColumn(
        "number", F.col("_first") + F.col("_inside")).drop("_range", "_first", "_inside", "_tie")


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 20240607) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, by the law ``rows``: counts at most one apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                              F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")), "shard-rows")
    n = rows.count()
    if not n:
        return rows.select("*", F.lit("rows").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    placed = numbered(rows, ["doc_id", "text_crc32", "size"]).withColumn("_place", permuted(F.col("number"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("_place") - F.pmod("_place", F.lit(shards))) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
