"""Connected components of a table of links, as alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Links
stay in tables under the shared folder; the driver sees only counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.llm.common import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Connect the larger (large-star) or the smaller (small-star) neighbours of each node to the smallest one."""
    if large:
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = settle(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-min")
        return around.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # links point from the larger to the smaller node here
    smallest = settle(links.groupBy("u").agg(F.min("v").alias("m")), "star-min")
    return links.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(
        smallest.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable."""
    now = settle(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u != v").distinct(), "star")
    mark = _mark(now)
    while True:
        now = settle(_star(settle(_star(now, True), "star-large"), False).distinct(), "star")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links: equal when a step has changed nothing."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                    F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
    return tuple(row)
