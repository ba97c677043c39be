"""Data checks (K1-K4): the reference's metadata specs re-aimed at the rows.

Each returns a small DataFrame of findings computed in one distributed pass
(no per-column driver loops, no collect).
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_paths(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """(path, k) rows of documented key paths of one table: path name to key column, in one scan."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("path"), F.col(c).cast("bigint").alias("k")) for p, c in paths.items()])).alias("e")
    ).select("e.path", "e.k")


def fk_orphans(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Per documented key path: child rows, NULL keys, orphan rows and orphan keys.

    ``children`` and ``parents`` hold (path, k) rows of every path, stacked.
    Both sides are reduced to one row per (path, k) first, the children with
    their number of rows: an aggregate that combines map-side, so a hot key
    reaches the join as one row.
    """
    counts = children.groupBy("path", "k").agg(F.count(F.lit(1)).alias("n"))
    keys = parents.filter(F.col("k").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    j = counts.join(keys, ["path", "k"], "left")
    orphan = F.col("k").isNotNull() & F.col("_hit").isNull()
    return j.groupBy("path").agg(
        F.sum("n").alias("child_rows"),
        F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(0)).alias("null_key_rows"),
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )


def pk_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def cast_loss_audit(df: DataFrame, targets: list[tuple[str, str]]) -> DataFrame:
    """Per (column, target type): rows, NULLs, values the cast cannot hold, values that lose scale.

    One pass: every counter is a conditional count in a single global
    aggregate; the result is unpivoted with ``stack``.
    """
    aggs, names = [], []
    for i, (c, target) in enumerate(targets):
        src = F.col(c)
        tried = src.try_cast(target)
        # a value that is changed by the cast does not come back; text is compared as an exact decimal
        if isinstance(df.schema[c].dataType, T.StringType):
            number = target.replace(" ", "").lower().startswith(("decimal(", "bigint", "int", "double"))
            lossy = (src.try_cast("decimal(38,18)") != tried.try_cast("decimal(38,18)")) if number else F.lit(False)
        else:
            lossy = tried.isNotNull() & ~tried.try_cast(df.schema[c].dataType).eqNullSafe(src)
        aggs += [
            F.count(F.lit(1)).alias(f"r{i}"),
            F.count_if(src.isNull()).alias(f"n{i}"),
            F.count_if(src.isNotNull() & tried.isNull()).alias(f"f{i}"),
            F.count_if(lossy).alias(f"l{i}"),
        ]
        names.append((c, target))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{t}', r{i}, n{i}, f{i}, l{i}" for i, (c, t) in enumerate(names))
    return wide.selectExpr(
        f"stack({len(names)}, {stack}) AS (column_name, target_type, row_count, null_count, "
        "failed_casts, scale_losses)")


def partition_profile(df: DataFrame, partition_col: str, cluster_key: str, as_of: dt.date,
                      expiry_days: int = 90) -> DataFrame:
    """Rows per partition, min/max/distinct of the cluster key, and whether it has expired."""
    return (df.groupBy(partition_col)
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.min(cluster_key).alias("min_cluster_key"),
                 F.max(cluster_key).alias("max_cluster_key"),
                 F.countDistinct(cluster_key).alias("distinct_cluster_keys"))
            .withColumn("expired", F.col(partition_col) <= F.date_sub(F.lit(as_of), expiry_days)))


def pruned_count(full: DataFrame, predicate) -> DataFrame:
    """COUNT(*) unfiltered (a) and filtered (b) over the same table, and b <= a."""
    # Two separate scans (the filtered one keeps its pushdown and pruning),
    # combined as two labelled one-row aggregates.
    a = full.agg(F.count(F.lit(1)).alias("n")).select(F.lit("a").alias("side"), "n")
    b = full.filter(predicate).agg(F.count(F.lit(1)).alias("n")).select(F.lit("b").alias("side"), "n")
    both = a.unionByName(b).groupBy().agg(
        F.max(F.when(F.col("side") == "a", F.col("n"))).alias("total_rows"),
        F.max(F.when(F.col("side") == "b", F.col("n"))).alias("filtered_rows"))
    return both.withColumn("filtered_le_total", F.col("filtered_rows") <= F.col("total_rows"))


def zone_map(stored: DataFrame, cluster_key: str, partition_col: str | None = None) -> DataFrame:
    """One row per file of a stored layout: rows, NULL keys, least and greatest cluster key.

    ``stored`` is the table as read from its files. The scan reads the cluster
    key only (a partition column comes from the folder), and every task
    reduces its files to one row each before the shuffle.
    """
    part = F.col(partition_col) if partition_col else F.lit(None).cast("string")
    key = F.col(cluster_key)
    return (stored.select(part.alias("zone_partition"), F.col("_metadata.file_path").alias("file"), key.alias("_key"))
            .groupBy("zone_partition", "file").agg(
                F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("_key").isNull()).alias("null_keys"),
                F.min("_key").alias("min_key"), F.max("_key").alias("max_key")))


def overlap_depth(zones: DataFrame) -> DataFrame:
    """Per partition of a zone map: files, and in how many files at most a key is inside the range.

    A sweep: every file with two or more keys opens at its least key and closes
    at its greatest; the depth is the greatest running sum. Files that only
    meet at an end do not overlap, and neither do files of a single key: a hot
    key may fill several files. Sorted files have a depth of 1 (0 where every
    file has a single key). One partition's sweep has two rows per file.
    """
    wide = F.col("min_key") < F.col("max_key")
    edges = zones.select("zone_partition", F.explode(F.when(wide, F.array(
        F.struct(F.col("min_key").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("max_key").alias("at"), F.lit(-1).alias("step"))))).alias("e")).select("zone_partition", "e.*")
    sweep = Window.partitionBy("zone_partition").orderBy("at", "step").rowsBetween(Window.unboundedPreceding, 0)
    depth = (edges.withColumn("open", F.sum("step").over(sweep)).groupBy("zone_partition")
             .agg(F.max("open").alias("_depth")).withColumnRenamed("zone_partition", "_p"))
    files = zones.groupBy("zone_partition").agg(F.count(F.lit(1)).alias("files"))
    return files.join(depth, F.col("zone_partition").eqNullSafe(F.col("_p")), "left").select(
        "zone_partition", "files", F.coalesce("_depth", F.lit(0).cast("bigint")).alias("depth"))


def clustering_check(zones: DataFrame) -> DataFrame:
    """One row: partitions, files, the greatest depth, and whether the layout is ``clustered`` (no two files of a partition overlap)."""
    return overlap_depth(zones).agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.max("depth"), F.lit(0)).alias("max_depth")).withColumn("clustered", F.col("max_depth") <= 1)


def files_to_read(zones: DataFrame, low, high) -> DataFrame:
    """One row: all files, and those that a filter ``low <= key <= high`` must read by their key ranges."""
    hit = (F.col("max_key") >= F.lit(low)) & (F.col("min_key") <= F.lit(high))
    return zones.agg(F.count(F.lit(1)).alias("files"), F.count_if(hit).alias("files_read"),
                     F.coalesce(F.sum(F.when(hit, F.col("row_count"))), F.lit(0)).alias("rows_read"))


def zone_profile(zones: DataFrame, as_of: dt.date, expiry_days: int = 90) -> DataFrame:
    """``partition_profile`` of a layout partitioned by day, from its zone map (no distinct keys: files do not tell them)."""
    return (zones.groupBy("zone_partition").agg(
        F.sum("row_count").alias("row_count"), F.min("min_key").alias("min_cluster_key"), F.max("max_key").alias("max_cluster_key"))
        .withColumn("expired", F.col("zone_partition") <= F.date_sub(F.lit(as_of), expiry_days)))
