"""Surrogate keys from a stored registry.

The registry is a table (natural key, surrogate key, ``late``): a natural key
is numbered when it is first seen, in a dimension feed or in a fact, and keeps
its number for good. Numbers are 1, 2, 3, ... without collisions or gaps.

Only unseen keys are numbered. They are dealt out by ranges of the natural
key; each range numbers its own rows, and one row per range carries the
counts of the ranges before it, so no task sees all keys. New numbers follow
the greatest stored one, in the order of the natural key.

A key that a fact brings first is ``late``: its dimension row is still to
come. ``dimension_rows`` gives such a key a placeholder row until then.
A natural key with a NULL part is no key; its surrogate is ``NO_KEY``.

One run at a time may add to a registry (as a nightly load does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from switchboard.operators.history import RANGE, in_ranges

NO_KEY = 0
LATE = "late"


def _empty(spark: SparkSession, like: DataFrame, natural: list[str], sk: str) -> DataFrame:
    return like.limit(0).select(*natural, F.lit(0).cast("bigint").alias(sk), F.lit(False).alias(LATE))


def read(spark: SparkSession, path: str, like: DataFrame, natural: list[str], sk: str) -> DataFrame:
    """The registry at ``path``: a row per natural key seen so far. ``like`` gives the types of the natural key."""
    return spark.read.schema(_empty(spark, like, natural, sk).schema).parquet(path)


def create(spark: SparkSession, path: str, like: DataFrame, natural: list[str], sk: str) -> None:
    """An empty registry."""
    _empty(spark, like, natural, sk).write.parquet(path)


def add_keys(spark: SparkSession, path: str, rows: DataFrame, natural: list[str], sk: str, late: bool = False) -> None:
    """Number the natural keys of ``rows`` that the registry does not have yet, and append them.

    Stored rows are neither changed nor rewritten; a rerun with the same rows
    appends nothing. ``late`` marks keys that facts bring before their dimension row.
    """
    known = read(spark, path, rows, natural, sk)
    whole = F.lit(True)
    for c in natural:
        whole = whole & F.col(c).isNotNull()
    # distinct before the join: a hot key reaches it as one row per task
    unseen = rows.select(*natural).filter(whole).distinct().join(known.select(*natural), natural, "left_anti")
    dealt = in_ranges(unseen, natural)
    counts = dealt.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: bounded by the number of shuffle partitions
    before = F.broadcast(counts.select(RANGE, F.expr(f"sum(_n) OVER (ORDER BY {RANGE}) - _n").alias("_before")))
    top = known.agg(F.coalesce(F.max(sk), F.lit(NO_KEY)).alias("m")).first()["m"]
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*natural))
    (dealt.withColumn("_place", place).join(before, RANGE)
     .select(*natural, (F.lit(top) + F.col("_before") + F.col("_place")).cast("bigint").alias(sk), F.lit(late).alias(LATE))
     .write.mode("append").parquet(path))


def dimension_rows(registry: DataFrame, dim: DataFrame, natural: list[str], sk: str,
                   placeholder: dict | None = None) -> DataFrame:
    """Every registered key with its dimension row, or a placeholder row while there is none.

    ``dim`` has one row per natural key. ``placeholder`` gives values for the
    columns of placeholder rows (NULL without); ``is_placeholder`` tells them apart.
    """
    attrs = [c for c in dim.columns if c not in natural]
    joined = registry.select(*natural, sk).join(dim.withColumn("_here", F.lit(True)), natural, "left")
    missing = F.col("_here").isNull()
    fill = placeholder or {}
    return joined.select(sk, *natural, *[
        F.when(missing, F.lit(fill.get(c)).cast(dim.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in attrs],
        missing.alias("is_placeholder"))


def with_keys(fact: DataFrame, registry: DataFrame, natural: list[str], sk: str, columns: list[str] | None = None) -> DataFrame:
    """``fact`` with the surrogate key of its natural key in ``columns`` (same names without); ``NO_KEY`` where it has none."""
    columns = columns or natural
    keys = registry.select(*[F.col(n).alias(c) for n, c in zip(natural, columns)], sk)
    return fact.join(keys, columns, "left").withColumn(sk, F.coalesce(F.col(sk), F.lit(NO_KEY).cast("bigint")))
