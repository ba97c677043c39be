"""Current state stored by key bucket.

A state whose rows lie in hash buckets of their key needs only the buckets of
a delta's keys to be read and written when the delta is merged, and a look-up
by key reads one bucket. The bucket number is the physical partition column;
its name holds the number of buckets, so a state is never merged with another
number than it was stored with.

A delta that touches every bucket costs a full rewrite, as any merge did
before; the gain is that of a delta with few keys against many buckets. Rows
of a hot bucket are still split over tasks and files by ``write_layout``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.operators import history as H
from switchboard.operators import layout as L
from switchboard.session import fresh_path

# Bytes of stored state that one bucket is meant to hold, and bounds of the number of buckets.
BUCKET_BYTES = 256 * 1024 * 1024
MIN_BUCKETS, MAX_BUCKETS = 16, 16_384


def buckets_for(state_bytes: int) -> int:
    """Number of buckets for a state of that size: a power of two, so that a later doubling splits buckets in two."""
    wanted = max(MIN_BUCKETS, -(-state_bytes // BUCKET_BYTES))
    return min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, from the file system's listing."""
    fs, root = L._fs(spark, path)
    return int(fs.getContentSummary(root).getLength())


@dataclass(frozen=True)
class KeyedState:
    """Where a state lies, its key columns and its number of buckets."""

    path: str
    keys: tuple[str, ...]
    buckets: int

    @property
    def column(self) -> str:
        return f"bucket_of_{self.buckets}"

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """``df`` with its bucket number; NULL keys have a bucket like any other value."""
        number = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        return df.withColumn(self.column, number)


def store(state: KeyedState, rows: DataFrame) -> None:
    """Write ``rows`` as the whole state, by bucket and clustered by key."""
    L.write_layout(state.with_bucket(rows), state.path, state.column, list(state.keys), dynamic=False)


def read(spark: SparkSession, state: KeyedState, like: DataFrame, buckets: list[str] | None = None) -> DataFrame:
    """The stored rows in the columns of ``like``; ``buckets`` reads only these folders."""
    schema = state.with_bucket(like.limit(0)).schema
    rows = spark.read.schema(schema).parquet(state.path)
    if buckets is not None:
        rows = rows.filter(L.in_partitions(state.column, buckets))
    return rows.select(*like.columns)


def look_up(spark: SparkSession, state: KeyedState, like: DataFrame, key: dict) -> DataFrame:
    """The stored rows of one key: a filter on the bucket folder, then on the key's row groups.

    ``key`` gives every key column a value, in the type that the state has.
    """
    schema = state.with_bucket(like.limit(0)).schema
    values = [F.lit(key[k]).cast(schema[k].dataType) for k in state.keys]
    number = F.pmod(F.xxhash64(*values), F.lit(state.buckets)).cast("int")
    found: Column = F.col(state.column) == number
    for k, value in zip(state.keys, values):
        found = found & (F.col(k).isNull() if key[k] is None else F.col(k) == value)
    return spark.read.schema(schema).parquet(state.path).filter(found).select(*like.columns)


def _merge(spark: SparkSession, state: KeyedState, delta: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame],
           like: DataFrame) -> list[str]:
    """Replace the buckets of ``delta`` by ``merged(stored rows, delta rows)``; returns the buckets rewritten.

    The delta is evaluated once, into bucket folders of its own: their names
    are the touched buckets, the only thing that comes to the driver (at most
    ``buckets`` values).
    """
    apart = KeyedState(fresh_path(spark, "delta"), state.keys, state.buckets)
    store(apart, delta)
    touched = L.partition_values(spark, apart.path, state.column)
    if not touched:
        return []
    rows = merged(read(spark, state, like, touched), read(spark, apart, delta))
    L.replace_partitions(spark, state.path, state.with_bucket(rows), state.column, list(state.keys), touched)
    return touched


def merge_changes(spark: SparkSession, state: KeyedState, feed: DataFrame, change_col: str = "change_ms",
                  tie_col: str = "change_id") -> list[str]:
    """A delta of a change feed merged into a stored latest-wins state (deletes stay in it); returns the buckets rewritten."""
    like = H.cdc_state(feed, list(state.keys), change_col, tie_col)
    return _merge(spark, state, like, lambda old, new: H.cdc_merge_into_base(
        old, new, list(state.keys), change_col, tie_col).select(*like.columns), like)


def merge_upsert(spark: SparkSession, state: KeyedState, delta: DataFrame, order: list[str] | None = None) -> list[str]:
    """MERGE of ``delta`` (columns of the state) into the stored rows, as ``history.upsert``; returns the buckets rewritten."""
    return _merge(spark, state, delta, lambda old, new: H.upsert(old, new, list(state.keys), order), delta)
