"""Refresh-on-arrival for day-partitioned aggregates with Structured Streaming.

The reference's incremental materialized views are refreshed when base
rows arrive. Here the base fact lands as commits: ``land`` writes each as a
folder ``batch_id=N`` of Parquet files that restates whole day partitions. A
file stream over the landing folder hands every micro-batch to
``foreachBatch``, which keeps the newest commit of each day, replaces the
touched fact partitions, and recomputes the same partitions of the aggregate.
Several commits may meet in one micro-batch (after a restart, say): the newest
restatement of a day wins, and all files of it count.

Commits must appear whole and in the order of their ids (write elsewhere and
rename, or land one at a time), as the stream reads all that has landed.

The stream's checkpoint (offsets + commit log) lives in the shared folder,
so a restarted driver resumes after the last committed batch, and a batch
that failed half-way is re-run; both writes are partition overwrites, so a
re-run gives the same tables (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from switchboard.operators.layout import refresh_aggregate
from switchboard.session import table_path


COMMIT = "batch_id"


def land(commit: DataFrame, landing_path: str, batch_id: int) -> None:
    """Write one commit to the landing folder."""
    commit.write.mode("overwrite").parquet(f"{landing_path}/{COMMIT}={batch_id}")


def newest_commit(rows: DataFrame, partition_col: str) -> DataFrame:
    """Rows of the newest commit of each partition value (NULL is a value too), without the commit id."""
    newest = rows.groupBy(F.col(partition_col).alias("_p")).agg(F.max(COMMIT).alias("_newest"))
    return rows.join(newest, F.col(partition_col).eqNullSafe(F.col("_p")) & (F.col(COMMIT) == F.col("_newest")),
                     "left_semi").drop(COMMIT)


def start_refresh(spark: SparkSession, landing_path: str, fact_schema: T.StructType, fact_path: str,
                  agg_path: str, aggregate: Callable[[DataFrame], DataFrame], partition_col: str,
                  fact_cluster: list[str], agg_cluster: list[str], name: str = "refresh",
                  checkpoint: str | None = None, available_now: bool = True, agg_partition: str | None = None,
                  agg_partition_of=None) -> StreamingQuery:
    """Start the refresh stream; ``available_now`` processes what has landed and stops.

    ``agg_partition`` / ``agg_partition_of`` refresh an aggregate partitioned
    coarser than the fact (e.g. by ISO week), as in ``refresh_aggregate``.
    There is no limit on the files of a micro-batch: a commit must not be cut in two.
    """
    schema = T.StructType([*fact_schema.fields, T.StructField(COMMIT, T.LongType())])
    source = spark.readStream.schema(schema).parquet(landing_path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        delta = newest_commit(batch, partition_col)
        if not delta.isEmpty():
            refresh_aggregate(spark, fact_path, agg_path, delta, partition_col, aggregate,
                              fact_cluster, agg_cluster, agg_partition, agg_partition_of)

    writer = (source.writeStream.queryName(name).foreachBatch(apply)
              .option("checkpointLocation", checkpoint or table_path(spark, "_streams", name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
