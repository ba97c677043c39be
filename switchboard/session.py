"""Session settings and the shared working folder.

Every operator here is plain DataFrame / SQL code; the session only pins the
settings whose values change results (UTC time zone, ANSI arithmetic) and
the ones that matter for scale (AQE, skew-join splitting, partition sizes).
Writers set their own options (e.g. dynamic partition overwrite) per write
instead of changing the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied to sessions this package creates. On an existing cluster
# session they are only applied where the key is still unset.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "switchboard") -> SparkSession:
    """Local session for tests and the bench (cluster jobs pass their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def apply_defaults(spark: SparkSession) -> None:
    """Pin result-relevant settings. The time zone is always pinned to UTC:
    EXTRACT(HOUR ...) and date-of-timestamp depend on it.

    When unset, partition-folder listing runs in about 4 tasks per core
    (capped at Spark's 10,000): a day-partitioned table with thousands of
    folders is then listed in a few waves instead of one tiny task per folder.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(LISTING_PARALLELISM, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING_PARALLELISM, str(min(10_000, max(8, 4 * cores))))
    for key, value in SESSION_DEFAULTS.items():
        try:
            current = spark.conf.get(key, None)
        except Exception:  # pragma: no cover - conf may be read-only
            current = None
        if current is None:
            try:
                spark.conf.set(key, value)
            except Exception:  # pragma: no cover - static confs
                pass


MAX_SHUFFLE_PARTITIONS = 100_000


def scale_settings(input_bytes: int, executors_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``executors_cores`` cores.

    Scan splits and shuffle partitions both target ~256 MB so a task's input
    fits comfortably in executor memory (with room for sort and aggregation
    buffers before spilling); the shuffle partition count is at least a few
    waves of the cluster's cores, and AQE coalesces small ones and splits
    skewed ones (a partition 5x the median and over 1 GB) at run time. The
    count is capped at 100k: past that the driver's map-status bookkeeping
    (mappers x reducers) dominates, and full-data shuffles simply get larger,
    spilling partitions. For 100 TB on 1,000 executors x 8 cores: 400k scan
    splits (50 waves of 8,000 tasks) and 100k shuffle partitions.
    """
    parts = min(MAX_SHUFFLE_PARTITIONS,
                max(3 * executors_cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        LISTING_PARALLELISM: str(min(10_000, max(8, 4 * executors_cores))),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Written tables (layouts, refreshed aggregates) and checkpoints live there
    so that a lost executor never loses them. Only when the session has no
    such setting (local tests) is a private folder created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="switchboard-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # pragma: no cover
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def table_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), "tables", *parts])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used location under the shared folder."""
    return table_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
