"""Physical layouts: partitioned, clustered Parquet tables.

``write_layout`` is the one writer. Rows are range-partitioned on
(partition column, cluster keys) so each task writes a contiguous key range
-- few files per partition value, each sorted on the cluster keys so that
Parquet min/max statistics let an equality filter skip row groups. A hash of
the whole row is the last range key: a single hot key tuple (a third of the
rows) is still split across tasks instead of landing in one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.session import fresh_path, table_path

# Rows per output file; keeps files bounded when a partition value is huge.
MAX_RECORDS_PER_FILE = 5_000_000

# Folder value that Spark gives to NULL partition values.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def derive_partition(df: DataFrame, column: str, grain: str) -> tuple[DataFrame, str]:
    """Add the physical partition column for DAY / MONTH / YEAR grains.

    DAY uses the column itself; MONTH adds ``<col>_month`` (first of month);
    YEAR adds ``<col>_year`` (an int). Returns the frame and the name of the
    physical partition column.
    """
    if grain == "day":
        return df, column
    if grain == "month":
        name = f"{column}_month"
        return df.withColumn(name, X.month_start(column)), name
    if grain == "year":
        name = f"{column}_year"
        return df.withColumn(name, F.year(column)), name
    raise ValueError(grain)


def cluster_order(df: DataFrame, partition_col: str | None, cluster_keys: list[str],
                  num_partitions: int | None = None, once: bool = False) -> DataFrame:
    """Rows dealt by ranges of (partition column, cluster keys, row hash) and sorted within them.

    Spark finds the ranges by a pass of its own over the rows, so what they are
    made of is computed twice. With ``once`` a shuffle by row hash comes first:
    both passes read its result. That pays where the rows are few or cheap to
    store beside what they cost to compute (windows, aggregates).
    """
    keys = ([partition_col] if partition_col else []) + list(cluster_keys)
    if not keys:
        return df
    columns = df.columns
    spread = F.xxhash64(*[F.col(c) for c in columns])
    if once:
        # the hash is a column of its own in between: Spark would merge two shuffles side by side
        df = df.repartition(spread).withColumn("_spread", spread)
        spread = F.col("_spread")
    rng = [F.col(k) for k in keys] + [spread]
    parts = (df.repartitionByRange(num_partitions, *rng) if num_partitions
             else df.repartitionByRange(*rng))
    return parts.select(*columns).sortWithinPartitions(*keys) if once else parts.sortWithinPartitions(*keys)


def write_layout(df: DataFrame, path: str, partition_col: str | None = None,
                 cluster_keys: list[str] | None = None, grain: str = "day",
                 mode: str = "overwrite", num_partitions: int | None = None,
                 dynamic: bool = True, once: bool = False) -> str:
    """Write ``df`` partitioned by ``partition_col`` (at ``grain``) and clustered by ``cluster_keys``.

    Returns the physical partition column name (None when unpartitioned).
    ``once``: compute the rows once, see ``cluster_order``.
    With ``mode='overwrite'`` and dynamic partition overwrite only the
    partitions present in ``df`` are replaced.
    """
    cluster_keys = list(cluster_keys or [])
    phys = None
    if partition_col:
        df, phys = derive_partition(df, partition_col, grain)
    ordered = cluster_order(df, phys, cluster_keys, num_partitions, once)
    writer = ordered.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if phys:
        writer = writer.partitionBy(phys)
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)
    return phys


def implied_partition_filter(predicate_col: str, grain: str, op: str, value) -> Column | None:
    """Predicate on the derived partition column implied by one on its source.

    Plain Parquet directories prune only on the physical partition column, so a
    filter ``eff_from_ts >= v`` on a table partitioned by ``year(eff_from_ts)``
    gets the extra ``eff_from_ts_year >= year(v)``; both are kept.
    """
    if grain == "day":
        return None
    if grain == "year":
        phys, bound = F.col(f"{predicate_col}_year"), F.year(F.lit(value))
    elif grain == "month":
        phys, bound = F.col(f"{predicate_col}_month"), X.month_start(F.lit(value))
    else:
        raise ValueError(grain)
    if op in (">=", ">"):
        return phys >= bound
    if op in ("<=", "<"):
        return phys <= bound
    if op == "==":
        return phys == bound
    raise ValueError(op)


def expire_partitions(df: DataFrame, partition_col: str, as_of: dt.date, days: int = 90) -> DataFrame:
    """Rows whose partition has not expired on ``as_of``.

    ``partition_expiration_days=N``: a partition dated D expires at D + N, so
    rows are kept when D > as_of - N. ``as_of`` is a parameter (never the
    wall clock) so results repeat.
    """
    return df.filter(F.col(partition_col) > F.date_sub(F.lit(as_of), days))


def source_fingerprint(spark: SparkSession, sf_dir: str, tables: list[str], version: str = "") -> str:
    """Identity of a derived table: input location, status of every input file on whatever file system holds
    it, and the version of the code that builds it (so changed inputs or code never reuse a table)."""
    h = hashlib.sha1(sf_dir.encode())
    h.update(version.encode())
    for t in tables:
        fs, root = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = fs.globStatus(root) or []
        for st in files:
            inside = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
            for x in sorted(f"{i.getPath().getName()}:{i.getLen()}:{i.getModificationTime()}" for i in inside):
                h.update(f"{t}:{x}".encode())
    return h.hexdigest()[:16]


def table_ready(spark: SparkSession, path: str) -> bool:
    """Whether a table was fully committed (its ``_SUCCESS`` marker exists)."""
    fs, marker = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _read_pointer(spark: SparkSession, pointer: str) -> str | None:
    """Folder that a pointer file names, or None while there is none (or its writer died before naming one)."""
    fs, path = _fs(spark, pointer)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{pointer.rsplit('/', 1)[0]}/{name}" if name else None


def _publish(spark: SparkSession, pointer: str, build: str) -> str:
    """Name ``build`` in the pointer file; where another run has named its own first, that one counts."""
    fs, path = _fs(spark, pointer)
    try:
        stream = fs.create(path, False)          # fails if the file exists: one writer wins
    except Py4JJavaError:
        return _read_pointer(spark, pointer) or build
    try:
        stream.write(bytearray(build.rsplit("/", 1)[1].encode()))
    finally:
        stream.close()
    return build


def materialized_path(spark: SparkSession, name: str, sf_dir: str, sources: list[str], build_rows,
                      partition_col: str | None, cluster_keys: list[str], grain: str = "day",
                      version: str = "", once: bool = False) -> str:
    """Location of a warehouse table in the shared folder, written once per input and code version.

    Every build writes a folder of its own; a pointer file, created by one
    build only, names the folder that counts. Nothing is renamed or deleted,
    so concurrent builds cannot disturb each other. ``build_rows`` is the rows,
    or a function that gives them and is called only where there is no table yet.
    """
    fp = source_fingerprint(spark, sf_dir, sources, f"{version}|{partition_col}|{grain}|{cluster_keys}")
    base = table_path(spark, "warehouse", f"{name}-{fp}")
    pointer = f"{base}.ptr"
    path = _read_pointer(spark, pointer)
    if path is None:
        build = f"{base}-{uuid.uuid4().hex[:12]}"
        # static overwrite, so the committer leaves _SUCCESS at the root
        write_layout(build_rows() if callable(build_rows) else build_rows, build, partition_col, cluster_keys, grain, dynamic=False,
                     once=once)
        path = _publish(spark, pointer, build)
    return path


_SCHEMAS: dict = {}  # declared schemas of the warehouse tables, by name and code version


def materialized(spark: SparkSession, name: str, sf_dir: str, sources: list[str], build,
                 partition_col: str | None, cluster_keys: list[str], grain: str = "day",
                 version: str = "", once: bool = False) -> DataFrame:
    """A warehouse table laid out in the shared folder, written once per input and code version.

    Some builds store rows of their own, so the rows are asked for only for a new table, and once for the schema.
    """
    made: list[DataFrame] = []

    def rows() -> DataFrame:
        if not made:
            made.append(build())
        return made[0]

    path = materialized_path(spark, name, sf_dir, sources, rows, partition_col, cluster_keys, grain, version, once)
    if (name, version) not in _SCHEMAS:
        _SCHEMAS[name, version] = rows().schema
    schema = _SCHEMAS[name, version]
    out = spark.read.parquet(path)
    # keep the declared column order; the derived partition column stays last
    extra = [c for c in out.columns if c not in schema.names]
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *extra)


def write_fresh(spark: SparkSession, name: str, df: DataFrame, partition_col: str | None,
                cluster_keys: list[str], grain: str = "day") -> tuple[str, str | None]:
    path = fresh_path(spark, name)
    phys = write_layout(df, path, partition_col, cluster_keys, grain, dynamic=False)  # the folder is new
    return path, phys


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_values(spark: SparkSession, path: str, partition_col: str, raw: bool = False) -> list[str]:
    """Partition values of a layout, from its directory listing (no data read); ``raw``: as the folders spell them."""
    fs, root = _fs(spark, path)
    prefix = f"{partition_col}="
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):] if raw else unquote(name[len(prefix):]))
    return sorted(out)


def drop_expired_partitions(spark: SparkSession, path: str, partition_col: str, as_of: dt.date,
                            days: int = 90, parallelism: int = 16) -> list[str]:
    """Apply ``partition_expiration_days``: delete day partitions dated on or before as_of - days.

    Works on the directory listing only; the rows of kept partitions are
    never read or rewritten. A daily run drops one directory; a first run on
    a long history drops many, so the deletes are issued concurrently.
    """
    from concurrent.futures import ThreadPoolExecutor

    cutoff = as_of - dt.timedelta(days=days)
    fs, root = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    def expires(value: str) -> bool:
        try:
            return dt.date.fromisoformat(value) <= cutoff
        except ValueError:      # NULL partition (no date): never expires
            return False

    expired = [v for v in partition_values(spark, path, partition_col) if expires(v)]

    def delete(value: str) -> str:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{partition_col}={value}"), True)
        return value

    if not expired:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(expired)))) as pool:
        return sorted(pool.map(delete, expired))


def replace_partitions(spark: SparkSession, path: str, rows: DataFrame, partition_col: str,
                       cluster_keys: list[str], touched: list[str] | None = None, grain: str = "day") -> list[str]:
    """Put the partitions of ``rows`` in the place of those of a stored layout; other folders stay as they are.

    ``rows`` may read the layout itself: it is evaluated once, into a folder of
    its own, whose partition folders are then moved in (what Spark's dynamic
    overwrite does at its commit). Partitions in ``touched`` that ``rows`` does
    not have have become empty and are removed. Returns the folder values put
    in place; only such values, one per partition, come to the driver.
    """
    apart = fresh_path(spark, "replace")
    column = write_layout(rows, apart, partition_col, cluster_keys, grain)
    fs, root = _fs(spark, path)
    fs.mkdirs(root)
    _, source = _fs(spark, apart)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    written = partition_values(spark, apart, column, raw=True) if fs.exists(source) else []
    for value in sorted({*written, *map(_folder, touched or [])}):
        fs.delete(place(root, f"{column}={value}"), True)
        if value in written and not fs.rename(place(source, f"{column}={value}"), place(root, f"{column}={value}")):
            raise OSError(f"cannot move {column}={value} to {path}")
    return [unquote(v) for v in written]


def _folder(value: str) -> str:
    """Folder name of a partition value (dates and whole numbers need no escapes)."""
    return NULL_PARTITION if value is None else str(value)


def in_partitions(partition_col: str, folders: list[str]) -> Column:
    """Filter on the partition column by folder values; prunes folders, as it reads no other column."""
    known = [v for v in folders if v != NULL_PARTITION]
    cond = F.col(partition_col).cast("string").isin(known) if known else F.lit(False)
    return cond | F.col(partition_col).isNull() if len(known) < len(folders) else cond


def refresh_aggregate(spark: SparkSession, fact_path: str, agg_path: str, delta: DataFrame,
                      partition_col: str, aggregate, fact_cluster: list[str],
                      agg_cluster: list[str], agg_partition: str | None = None,
                      agg_partition_of=None) -> list:
    """Incremental maintenance of an aggregate stored by partition.

    1. The delta's day partitions replace those of the stored fact (other days
       are not touched). The delta is evaluated once; its days are the folders
       that it has left.
    2. The aggregate is recomputed from the stored fact for the touched
       aggregate partitions only (a partition filter on the fact scan) and
       replaces the same partitions of the stored aggregate; a touched one
       that is not among the new ones has become empty.

    When the aggregate is partitioned at a coarser grain (``agg_partition``,
    e.g. ``week_start_date``), ``agg_partition_of`` maps the fact's partition
    column to it (e.g. ISO-week truncation); every fact day of a touched week
    is re-read, so distinct counts are recomputed from rows, never merged.
    Returns the touched aggregate partition values. Only those values -- one
    per touched partition, bounded by the partition count, not by rows --
    come to the driver, to become a static partition filter.
    """
    agg_partition = agg_partition or partition_col
    to_agg = agg_partition_of or (lambda c: c)
    days = replace_partitions(spark, fact_path, delta, partition_col, fact_cluster)
    names = spark.createDataFrame([(None if d == NULL_PARTITION else d,) for d in days], f"{partition_col} string")
    typed = names.select(F.col(partition_col).cast(delta.schema[partition_col].dataType).alias(partition_col))
    values = [r[0] for r in typed.select(to_agg(F.col(partition_col)).alias("_p")).distinct().collect()]
    touched = sorted(v for v in values if v is not None)
    part = to_agg(F.col(partition_col))
    cond = part.isin(touched) if touched else F.lit(False)
    if len(touched) < len(values):           # the NULL partition is touched too
        cond = cond | part.isNull()
        touched = [*touched, None]
    fact = spark.read.schema(delta.schema).parquet(fact_path).filter(cond)
    replace_partitions(spark, agg_path, aggregate(fact), agg_partition, agg_cluster, touched)
    return touched


def full_refresh(df: DataFrame, path: str, partition_col: str | None, cluster_keys: list[str],
                 grain: str = "day") -> str:
    """Rebuild a table in full (``allow_non_incremental_definition``): a static
    overwrite, so partitions absent from the new result disappear too."""
    return write_layout(df, path, partition_col, cluster_keys, grain, mode="overwrite", dynamic=False)
