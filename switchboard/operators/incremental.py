"""Maintenance of stored results by what has changed.

* ``merge_scd2``: a day's changes, late ones too, merged into a stored type-2
  history; only their keys are recomputed and only the year folders whose rows
  differ are rewritten.
* ``signed_state`` / ``apply_signed``: sums and counts kept per group; before
  images are subtracted and after images added, without a look at the fact.
* ``distinct_state`` / ``merge_distinct``: distinct ids kept as bitmaps (exact)
  and as a sketch, both of which merge.

Each reads and rewrites only the touched partitions of its stored state, by
``layout.replace_partitions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.functions import decode as X
from switchboard.operators import history as H
from switchboard.operators import layout as L
from switchboard.operators.aggregates import agent_day_partials
from switchboard.session import fresh_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder: several steps read it, and none recomputes it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on keys where NULL equals NULL, as in PARTITION BY."""
    cond = F.lit(True)
    for k in keys:
        right = right.withColumnRenamed(k, f"_same_{k}")
        cond = cond & F.col(k).eqNullSafe(F.col(f"_same_{k}"))
    return left.join(right, cond, how)


# ---------------------------------------------------------------- C3
YEAR = "eff_from_ts_year"
_VALIDITY = ["eff_from_ts", "eff_to_ts", "is_current", "kept"]


def build_scd2(spark: SparkSession, path: str, changes: DataFrame, key: str, ts_col: str, attrs: list[str],
               tie_col: str) -> None:
    """Store the type-2 rows of all changes, by year of ``eff_from_ts`` and clustered by key.

    Changes that only confirm what was known are stored too (``kept`` false):
    a late change in front of one of them makes it a validity row of its own.
    """
    rows = H.scd2_rows(changes, key, ts_col, attrs, tie_col).select(*changes.columns, *_VALIDITY)
    L.write_layout(rows, path, "eff_from_ts", [key], "year", dynamic=False)


def merge_scd2(spark: SparkSession, path: str, changes: DataFrame, key: str, ts_col: str, attrs: list[str],
               tie_col: str) -> list[str]:
    """Merge dated changes into a stored type-2 history (``build_scd2``); returns the year folders rewritten.

    A change may come before, between or after the stored ones of its key: the
    rows around it are split, closed or reopened. A change with the identity
    (key, time, tie) of a stored one takes its place. The result is that of a
    rebuild from all changes.

    The stored rows of the delta's keys are read (the cluster key skips row
    groups), run through the same ordered pass as a rebuild, and compared with
    what is stored; years without a difference keep their files. Neither keys
    nor rows come to the driver, only the years.
    """
    stored = spark.read.schema(_scd2_schema(changes)).parquet(path)
    delta = _stored(changes.select(*changes.columns), "scd2-delta")
    keys = _stored(delta.select(key).distinct(), "scd2-keys")
    mine = _stored(_same(stored, keys, [key], "left_semi"), "scd2-before")
    identity = [key, ts_col, tie_col]
    rest = [c for c in changes.columns if c not in identity]
    both = mine.select(*changes.columns, F.lit(0).alias("_new")).unionByName(delta.select(*changes.columns, F.lit(1).alias("_new")))
    latest = both.groupBy(*identity).agg(F.max_by(F.struct(*rest), "_new").alias("_row")).select(
        *identity, *[F.col(f"_row.{c}").alias(c) for c in rest])
    after = _stored(H.scd2_rows(latest, key, ts_col, attrs, tie_col).select(*changes.columns, *_VALIDITY).withColumn(
        YEAR, F.year("eff_from_ts")), "scd2-after")
    # rows that stand on both sides cancel out; the years of the others are rewritten
    sides = mine.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1)))
    years = [r[0] for r in sides.groupBy(*mine.columns).agg(F.sum("_side").alias("_n")).where("_n <> 0")
             .select(F.col(YEAR).cast("string")).distinct().collect()]
    if not years:
        return []
    touched = L.in_partitions(YEAR, [L._folder(y) for y in years])
    others = _same(stored.where(touched), keys, [key], "left_anti")
    rows = others.unionByName(after.where(touched)).drop(YEAR)
    L.replace_partitions(spark, path, rows, "eff_from_ts", [key], years, "year")
    return sorted(years, key=str)


def _scd2_schema(changes: DataFrame) -> T.StructType:
    own = zip([*_VALIDITY, YEAR], (T.TimestampType(), T.TimestampType(), T.BooleanType(), T.BooleanType(), T.IntegerType()))
    return T.StructType([*changes.schema.fields, *(T.StructField(n, t) for n, t in own)])


def read_scd2(spark: SparkSession, path: str, changes: DataFrame, key: str, tie_col: str,
              id_col: str = "history_id") -> DataFrame:
    """The validity rows of a stored history, as ``history.scd2_history`` gives them."""
    return spark.read.schema(_scd2_schema(changes)).parquet(path).where("kept").drop("kept", YEAR).withColumn(
        id_col, H.history_id(key, tie_col))


# ---------------------------------------------------------------- S12 by signed deltas
def signed_state(rows: DataFrame, groups: dict[str, Column], measures: list[str], sign: int = 1) -> DataFrame:
    """Per group: how many rows, and sum and non-NULL count of each measure, times ``sign``.

    That is all that SUM, AVG and COUNT need, and both images of a change add to it.
    """
    out = [(F.count("*") * sign).alias("n_rows")]
    for m in measures:
        out += [(F.sum(F.coalesce(F.col(m), F.lit(0))) * sign).alias(f"{m}_sum"), (F.count(m) * sign).alias(f"{m}_n")]
    return rows.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(*out)


def merged_state(state: DataFrame, groups: list[str]) -> DataFrame:
    """States of equal groups added up; groups without rows are gone. A negative count means that a before image never
    was in the state, and raises an error."""
    sums = [c for c in state.columns if c not in groups]
    out = state.groupBy(*groups).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in sums])
    n = F.when(F.col("n_rows") < 0, F.raise_error(F.lit("before image of a row that the state does not have")).cast("bigint")
               ).otherwise(F.col("n_rows"))
    return out.withColumn("n_rows", n).where("n_rows <> 0")


def summed(measure: str) -> Column:
    """SUM of a measure in a state: NULL where no row has a value."""
    return F.when(F.col(f"{measure}_n") > 0, F.col(f"{measure}_sum"))


def apply_signed(spark: SparkSession, path: str, before: DataFrame, after: DataFrame, groups: dict[str, Column],
                 measures: list[str], partition_col: str, cluster_keys: list[str]) -> list[str]:
    """Subtract ``before`` images from a stored state and add ``after`` images; returns the touched partitions.

    An insert has an after image only, a delete a before image only, a
    correction both. The images are reduced to one row per group first; the
    fact is not read, and of the state only the partitions of those groups.
    """
    change = _stored(merged_images(before, after, groups, measures), "signed-delta")
    touched = [r[0] for r in change.select(F.col(partition_col).cast("string")).distinct().collect()]
    if not touched:
        return []
    old = spark.read.schema(change.schema).parquet(path).where(L.in_partitions(partition_col, [L._folder(t) for t in touched]))
    L.replace_partitions(spark, path, merged_state(old.unionByName(change), list(groups)), partition_col, cluster_keys, touched)
    return sorted(touched, key=str)


def merged_images(before: DataFrame, after: DataFrame, groups: dict[str, Column], measures: list[str]) -> DataFrame:
    """One signed row per group of both kinds of images; groups whose images cancel out are left out."""
    both = signed_state(after, groups, measures).unionByName(signed_state(before, groups, measures, -1))
    sums = [c for c in both.columns if c not in groups]
    out = both.groupBy(*groups).agg(*[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in sums])
    return out.where(" OR ".join(f"{c} <> 0" for c in sums))


QUEUE_MEASURES = ["offered", "answered", "abandoned", "answered_in_sl"]


def queue_hour_groups() -> dict[str, Column]:
    """Group columns of agg_queue_hourly."""
    return {"queue_sk": F.col("queue_sk"), "hour_of_day": X.hour_of_day("interval_start_ts"), "event_date": F.col("event_date")}


def queue_hourly_view(state: DataFrame) -> DataFrame:
    """agg_queue_hourly (A3) from its state, with its declared columns."""
    return state.select(
        "queue_sk", "hour_of_day", *[summed(m).alias(m) for m in QUEUE_MEASURES[:3]],
        X.exact_mean(F.col("answered_in_sl_sum"), F.col("answered_in_sl_n")).alias("sl_pct"),
        F.lit(0).cast("bigint").alias("forecast_volume"), X.zero_numeric().alias("volume_variance_pct"), "event_date")


# ---------------------------------------------------------------- G8 with a state that merges
def distinct_state(rows: DataFrame, groups: list[str], id_col: str) -> DataFrame:
    """Per group and bucket of ids: the ids present as a bitmap of 4 KB, and a sketch of them."""
    ids = rows.where(F.col(id_col).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(id_col))
    return ids.groupBy(*groups, "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits"), F.hll_sketch_agg(id_col).alias("sketch"))


def merge_distinct(states: DataFrame, groups: list[str]) -> DataFrame:
    return states.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(state: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: the exact number of ids, and the sketch's estimate."""
    return state.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias("exact"),
                                      F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


SITE_DAY = ["site_code", "event_date"]


def site_day_states(fact: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sums and distinct agents per site and day. The fact is reduced to one row per agent and day before the join."""
    joined = agent_day_partials(fact).join(dim.select("agent_sk", "site_code"), "agent_sk", "inner")
    sums = joined.groupBy(*SITE_DAY).agg(
        F.count("*").alias("n_rows"), F.sum(F.coalesce("occ", F.lit(0))).alias("occ_sum"), F.count("occ").alias("occ_n"),
        F.sum(F.coalesce("secs", F.lit(0))).alias("secs_sum"), F.sum("secs_n").alias("secs_n"))
    return sums, distinct_state(joined, SITE_DAY, "agent_sk")


def refresh_site_daily(spark: SparkSession, sums_path: str, ids_path: str, fact: DataFrame, dim: DataFrame,
                       restated: bool = False) -> list[str]:
    """Merge new rows of the fact into the stored states of agg_site_daily; returns the touched days.

    Rows add up and ids are united, so a day may grow in as many steps as it
    likes. With ``restated`` the rows are the whole of their days, whose old state is dropped.
    """
    reduced = [_stored(s, "site-delta") for s in site_day_states(fact, dim)]
    touched = [r[0] for r in reduced[0].select(F.col("event_date").cast("string")).distinct().collect()]
    if not touched:
        return []
    days = L.in_partitions("event_date", [L._folder(t) for t in touched])
    for path, delta, merge in ((sums_path, reduced[0], merged_state), (ids_path, reduced[1], merge_distinct)):
        old = spark.read.schema(delta.schema).parquet(path).where(days)
        L.replace_partitions(spark, path, delta if restated else merge(old.unionByName(delta), SITE_DAY),
                             "event_date", ["site_code"], touched)
    return sorted(touched, key=str)


def site_daily_view(sums: DataFrame, ids: DataFrame, estimate: bool = False) -> DataFrame:
    """agg_site_daily (A4) from its states, with its declared columns; ``estimate``: agents by the sketch."""
    counts = distinct_counts(ids, SITE_DAY).withColumnsRenamed({c: f"_{c}" for c in SITE_DAY})
    joined = sums.join(counts, F.col("site_code").eqNullSafe(F.col("_site_code"))
                       & F.col("event_date").eqNullSafe(F.col("_event_date")), "left")
    return joined.select(
        "site_code", F.coalesce(F.col("estimate" if estimate else "exact"), F.lit(0)).cast("bigint").alias("agents_active"),
        summed("occ").alias("interactions"), X.exact_mean(F.col("secs_sum"), F.col("secs_n")).alias("avg_handle_seconds"),
        X.zero_numeric().alias("sl_pct"), X.zero_numeric().alias("adherence_pct"), "event_date")
