"""Change feeds, current state and history.

Latest-wins is written as ``max(struct(order..., payload...))`` per key
rather than ``row_number()`` over a window: it is an ordinary aggregate, so
Spark combines it map-side before the shuffle and a key holding a third of
all changes reaches the reducer as one row per map task, never as a third of
the table in one sort.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchboard.session import fresh_path

# Change-feed op codes (not given by the reference; I/U/D assumed).
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (ties broken by later entries)."""
    payload = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + payload])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + payload])


def cdc_state(feed: DataFrame, keys: list[str], change_col: str = "change_ms",
              tie_col: str = "change_id") -> DataFrame:
    """Last change per key, deletes included: the state that later deltas merge into."""
    return latest_per_key(feed, keys, [change_col, tie_col])


def cdc_current(state: DataFrame, change_col: str = "change_ms", op_col: str = "op") -> DataFrame:
    """What a reader of a state sees: no deleted keys; a NULL op is no delete.

    ``last_change_ts`` is the change time decoded from epoch milliseconds.
    """
    return (state.filter(~F.col(op_col).eqNullSafe(OP_DELETE))
            .withColumn("last_change_ts", F.timestamp_millis(change_col)))


def cdc_latest_wins(feed: DataFrame, keys: list[str], change_col: str = "change_ms",
                    tie_col: str = "change_id", op_col: str = "op") -> DataFrame:
    """Current rows of a whole change feed: last change per key, deletes removed."""
    return cdc_current(cdc_state(feed, keys, change_col, tie_col), change_col, op_col)


def cdc_merge_into_base(state: DataFrame, delta: DataFrame, keys: list[str],
                        change_col: str = "change_ms", tie_col: str = "change_id") -> DataFrame:
    """The state after a delta feed: latest-wins over state and delta rows, deletes included.

    A key's delete stays in the state, so an update that is older than the
    delete and arrives after it does not bring the key back.
    """
    cols = delta.columns
    return cdc_state(state.select(*cols).unionByName(delta.select(*cols)), keys, change_col, tie_col)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """MERGE: delta rows replace base rows with the same key, new keys are inserted.

    Only the delta is reduced to one row per key (the greatest ``order``); a
    base row goes only if the delta has its key, so base rows that share a
    key all stay. A NULL key matches nothing in a MERGE: such rows of either
    side pass through.
    """
    cols = list(base.columns)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    incoming = delta.select(*cols)
    last = latest_per_key(incoming.filter(~null_key), keys, list(order or [])).select(*cols)
    kept = base.select(*cols).join(last.select(*keys), keys, "left_anti").select(*cols)
    return kept.unionByName(last).unionByName(incoming.filter(null_key))


RANGE = "_range"


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` dealt out by ranges of ``order`` (NULL first), with its range's number in ``_range``.

    This is the only shuffle of an ordered pass. The rows are stored under the
    shared folder as a table bucketed by the range number, so that windows and
    aggregates per range find their rows together, and several passes read one
    shuffle's result. A range ends wherever the row counts say, inside a key
    or inside an instant, so a hot key is spread like any other rows. The
    catalog entry only carries the bucketing; it is dropped at once.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"ranges_{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in order]).withColumn(RANGE, F.spark_partition_id())
    dealt.write.format("parquet").bucketBy(ranges, RANGE).option("path", fresh_path(spark, "ranges")).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def _beside(edges: DataFrame, value: str, forward: bool = False) -> DataFrame:
    """(_range, _beside): the non-NULL ``value`` of the nearest earlier (``forward``: later) range.

    ``edges`` has one row per range, so this window and the broadcast of its
    result hold as many rows as there are shuffle partitions.
    """
    near = F.expr(f"{'lead' if forward else 'lag'}({value}) IGNORE NULLS OVER (ORDER BY {RANGE})")
    return F.broadcast(edges.select(RANGE, near.alias("_beside")))


def scd2_rows(df: DataFrame, key: str, ts_col: str, attrs: list[str], tie_col: str | None = None) -> DataFrame:
    """Every change with ``eff_from_ts``, ``eff_to_ts``, ``is_current`` and ``kept``.

    ``kept`` rows are the type-2 history: changes of ``attrs`` (NULL-safe)
    against the change before of the same key. The others confirm what was
    known; their ``eff_to_ts`` is NULL and ``is_current`` false. NULL keys form
    one history, as in PARTITION BY.

    One ordered pass: rows lie in ranges of (key, time, tie); ``lag`` and
    ``lead`` run inside a range, and what they cannot see -- the last change
    before it, the first kept start after it -- is one row per range.
    """
    order = [key, ts_col] + ([tie_col] if tie_col else [])
    rows = in_ranges(df, order).withColumn("_a", F.struct(*[F.col(a) for a in attrs])).withColumn(
        "_o", F.struct(*[F.col(c) for c in order])).withColumn("_me", F.struct(F.col(key).alias("k"), F.col("_a").alias("a")))
    w = Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    last = rows.groupBy(RANGE).agg(F.max(F.struct("_o", "_me")).getField("_me").alias("_last"))
    prev = F.coalesce("_before", "_beside")
    marked = (rows.withColumn("_before", F.lag("_me").over(w)).join(_beside(last, "_last"), RANGE, "left")
              .withColumn("kept", ~F.coalesce(prev.getField("k").eqNullSafe(F.col(key)) & prev.getField("a").eqNullSafe(F.col("_a"))
                                              & prev.isNotNull(), F.lit(False)))
              .drop("_before", "_beside"))
    start = F.when(F.col("kept"), F.struct(F.col(key).alias("k"), F.col(ts_col).alias("t")))
    marked = marked.withColumn("_start", start)
    first = marked.groupBy(RANGE).agg(F.min(F.when(F.col("kept"), F.struct("_o", "_start"))).getField("_start").alias("_first"))
    # lead, as a frame that ends at UNBOUNDED FOLLOWING is evaluated anew for every row
    after = F.expr(f"lead(_start) IGNORE NULLS OVER (PARTITION BY {RANGE} ORDER BY "
                   + ", ".join(f"`{c}` ASC NULLS FIRST" for c in order) + ")")
    nxt = F.coalesce("_after", "_beside")
    end = F.when(F.col("kept") & nxt.getField("k").eqNullSafe(F.col(key)), nxt.getField("t"))
    return (marked.withColumn("_after", after).join(_beside(first, "_first", forward=True), RANGE, "left")
            .withColumn("eff_from_ts", F.col(ts_col).cast("timestamp"))
            .withColumn("eff_to_ts", end.cast("timestamp"))
            .withColumn("is_current", F.col("kept") & F.col("eff_to_ts").isNull())
            .drop(RANGE, "_a", "_o", "_me", "_start", "_after", "_beside"))


def history_id(key: str, tie_col: str | None = None) -> Column:
    """Id of a validity row: key, start and tie, so two changes at one instant have ids of their own."""
    parts = [F.col(key).cast("string"), F.unix_micros(F.col("eff_from_ts")).cast("string")]
    return F.concat_ws(":", *parts, *([F.col(tie_col).cast("string")] if tie_col else []))


def scd2_history(df: DataFrame, key: str, ts_col: str, attrs: list[str], tie_col: str | None = None,
                 id_col: str = "history_id") -> DataFrame:
    """Type-2 history: one validity row per change of ``attrs``.

    Consecutive rows with equal attributes collapse into the first;
    ``eff_to_ts`` is the next kept row's start, ``is_current`` marks the open row.
    """
    return (scd2_rows(df, key, ts_col, attrs, tie_col).filter("kept").drop("kept")
            .withColumn(id_col, history_id(key, tie_col)))


def asof_join(events: DataFrame, history: DataFrame, key: str, ts_col: str, hist_cols: list[str]) -> DataFrame:
    """Each event with the ``hist_cols`` of the history row valid at its time.

    Valid means ``eff_from_ts <= ts < eff_to_ts`` (open end when NULL).
    Written as one ordered pass, not a range join: history rows and events are
    unioned and dealt out by ranges of (key, time), with a history row before
    an event at the same instant; each event takes the last history row seen
    so far, in its range or, by one row per range, in an earlier one. That is
    linear in the rows, where an equi-join on the key plus a range filter
    would pair every event of a hot key with every history row of it. A NULL
    key matches no history.
    """
    ev_cols = events.columns
    h_struct = F.struct(F.col(key).alias("k"), *[F.col(c) for c in ["eff_from_ts", "eff_to_ts"] + hist_cols])
    h = history.filter(F.col(key).isNotNull()).select(
        F.col(key), F.col("eff_from_ts").cast("timestamp").alias("_t"), F.lit(0).alias("_kind"),
        F.col("eff_to_ts").isNull().alias("_open"), F.col("eff_to_ts").alias("_end"), h_struct.alias("_h"),
        F.lit(0).cast("bigint").alias("_tie"),
        *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ev_cols if c != key])
    e = events.select(
        F.col(key), F.col(ts_col).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast("boolean").alias("_open"), F.lit(None).cast("timestamp").alias("_end"),
        F.lit(None).cast(h.schema["_h"].dataType).alias("_h"), F.xxhash64(*[F.col(c) for c in ev_cols]).alias("_tie"),
        *[F.col(c) for c in ev_cols if c != key])
    order = [key, "_t", "_kind", "_open", "_end", "_tie"]
    rows = in_ranges(h.unionByName(e), order)
    w = (Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = rows.groupBy(RANGE).agg(F.max(F.when(F.col("_kind") == 0, F.struct(*order, "_h"))).getField("_h").alias("_last"))
    seen = (rows.withColumn("_seen", F.last("_h", ignorenulls=True).over(w)).filter(F.col("_kind") == 1)
            .join(_beside(last, "_last"), RANGE, "left"))
    cur = F.coalesce("_seen", "_beside")
    valid = (cur.getField("k") == F.col(key)) & (cur.getField("eff_to_ts").isNull() | (F.col("_t") < cur.getField("eff_to_ts")))
    return seen.select(*[F.col(c) for c in ev_cols],
                       *[F.when(valid, cur.getField(c)).alias(c) for c in ["eff_from_ts"] + hist_cols])


def pick_max(df: DataFrame, group: list[str], order: list[Column], payload: list[str]) -> DataFrame:
    """Per group, the payload of the row with the greatest ``order`` tuple."""
    best = F.max(F.struct(*order, *[F.col(c).alias(c) for c in payload])).alias("_best")
    return df.groupBy(*group).agg(best).select(*group, *[F.col(f"_best.{c}").alias(c) for c in payload])
