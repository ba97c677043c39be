"""Registered queries: stored results maintained by deltas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import incremental as I
from switchboard.operators import layout as L
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.oracle import scd2_sql
from switchboard.plans.q_aggregates import A3_SQL, A4_SQL
from switchboard.session import fresh_path
from switchboard.sources.tables import table

# ---------------------------------------------------------------- C3, incremental
# orders as status changes of their customer. Stored first: those before 1998,
# but for one in fifty of 1997, which come late. Then the late ones are merged
# (they split, close and reopen stored rows), then those of 1998.
MERGE_YEAR = 1998
LATE_EVERY = 50


@register("scd2_incremental_merge", scd2_sql(
    "SELECT o_custkey AS agent_id, o_orderstatus AS status, o_orderdate AS changed_at, o_orderkey AS seq FROM orders",
    "agent_id", "changed_at", ["status"], "seq", "agent_history_id"))
def scd2_incremental_merge(spark, sf):
    changes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("agent_id"), F.col("o_orderstatus").alias("status"),
        X.as_instant("o_orderdate").alias("changed_at"), F.col("o_orderkey").alias("seq"))
    new = F.year("changed_at") >= MERGE_YEAR
    late = ~new & (F.year("changed_at") == MERGE_YEAR - 1) & (F.col("seq") % LATE_EVERY == 0)
    path, by = fresh_path(spark, "ods_agent_scd2"), ("agent_id", "changed_at", ["status"], "seq")
    I.build_scd2(spark, path, changes.where(~new & ~late), *by)
    for delta in (changes.where(late), changes.where(new)):
        I.merge_scd2(spark, path, delta, *by)
    return I.read_scd2(spark, path, changes, "agent_id", "seq", "agent_history_id").select(
        "agent_history_id", "agent_id", "status", "eff_from_ts", "eff_to_ts", "is_current")


# ---------------------------------------------------------------- S12 of agg_queue_hourly
# Stored: the days before the split, of which the last one is wrong by one
# call, and a day that never was. The delta corrects the former (both images),
# deletes the latter (before images only) and brings the other days.
SPLIT = dt.date(2024, 1, 16)
STRAY_DAYS = 400


@register("mv_signed_delta_queue_hourly", A3_SQL)
def mv_signed_delta_queue_hourly(spark, sf):
    fact = B.fact_queue_interval(spark, sf)
    last = F.lit(SPLIT - dt.timedelta(days=1))
    of_last = fact.where(F.col("event_date") == last)
    wrong = of_last.withColumn("offered", F.col("offered") + 1).withColumn("answered_in_sl", F.lit(None).cast("bigint"))
    stray = of_last.withColumn("event_date", F.date_add("event_date", STRAY_DAYS))
    stored = fact.where(F.col("event_date") < last).unionByName(wrong).unionByName(stray)
    path, groups = fresh_path(spark, "agg_queue_hourly"), I.queue_hour_groups()
    state = I.signed_state(stored, groups, I.QUEUE_MEASURES)
    L.write_layout(state, path, "event_date", ["queue_sk", "hour_of_day"])
    I.apply_signed(spark, path, wrong.unionByName(stray), fact.where(F.col("event_date") >= last), groups,
                   I.QUEUE_MEASURES, "event_date", ["queue_sk", "hour_of_day"])
    return I.queue_hourly_view(spark.read.schema(state.schema).parquet(path))


# ---------------------------------------------------------------- S12 and G8 of agg_site_daily
@register("mv_distinct_state_site_daily", A4_SQL)
def mv_distinct_state_site_daily(spark, sf):
    """Every day arrives in two parts, by agent; the second part is merged into the stored states."""
    fact, dim = B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf)
    paths = [fresh_path(spark, "agg_site_daily_sums"), fresh_path(spark, "agg_site_daily_ids")]
    second = (F.col("event_date") >= F.lit(SPLIT)) & (F.col("agent_sk") % 3 > 0)
    states = I.site_day_states(fact.where(~second), dim)
    for path, state in zip(paths, states):
        L.write_layout(state, path, "event_date", ["site_code"])
    I.refresh_site_daily(spark, *paths, fact.where(second), dim)
    return I.site_daily_view(*(spark.read.schema(s.schema).parquet(p) for p, s in zip(paths, states)))
