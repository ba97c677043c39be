"""The four materialized aggregates (A1-A4) as DataFrame functions.

Inputs carry the reference column names (``fact_agent_activity``,
``dim_agent``, ``fact_queue_interval``). Output columns are in the declared
order with the partition column last.

Plan shape (A1, A2, A4). The fact is first reduced to one row per
(agent_sk, day) -- a partial aggregate before any join shuffle -- and only
then joined to the dimension and re-aggregated. This is exact: the join key
is in the pre-aggregate's group, so a dimension key present twice still fans
out every fact row twice, and means are carried as (sum, count). It also
means a hot agent that holds a third of the fact rows arrives at the join as
one row per day, not as a third of the table in one task. The join itself is
left to Catalyst: the dimension is broadcast only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (or AQE sees it small at run
time); otherwise it is a shuffle join with AQE's skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.functions import decode as X

# Declared output schemas of the four materialized aggregates
# (column order as declared, partition column last).
DECLARED = {
    "agg_agent_daily": "agent_sk bigint, site_code string, interactions_handled bigint, "
                       "avg_handle_seconds decimal(38,9), talk_seconds bigint, acw_seconds bigint, "
                       "aux_seconds bigint, adherence_pct decimal(38,9), occupancy_pct decimal(38,9), "
                       "event_date date",
    "agg_agent_weekly": "agent_sk bigint, site_code string, days_worked bigint, interactions_handled bigint, "
                        "avg_handle_seconds decimal(38,9), adherence_pct decimal(38,9), "
                        "occupancy_pct decimal(38,9), week_start_date date",
    "agg_queue_hourly": "queue_sk bigint, hour_of_day bigint, offered bigint, answered bigint, abandoned bigint, "
                        "sl_pct decimal(38,9), forecast_volume bigint, volume_variance_pct decimal(38,9), "
                        "event_date date",
    "agg_site_daily": "site_code string, agents_active bigint, interactions bigint, "
                      "avg_handle_seconds decimal(38,9), sl_pct decimal(38,9), adherence_pct decimal(38,9), "
                      "event_date date",
}

def _state_sum(code_match, value: str = "state_seconds"):
    # SUM(CASE WHEN cond THEN x ELSE 0 END): 0, not NULL, when nothing matches;
    # a NULL state_code falls to the ELSE branch.
    return F.sum(F.when(code_match, F.col(value)).otherwise(F.lit(0)))


def agent_day_partials(fact: DataFrame) -> DataFrame:
    """fact_agent_activity reduced to (agent_sk, event_date): the pieces every agent aggregate needs."""
    code = F.col("state_code")
    return fact.groupBy("agent_sk", "event_date").agg(
        F.sum("occurrence_count").alias("occ"),
        F.sum("state_seconds").alias("secs"),
        F.count("state_seconds").alias("secs_n"),
        _state_sum(code == "TALK").alias("talk"),
        _state_sum(code == "ACW").alias("acw"),
        _state_sum(code.like("AUX%")).alias("aux"),
    )


def _join_dim(partials: DataFrame, dim: DataFrame) -> DataFrame:
    return partials.join(dim.select("agent_sk", "site_code"), "agent_sk", "inner")


def agg_agent_daily(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A1: daily agent activity (star join fact_agent_activity ⋈ dim_agent)."""
    joined = _join_dim(agent_day_partials(fact), dim)
    return (
        joined.groupBy("agent_sk", "site_code", "event_date")
        .agg(
            F.sum("occ").alias("interactions_handled"),
            X.exact_mean(F.sum("secs"), F.sum("secs_n")).alias("avg_handle_seconds"),
            F.sum("talk").alias("talk_seconds"),
            F.sum("acw").alias("acw_seconds"),
            F.sum("aux").alias("aux_seconds"),
        )
        .select(
            "agent_sk", "site_code", "interactions_handled", "avg_handle_seconds", "talk_seconds",
            "acw_seconds", "aux_seconds",
            X.zero_numeric().alias("adherence_pct"), X.zero_numeric().alias("occupancy_pct"),
            "event_date",
        )
    )


def agg_agent_weekly(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A2: ISO-week agent roll-up; average handle time is total seconds / total occurrences.

    ``COUNT(DISTINCT event_date)`` is computed as a count over one row per
    (agent, site, week, day) -- a grouping the (agent, day) partitioning
    already clusters, so it costs no exchange and avoids the Expand-based
    distinct rewrite.
    """
    joined = _join_dim(agent_day_partials(fact), dim)
    week = X.iso_week_start("event_date").alias("week_start_date")
    per_day = joined.groupBy("agent_sk", "site_code", week, "event_date").agg(
        F.sum("occ").alias("occ"), F.sum("secs").alias("secs"))
    return (
        per_day.groupBy("agent_sk", "site_code", "week_start_date")
        .agg(
            F.count("event_date").alias("days_worked"),
            F.sum("occ").alias("interactions_handled"),
            X.safe_ratio_numeric(F.sum("secs"), F.sum("occ")).alias("avg_handle_seconds"),
        )
        .select(
            "agent_sk", "site_code", "days_worked", "interactions_handled", "avg_handle_seconds",
            X.zero_numeric().alias("adherence_pct"), X.zero_numeric().alias("occupancy_pct"),
            "week_start_date",
        )
    )


def agg_queue_hourly(fact_queue_interval: DataFrame) -> DataFrame:
    """A3: queue intervals by UTC hour of the interval start and the fact's own event_date.

    ``sl_pct`` is the mean of ``answered_in_sl`` as the reference defines it.
    """
    return (
        fact_queue_interval.groupBy(
            "queue_sk", X.hour_of_day("interval_start_ts").alias("hour_of_day"), "event_date")
        .agg(
            F.sum("offered").alias("offered"),
            F.sum("answered").alias("answered"),
            F.sum("abandoned").alias("abandoned"),
            X.exact_mean(F.sum("answered_in_sl"), F.count("answered_in_sl")).alias("sl_pct"),
        )
        .select(
            "queue_sk", "hour_of_day", "offered", "answered", "abandoned", "sl_pct",
            F.lit(0).cast("bigint").alias("forecast_volume"),
            X.zero_numeric().alias("volume_variance_pct"),
            "event_date",
        )
    )


def agg_site_daily(fact: DataFrame, dim: DataFrame, rsd: float | None = None) -> DataFrame:
    """A4: site/day roll-up with its declared columns.

    The joined (agent, day) partials are first combined per (site, day,
    agent) -- no exchange, the (agent, day) partitioning already clusters it --
    so each agent is one row per site-day and ``agents_active``, declared as an
    approximate distinct count, is exact at no cost: a plain count. With
    ``rsd`` it is an HLL++ estimate of that relative error instead.
    """
    joined = _join_dim(agent_day_partials(fact), dim)
    per_agent = joined.groupBy("site_code", "event_date", "agent_sk").agg(
        F.sum("occ").alias("occ"), F.sum("secs").alias("secs"), F.sum("secs_n").alias("secs_n"))
    active = F.count("agent_sk") if rsd is None else F.approx_count_distinct("agent_sk", rsd)
    out = per_agent.groupBy("site_code", "event_date").agg(
        active.alias("agents_active"), F.sum("occ").alias("interactions"),
        X.exact_mean(F.sum("secs"), F.sum("secs_n")).alias("avg_handle_seconds"))
    return out.select("site_code", "agents_active", "interactions", "avg_handle_seconds",
                      X.zero_numeric().alias("sl_pct"), X.zero_numeric().alias("adherence_pct"), "event_date")
