"""Registered queries: the four materialized aggregates over the bindings.

The oracle SQL does not go through the bindings' tables: it counts raw
``events`` and ``customer`` rows, so it tests the bindings as well.
"""

from __future__ import annotations

from switchboard.operators import aggregates as A
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.oracle import exact_mean

# One row per raw event: its day, its hundredths of ``value`` as seconds, and its agent's site.
_RAW = """
raw AS (SELECT e.user_id, c.c_nationkey AS nation, CAST(e.ts AS DATE) AS day, e.ts, e.event_type AS kind,
               CAST(ROUND(e.value * 100) AS BIGINT) AS secs
        FROM customer c JOIN events e ON e.user_id = c.c_custkey)"""
_ZERO = "CAST(0 AS DECIMAL(38,9))"

# ---------------------------------------------------------------- A1
# The states of an agent's day are its kinds of events; the mean is per state.
A1_SQL = f"""
WITH {_RAW},
days AS (SELECT user_id, nation, day, COUNT(*) AS events, COUNT(DISTINCT kind) AS kinds, SUM(secs) AS total,
                SUM(secs) FILTER (kind = 'click') AS clicks, SUM(secs) FILTER (kind = 'view') AS views,
                SUM(secs) FILTER (kind IN ('purchase', 'signup')) AS others
         FROM raw GROUP BY ALL)
SELECT user_id AS agent_sk, concat('SITE_', nation) AS site_code, events AS interactions_handled,
       {exact_mean("total", "kinds")} AS avg_handle_seconds,
       CAST(COALESCE(clicks, 0) AS BIGINT) AS talk_seconds, CAST(COALESCE(views, 0) AS BIGINT) AS acw_seconds,
       CAST(COALESCE(others, 0) AS BIGINT) AS aux_seconds,
       {_ZERO} AS adherence_pct, {_ZERO} AS occupancy_pct, day AS event_date
FROM days"""


@register("agg_agent_daily", A1_SQL)
def agg_agent_daily(spark, sf):
    return A.agg_agent_daily(B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf))


# ---------------------------------------------------------------- A2
A2_SQL = f"""
WITH {_RAW},
weeks AS (SELECT user_id, nation, CAST(day - CAST(isodow(day) - 1 AS INTEGER) AS DATE) AS monday,
                 COUNT(DISTINCT day) AS days, COUNT(*) AS events, CAST(SUM(secs) AS DOUBLE) AS total
          FROM raw GROUP BY ALL)
SELECT user_id AS agent_sk, concat('SITE_', nation) AS site_code, days AS days_worked, events AS interactions_handled,
       CAST(total / events AS DECIMAL(38,9)) AS avg_handle_seconds,
       {_ZERO} AS adherence_pct, {_ZERO} AS occupancy_pct, monday AS week_start_date
FROM weeks"""


@register("agg_agent_weekly", A2_SQL)
def agg_agent_weekly(spark, sf):
    return A.agg_agent_weekly(B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf))


# ---------------------------------------------------------------- A3
# 25 queues by user id; the service level is per half hour with events.
A3_SQL = f"""
WITH hours AS (SELECT user_id % 25 AS queue, CAST(ts AS DATE) AS day, CAST(hour(ts) AS BIGINT) AS h, COUNT(*) AS calls,
                      COUNT(*) FILTER (event_type = 'error') AS lost,
                      COUNT(*) FILTER (event_type <> 'error' AND value < 20) AS quick,
                      COUNT(DISTINCT minute(ts) >= 30) AS halves
               FROM events GROUP BY ALL)
SELECT queue AS queue_sk, h AS hour_of_day, calls AS offered, calls - lost AS answered, lost AS abandoned,
       {exact_mean("quick", "halves")} AS sl_pct,
       CAST(0 AS BIGINT) AS forecast_volume, {_ZERO} AS volume_variance_pct, day AS event_date
FROM hours"""


@register("agg_queue_hourly", A3_SQL)
def agg_queue_hourly(spark, sf):
    return A.agg_queue_hourly(B.fact_queue_interval(spark, sf))


# ---------------------------------------------------------------- A4
A4_SQL = f"""
WITH {_RAW},
sites AS (SELECT nation, day, COUNT(*) AS events, COUNT(DISTINCT user_id) AS agents,
                 COUNT(DISTINCT (user_id, kind)) AS states, SUM(secs) AS total
          FROM raw GROUP BY ALL)
SELECT concat('SITE_', nation) AS site_code, agents AS agents_active, events AS interactions,
       {exact_mean("total", "states")} AS avg_handle_seconds,
       {_ZERO} AS sl_pct, {_ZERO} AS adherence_pct, day AS event_date
FROM sites"""


@register("agg_site_daily", A4_SQL)
def agg_site_daily(spark, sf):
    return A.agg_site_daily(B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf))
