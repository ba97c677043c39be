"""Registered queries: multi-level and filled aggregates."""

from __future__ import annotations

from switchboard.operators import aggregates as A
from switchboard.operators import rollups as R
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.oracle import BINDINGS, cents, exact_mean, exact_ratio, with_ctes
from switchboard.plans.q_aggregates import A1_SQL, A3_SQL, A4_SQL

PROGRAM_LOB_SQL = """
  SELECT s_suppkey AS program_sk, r_name AS line_of_business
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# ---------------------------------------------------------------- C4
C4_SQL = f"""
WITH fbl AS ({BINDINGS['fact_billing_line']}), prog AS ({PROGRAM_LOB_SQL})
SELECT client_sk, program_sk, line_of_business, CAST(COUNT(*) AS BIGINT) AS interactions,
       {exact_ratio(f"SUM({cents('qty')})", "100 * COUNT(qty)", 2, 8)} AS avg_handle_seconds,
       CAST(NULL AS DECIMAL(5,2)) AS avg_csat,
       CAST(SUM(line_amount) AS DECIMAL(14,2)) AS billed_amount,
       CAST(GROUPING(client_sk, program_sk, line_of_business) AS BIGINT) AS grouping_level,
       period_month_date
FROM fbl LEFT JOIN prog USING (program_sk)
GROUP BY GROUPING SETS ((period_month_date, client_sk, program_sk, line_of_business),
                        (period_month_date, client_sk), (period_month_date))"""


@register("program_monthly_grouping_sets", C4_SQL)
def program_monthly_grouping_sets(spark, sf):
    return R.program_monthly(B.fact_billing_line(spark, sf), B.program_lob(spark, sf))


# ---------------------------------------------------------------- C5
C5_SQL = with_ctes(f"""
SELECT client_sk, program_sk, site_code, CAST(COUNT(*) AS BIGINT) AS surveys,
       {exact_ratio("SUM(csat_score)", "COUNT(csat_score)")} AS avg_csat,
       {exact_ratio("100 * COUNT(*) FILTER (WHERE nps_score >= 9)", "COUNT(*)")} AS pct_promoters,
       {exact_ratio("100 * COUNT(*) FILTER (WHERE nps_score <= 6)", "COUNT(*)")} AS pct_detractors,
       CAST(GROUPING(client_sk, program_sk, site_code) AS BIGINT) AS grouping_id,
       period_month_date
FROM (SELECT *, CAST(date_trunc('month', event_date) AS DATE) AS period_month_date FROM fact_csat_survey) s
GROUP BY GROUPING SETS ((period_month_date, client_sk, program_sk, site_code),
                        (period_month_date, client_sk, program_sk), (period_month_date, client_sk),
                        (period_month_date))""", "fact_csat_survey")


@register("csat_rollup_monthly", C5_SQL)
def csat_rollup_monthly(spark, sf):
    return R.csat_rollup_monthly(B.fact_csat_survey(spark, sf))


# ---------------------------------------------------------------- C6
C6_SQL = f"""
WITH fbl AS ({BINDINGS['fact_billing_line']}),
b AS (SELECT client_sk, program_sk, period_month_date, SUM(line_amount) AS b FROM fbl GROUP BY ALL),
c AS (SELECT o_custkey AS client_sk, l_suppkey AS program_sk,
             CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS period_month_date,
             SUM({cents('l_extendedprice * l_discount')}) AS c
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY ALL),
t AS (SELECT o_custkey AS client_sk, CAST(NULL AS BIGINT) AS program_sk,
             CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS period_month_date,
             SUM({cents('o_totalprice')} // 100) AS t
      FROM orders GROUP BY ALL),
j AS (SELECT * FROM b FULL JOIN c USING (client_sk, program_sk, period_month_date)
                      FULL JOIN t USING (client_sk, program_sk, period_month_date)),
v AS (SELECT client_sk, program_sk, period_month_date,
             CAST(COALESCE(b, 0) AS DECIMAL(14,2)) AS billed_amount,
             CAST(CAST(COALESCE(c, 0) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS sla_credit_amount,
             CAST(CAST(COALESCE(t, 0) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS telco_cost_amount
      FROM j)
SELECT client_sk, program_sk, billed_amount, sla_credit_amount, telco_cost_amount,
       CAST(billed_amount - sla_credit_amount - telco_cost_amount AS DECIMAL(14,2)) AS net_revenue,
       period_month_date
FROM v"""


@register("billing_monthly_net", C6_SQL)
def billing_monthly_net(spark, sf):
    return R.billing_monthly_net(B.billed_lines(spark, sf), B.telco_costs(spark, sf))


# ---------------------------------------------------------------- C7
C7_SQL = f"""
WITH h AS ({A3_SQL}),
f AS (SELECT queue_sk, hour_of_day, event_date + 1 AS event_date, offered AS forecast_volume FROM h)
SELECT h.queue_sk, h.hour_of_day, h.offered, h.answered, h.abandoned, h.sl_pct, f.forecast_volume,
       CAST(CAST((h.offered - f.forecast_volume) * 100 AS DOUBLE) / NULLIF(f.forecast_volume, 0) AS DECIMAL(38,9))
         AS volume_variance_pct,
       h.event_date
FROM h LEFT JOIN f ON h.queue_sk = f.queue_sk AND h.hour_of_day = f.hour_of_day AND h.event_date = f.event_date"""


@register("queue_hourly_forecast", C7_SQL)
def queue_hourly_forecast(spark, sf):
    hourly = A.agg_queue_hourly(B.fact_queue_interval(spark, sf))
    return R.queue_hourly_forecast(hourly, R.previous_day_forecast(hourly))


# ---------------------------------------------------------------- C17
C17_SQL = with_ctes(f"""
SELECT agent_sk, scheduled_minutes, worked_minutes, exception_minutes, timeoff_minutes,
       {exact_ratio("worked_minutes * 100", "scheduled_minutes")} AS adherence_pct,
       {exact_ratio("GREATEST(worked_minutes - exception_minutes - timeoff_minutes, 0) * 100", "worked_minutes")}
         AS occupancy_pct,
       event_date
FROM fact_adherence_daily""", "fact_adherence_daily")


@register("adherence_daily", C17_SQL)
def adherence_daily(spark, sf):
    return R.adherence_daily(B.fact_adherence_daily(spark, sf))


# ---------------------------------------------------------------- C8
C8_SQL = f"""
WITH d AS ({A1_SQL}), a AS ({C17_SQL})
SELECT d.agent_sk, d.site_code, d.interactions_handled, d.avg_handle_seconds, d.talk_seconds, d.acw_seconds,
       d.aux_seconds, CAST(a.adherence_pct AS DECIMAL(38,9)) AS adherence_pct,
       CAST(a.occupancy_pct AS DECIMAL(38,9)) AS occupancy_pct, d.event_date
FROM d LEFT JOIN a ON d.agent_sk = a.agent_sk AND d.event_date = a.event_date"""


@register("agent_daily_adherence", C8_SQL)
def agent_daily_adherence(spark, sf):
    daily = A.agg_agent_daily(B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf))
    return R.fill_agent_daily(daily, R.adherence_daily(B.fact_adherence_daily(spark, sf)))


# ---------------------------------------------------------------- C8, A4 part
C8_SITE_SQL = f"""
WITH s AS ({A4_SQL}),
adh AS (SELECT d.site_code, a.event_date, SUM(CAST(a.adherence_pct * 100 AS BIGINT)) AS c, COUNT(a.adherence_pct) AS n
        FROM ({C17_SQL}) a JOIN ({BINDINGS['dim_agent']}) d ON a.agent_sk = d.agent_sk
        GROUP BY d.site_code, a.event_date),
sl AS (SELECT event_date, SUM(answered_in_sl) AS in_sl, SUM(offered) AS offered
       FROM ({BINDINGS['fact_queue_interval']}) q GROUP BY event_date)
SELECT s.site_code, s.agents_active, s.interactions, s.avg_handle_seconds,
       {exact_mean("sl.in_sl * 100", "NULLIF(sl.offered, 0)")} AS sl_pct,
       {exact_mean("adh.c", "adh.n * 100")} AS adherence_pct,
       s.event_date
FROM s LEFT JOIN adh ON s.site_code = adh.site_code AND s.event_date = adh.event_date
LEFT JOIN sl ON s.event_date = sl.event_date"""


@register("site_daily_service_level", C8_SITE_SQL)
def site_daily_service_level(spark, sf):
    fact, dim = B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf)
    site = A.agg_site_daily(fact, dim)
    adherence = R.adherence_daily(B.fact_adherence_daily(spark, sf))
    return R.fill_site_daily(site, adherence, dim, B.fact_queue_interval(spark, sf))
