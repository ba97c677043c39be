"""Multi-level and filled monthly / hourly / daily aggregates.

Grouping sets and rollups first reduce the rows to the finest set; the
Expand of GROUPING SETS and the dimension join then see one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.functions import decode as X

# NPS convention (not given by the reference): promoters score
# 9-10, detractors 0-6.
NPS_PROMOTER_MIN = 9
NPS_DETRACTOR_MAX = 6


def program_monthly(lines: DataFrame, programs: DataFrame) -> DataFrame:
    """agg_program_monthly over billing lines, at levels (client, program, lob), (client), ().

    ``grouping_level`` is ``grouping_id()``: 0, 3 and 7 for the three levels
    (the month is in every set, so its bit is always 0).
    """
    finest = lines.groupBy("period_month_date", "client_sk", "program_sk").agg(
        F.count(F.lit(1)).alias("n"), F.sum(X.cents("qty")).alias("cents"), F.count("qty").alias("qty_n"),
        F.sum("line_amount").alias("billed"))
    j = finest.join(programs.select("program_sk", "line_of_business"), "program_sk", "left")
    sets = [["period_month_date", "client_sk", "program_sk", "line_of_business"],
            ["period_month_date", "client_sk"], ["period_month_date"]]
    agg = j.groupingSets(
        [[F.col(c) for c in s] for s in sets],
        "period_month_date", "client_sk", "program_sk", "line_of_business",
    ).agg(
        F.sum("n").alias("interactions"),
        F.sum("cents").alias("_qty_cents"),
        F.sum("qty_n").alias("_qty_n"),
        F.sum("billed").alias("_billed"),
        F.grouping_id().alias("grouping_level"),
    )
    return agg.select(
        "client_sk", "program_sk", "line_of_business", "interactions",
        X.exact_ratio(F.col("_qty_cents"), F.col("_qty_n") * 100, 2, 8).alias("avg_handle_seconds"),
        F.lit(None).cast("decimal(5,2)").alias("avg_csat"),
        F.col("_billed").cast("decimal(14,2)").alias("billed_amount"),
        F.col("grouping_level").cast("bigint").alias("grouping_level"),
        "period_month_date",
    )


def csat_rollup_monthly(surveys: DataFrame) -> DataFrame:
    """agg_csat_rollup_monthly: ROLLUP(client_sk, program_sk, site_code) per month."""
    finest = surveys.groupBy(X.month_start("event_date").alias("period_month_date"), "client_sk", "program_sk", "site_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("csat_score").alias("csat"), F.count("csat_score").alias("csat_n"),
        F.count_if(F.col("nps_score") >= NPS_PROMOTER_MIN).alias("prom"),
        F.count_if(F.col("nps_score") <= NPS_DETRACTOR_MAX).alias("detr"))
    levels = ["period_month_date", "client_sk", "program_sk", "site_code"]
    agg = finest.groupingSets([[F.col(c) for c in levels[:n]] for n in (4, 3, 2, 1)], *levels).agg(
        F.sum("n").alias("surveys"), F.sum("csat").alias("_csat"), F.sum("csat_n").alias("_csat_n"),
        F.sum("prom").alias("_prom"), F.sum("detr").alias("_detr"), F.grouping_id().alias("grouping_id"))
    return agg.select(
        "client_sk", "program_sk", "site_code", "surveys",
        X.exact_ratio(F.col("_csat"), F.col("_csat_n"), 2, 5).alias("avg_csat"),
        X.exact_ratio(F.col("_prom") * 100, F.col("surveys"), 2, 5).alias("pct_promoters"),
        X.exact_ratio(F.col("_detr") * 100, F.col("surveys"), 2, 5).alias("pct_detractors"),
        F.col("grouping_id").cast("bigint").alias("grouping_id"),
        "period_month_date",
    )


def billing_monthly_net(lines: DataFrame, telco: DataFrame) -> DataFrame:
    """agg_billing_monthly: billed − SLA credits − carrier cost per (client, program, month).

    ``lines`` carry the billed ``line_amount`` and, where a line was credited,
    its ``credit_cents``. Lines and carrier costs are stacked (union by name,
    the other measures NULL) and summed per (client_sk, program_sk, period_month_date): one shuffle with
    map-side combining, where chained full outer joins would shuffle every
    side twice and cannot split a hot key. A side with no row counts as 0.
    Carrier cost has no program (program_sk NULL), so it forms its own rows.
    This equals a full outer join on the keys whenever the billed and credit
    sides have no NULL key (they come from line items, which always carry one).
    """
    keys = ["client_sk", "program_sk", "period_month_date"]

    stacked = lines.select(*keys, F.col("line_amount").alias("b"), F.col("credit_cents").alias("c"),
                           F.lit(None).cast("bigint").alias("t")).unionByName(
        telco.select(*keys, F.lit(None).cast("decimal(14,2)").alias("b"), F.lit(None).cast("bigint").alias("c"),
                     F.col("telco_cents").alias("t")))
    j = stacked.groupBy(*keys).agg(F.sum("b").alias("b"), F.sum("c").alias("c"), F.sum("t").alias("t"))
    billed_amt = F.coalesce(F.col("b"), F.lit(0)).cast("decimal(14,2)")
    credit_amt = (F.coalesce(F.col("c"), F.lit(0)).cast("decimal(20,0)") / 100).cast("decimal(12,2)")
    telco_amt = (F.coalesce(F.col("t"), F.lit(0)).cast("decimal(20,0)") / 100).cast("decimal(12,2)")
    return j.select(
        "client_sk", "program_sk",
        billed_amt.alias("billed_amount"), credit_amt.alias("sla_credit_amount"),
        telco_amt.alias("telco_cost_amount"),
        (billed_amt - credit_amt - telco_amt).cast("decimal(14,2)").alias("net_revenue"),
        "period_month_date",
    )


def queue_hourly_forecast(hourly: DataFrame, forecast: DataFrame) -> DataFrame:
    """Fill A3's forecast placeholders from a forecast keyed (queue_sk, hour_of_day, event_date).

    Forecast rows of one key are summed first. variance % = (offered − forecast) / forecast × 100,
    FLOAT64 then NUMERIC; NULL when there is no forecast or it is 0.
    """
    keys = ["queue_sk", "hour_of_day", "event_date"]
    j = hourly.drop("forecast_volume", "volume_variance_pct").join(
        forecast.groupBy(*keys).agg(F.sum("forecast_volume").alias("forecast_volume")), keys, "left")
    variance = X.safe_ratio_numeric((F.col("offered") - F.col("forecast_volume")) * 100, F.col("forecast_volume"))
    return j.select("queue_sk", "hour_of_day", "offered", "answered", "abandoned", "sl_pct",
                    "forecast_volume", variance.alias("volume_variance_pct"), "event_date")


def previous_day_forecast(hourly: DataFrame) -> DataFrame:
    """Forecast for a (queue, hour, day) = offered of the same queue and hour the day before."""
    return hourly.select("queue_sk", "hour_of_day", F.date_add("event_date", 1).alias("event_date"),
                         F.col("offered").alias("forecast_volume"))


def adherence_daily(adherence: DataFrame) -> DataFrame:
    """fact_adherence_daily percentages (C17).

    adherence % = worked / scheduled × 100; occupancy % = (worked − exception −
    time off, at least 0) / worked × 100; both DECIMAL(5,2), NULL on a zero base.
    """
    productive = F.greatest(F.col("worked_minutes") - F.col("exception_minutes") - F.col("timeoff_minutes"),
                            F.lit(0))
    return adherence.select(
        "agent_sk", "scheduled_minutes", "worked_minutes", "exception_minutes", "timeoff_minutes",
        X.exact_ratio(F.col("worked_minutes") * 100, F.col("scheduled_minutes")).alias("adherence_pct"),
        X.exact_ratio(productive * 100, F.col("worked_minutes")).alias("occupancy_pct"),
        "event_date",
    )


def fill_agent_daily(daily: DataFrame, adherence: DataFrame) -> DataFrame:
    """Fill A1's adherence and occupancy placeholders from the agent's adherence row of the day."""
    keys = ["agent_sk", "event_date"]
    a = adherence.select(*keys, F.col("adherence_pct").alias("_adh"), F.col("occupancy_pct").alias("_occ"))
    j = daily.join(a, keys, "left")
    return j.select(
        "agent_sk", "site_code", "interactions_handled", "avg_handle_seconds", "talk_seconds", "acw_seconds",
        "aux_seconds", F.col("_adh").cast(X.NUMERIC).alias("adherence_pct"),
        F.col("_occ").cast(X.NUMERIC).alias("occupancy_pct"), "event_date")


def fill_site_daily(site_daily: DataFrame, adherence: DataFrame, dim: DataFrame,
                    queue_intervals: DataFrame) -> DataFrame:
    """Fill A4's placeholders (C8): ``adherence_pct`` is the mean adherence % of the
    site's agents that day, ``sl_pct`` the day's service level
    Σanswered_in_sl / Σoffered × 100 over all queues. Both are left joins of
    small pre-aggregates (one row per site-day / per day); NUMERIC, HALF_UP once.
    """
    adh = (adherence.join(dim.select("agent_sk", "site_code"), "agent_sk", "inner")
           .groupBy("site_code", "event_date")
           .agg(F.sum((F.col("adherence_pct") * 100).cast("bigint")).alias("_adh_cents"),
                F.count("adherence_pct").alias("_adh_n")))
    sl = queue_intervals.groupBy("event_date").agg(
        F.sum("answered_in_sl").alias("_in_sl"), F.sum("offered").alias("_offered"))
    j = (site_daily.drop("sl_pct", "adherence_pct")
         .join(adh, ["site_code", "event_date"], "left")
         .join(sl, "event_date", "left"))
    return j.select(
        "site_code", "agents_active", "interactions", "avg_handle_seconds",
        X.exact_mean(F.col("_in_sl") * 100, F.nullif(F.col("_offered"), F.lit(0))).alias("sl_pct"),
        X.exact_mean(F.col("_adh_cents"), F.col("_adh_n") * 100).alias("adherence_pct"),
        "event_date")
