"""Bindings: the driver's test tables reshaped into the reference's tables.

Each function returns a DataFrame with the reference table's column names
and declared types (FIXTURES.md Part 2 / Part 3; ``plans/schemas.py``). The
test Parquet stores local date-times (TIMESTAMP_NTZ); declared TIMESTAMP
columns are instants, so they are cast under the UTC session. They are lazy projections and aggregates over
the Parquet inputs, so Catalyst prunes columns and pushes filters through
them into the scan. ``plans/oracle.py`` holds the same bindings as SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import intervals as IV
from switchboard.operators import sessions as S
from switchboard.sources.tables import table

# Binding vocabularies (test-table codes → reference codes).
# event_type → state_code: click TALK, view ACW, purchase AUX1, signup AUX2, error AVAIL
STATE_OF_EVENT = {"click": "TALK", "view": "ACW", "purchase": "AUX1", "signup": "AUX2", "error": "AVAIL"}
# event_type → channel: click VOICE, view CHAT, anything else EMAIL
CHANNEL_OF_EVENT = {"click": "VOICE", "view": "CHAT"}
OTHER_CHANNEL = "EMAIL"
# event_type → change-feed op: signup I (insert), error D (delete), anything else U (update)
OP_OF_EVENT = {"signup": "I", "error": "D"}
OTHER_OP = "U"
QUEUE_COUNT = 25          # queue = user_id % 25
PROGRAM_COUNT = 10        # program = event_id % 10
SL_THRESHOLD_SEC = 20     # answered within service level when value < 20
INTERVAL_MINUTES = 30     # fact_queue_interval bucket length
QUEUE_SNAPSHOTS = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
FEED_SPLIT_DATE = dt.date(2024, 1, 16)   # change feed: base before, delta from
SHIFT_HOURS = 8                          # a shift on every day an agent has events, from 6 + agent % 12 o'clock
OVERTIME_EVERY, OVERTIME_FROM, OVERTIME_TO = 3, 7, 10   # every third agent: overtime, in hours from the shift's start
EXCEPTION_SEC = (900, 1800)              # an error is an exception from 15 minutes before it to 30 after it
TIMEOFF_SEC = (3600, 3600)               # a signup is time off, an hour before and after it
QA_MAX_POINTS = 50
CHAT_TURN_MS = 30000
SITE_PREFIX = "SITE_"


def mapped(c: str | Column, mapping: dict[str, str], default: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for key, value in mapping.items():
        out = (F.when(c == key, value) if out is None else out.when(c == key, value))
    return out.otherwise(F.lit(default)) if default is not None else out


def site_code(nationkey: str | Column) -> Column:
    c = F.col(nationkey) if isinstance(nationkey, str) else nationkey
    return F.concat(F.lit(SITE_PREFIX), c.cast("string"))


# --------------------------------------------------------------------------
# dm facts and dimensions
# --------------------------------------------------------------------------

def fact_agent_activity(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    state_events = ev.select(
        F.col("user_id").alias("agent_sk"),
        mapped("event_type", STATE_OF_EVENT).alias("state_code"),
        X.as_instant("ts").alias("state_ts"),
        X.cents("value").alias("state_seconds"),
    )
    return S.agent_activity_daily(state_events)


def dim_agent(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("agent_sk"),
        F.col("c_custkey").alias("agent_id"),
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("employee_no"),
        F.col("c_name").alias("full_name"),
        F.col("c_nationkey").cast("bigint").alias("org_unit_id"),
        F.col("c_mktsegment").alias("team_name"),
        site_code("c_nationkey").alias("site_code"),
        F.lit(True).alias("is_current"),
    )


def fact_queue_interval(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    calls = ev.select(
        (F.col("user_id") % QUEUE_COUNT).alias("queue_sk"),
        X.as_instant("ts").alias("call_ts"),
        (F.col("event_type") == "error").alias("abandoned"),
        F.col("value").alias("wait_sec"),
    )
    return S.queue_intervals(calls, INTERVAL_MINUTES, SL_THRESHOLD_SEC)


def fact_interaction(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("interaction_id"),
        (F.col("user_id") % QUEUE_COUNT).alias("client_sk"),
        (F.col("event_id") % PROGRAM_COUNT).alias("program_sk"),
        (F.col("user_id") % QUEUE_COUNT).alias("queue_sk"),
        F.col("user_id").alias("agent_sk"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_ref"),
        X.as_instant("ts").alias("start_ts"),
        F.round("value").cast("bigint").alias("handle_seconds"),
        (F.col("event_type") == "purchase").alias("resolved_flag"),
        F.lit("events").alias("source_system"),
        F.to_date("ts").alias("event_date"),
        mapped("event_type", CHANNEL_OF_EVENT, OTHER_CHANNEL).alias("channel"),
    )


def dim_program(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_suppkey").alias("program_sk"),
        F.col("s_suppkey").alias("program_id"),
        F.col("s_name").alias("program_name"),
        F.col("s_nationkey").cast("bigint").alias("client_id"),
    )


def fact_csat_survey(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("survey_id"),
        F.col("event_id").cast("string").alias("interaction_id"),
        (F.col("user_id") % QUEUE_COUNT).alias("client_sk"),
        (F.col("event_id") % PROGRAM_COUNT).alias("program_sk"),
        F.col("user_id").alias("agent_sk"),
        X.as_instant("ts").alias("survey_ts"),
        (F.lit(1) + F.col("event_id") % 5).alias("csat_score"),
        (F.col("event_id") % 11).alias("nps_score"),
        F.col("event_type").alias("site_code"),
        F.to_date("ts").alias("event_date"),
    )


def fact_billing_line(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    lines = li.select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_suppkey").alias("program_sk"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("line_amount"),
        (F.col("l_returnflag") == "R").alias("adjustment_flag"),
    )
    headers = o.select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("client_sk"),
        F.col("o_orderstatus").alias("invoice_status"),
        F.col("o_orderdate").alias("invoice_ts"),
    )
    return S.billing_lines(lines, headers)


def program_lob(spark: SparkSession, sf: str) -> DataFrame:
    """Line of business of a program: the region of its supplier's nation."""
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("program_sk"), F.col("r_name").alias("line_of_business")))


def billed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Billing lines with their SLA credit: returned lines give back price × discount, in cents."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("client_sk"), F.col("l_suppkey").alias("program_sk"),
        X.month_start(F.to_date("o_orderdate")).alias("period_month_date"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("line_amount"),
        F.when(F.col("l_returnflag") == "R", X.cents(F.col("l_extendedprice") * F.col("l_discount"))).alias("credit_cents"))


def telco_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Carrier cost per client and month: 1 % of the order total, whole cents; no program."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("client_sk"), F.lit(None).cast("bigint").alias("program_sk"),
        X.month_start(F.to_date("o_orderdate")).alias("period_month_date"),
        F.floor(X.cents("o_totalprice") / 100).cast("bigint").alias("telco_cents"))


def fact_ticket(spark: SparkSession, sf: str) -> DataFrame:
    """orders as tickets; resolved at the first ship date of the order."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    first_ship = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("resolved_ts"))
    return (
        o.join(first_ship, o.o_orderkey == first_ship.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("ticket_id"),
            (F.col("o_orderkey") % PROGRAM_COUNT).alias("program_sk"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"),
            X.as_instant("o_orderdate").alias("created_ts"),
            X.as_instant("resolved_ts").alias("resolved_ts"),
            (F.lit(24) * (F.lit(1) + F.col("o_orderkey") % 60)).alias("sla_hours"),
            F.to_date("o_orderdate").alias("event_date"),
        )
    )


def wfm_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Shifts, work, exceptions and time off as (agent_sk, kind, start_s, end_s)."""
    ev = table(spark, sf, "events").select(
        F.col("user_id").alias("agent_sk"), "event_type", X.epoch_seconds("ts").alias("t"), X.cents("value").alias("work"))

    def of(kind: str, rows: DataFrame, start: Column, end: Column) -> DataFrame:
        return rows.select("agent_sk", F.lit(kind).alias("kind"), start.alias("start_s"), end.alias("end_s"))

    t, start = F.col("t"), F.col("_start")
    shifts = ev.select("agent_sk", F.floor(t / IV.DAY).alias("_day")).distinct().withColumn(
        "_start", F.col("_day") * IV.DAY + (6 + F.col("agent_sk") % 12) * 3600)
    overtime = shifts.where(F.col("agent_sk") % OVERTIME_EVERY == 0)
    return (of("scheduled", shifts, start, start + SHIFT_HOURS * 3600)
            .unionByName(of("scheduled", overtime, start + OVERTIME_FROM * 3600, start + OVERTIME_TO * 3600))
            .unionByName(of("worked", ev, t, t + F.col("work")))
            .unionByName(of("exception", ev.where("event_type = 'error'"), t - EXCEPTION_SEC[0], t + EXCEPTION_SEC[1]))
            .unionByName(of("timeoff", ev.where("event_type = 'signup'"), t - TIMEOFF_SEC[0], t + TIMEOFF_SEC[1])))


def fact_adherence_daily(spark: SparkSession, sf: str) -> DataFrame:
    return IV.adherence_minutes(wfm_intervals(spark, sf))


# --------------------------------------------------------------------------
# staging / ods shapes
# --------------------------------------------------------------------------

def stg_tel_call(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    start = X.epoch_seconds("ts")
    return ev.select(
        F.col("event_id").alias("call_id"),
        F.concat(F.lit("+1555"), F.lpad(F.col("user_id").cast("string"), 7, "0")).alias("ani"),
        F.concat(F.lit("+1800"), F.lpad((F.col("user_id") % QUEUE_COUNT).cast("string"), 7, "0")).alias("dnis"),
        (F.col("user_id") % QUEUE_COUNT).alias("queue_id"),
        F.col("user_id").alias("agent_id"),
        (F.col("event_id") % PROGRAM_COUNT).alias("program_id"),
        start.alias("start_epoch"),
        F.when(F.col("event_type") != "error", start).alias("answer_epoch"),
        (start + F.round("value").cast("bigint")).alias("end_epoch"),
        F.upper("event_type").alias("disposition_code"),
        F.lit("INBOUND").alias("direction"),
        F.concat(F.lit("REC"), F.col("event_id").cast("string")).alias("recording_id"),
        F.to_date("ts").alias("load_date"),
    )


def ods_call(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("call_id"),
        (F.col("user_id") % QUEUE_COUNT).alias("queue_id"),
        F.col("user_id").alias("agent_id"),
        (F.col("event_id") % PROGRAM_COUNT).alias("program_id"),
        X.as_instant("ts").alias("start_ts"),
        F.to_date("ts").alias("call_date"),
    )


def ods_queue(spark: SparkSession, sf: str) -> DataFrame:
    """nation as queues, one copy per snapshot day (one row per key per day)."""
    n = table(spark, sf, "nation")
    snaps = F.array(*[F.lit(d) for d in QUEUE_SNAPSHOTS])
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("queue_id"),
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("queue_code"),
        F.col("n_name").alias("queue_name"),
        F.col("n_regionkey").cast("bigint").alias("program_id"),
        F.explode(snaps).alias("snapshot_date"),
    )


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """events as a change feed keyed by user_id."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("user_id").alias("entity_id"),
        F.col("event_id").alias("change_id"),
        mapped("event_type", OP_OF_EVENT, OTHER_OP).alias("op"),
        X.epoch_millis("ts").alias("change_ms"),
        F.col("event_type").alias("status"),
        X.cents("value").alias("amount_cents"),
        F.to_date("ts").alias("extract_ts"),
    )


def feed_base(spark: SparkSession, sf: str) -> DataFrame:
    return change_feed(spark, sf).filter(F.col("extract_ts") < F.lit(FEED_SPLIT_DATE))


def feed_delta(spark: SparkSession, sf: str) -> DataFrame:
    return change_feed(spark, sf).filter(F.col("extract_ts") >= F.lit(FEED_SPLIT_DATE))
