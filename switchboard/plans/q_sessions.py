"""Registered queries: per-call, per-session and per-interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import dimensions as D
from switchboard.operators import intervals as IV
from switchboard.operators import sessions as S
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.oracle import cents, epoch_ms, exact_ratio, with_ctes
from switchboard.sources.tables import table

# event_type → call segment type for the segment binding.
SEGMENT_OF_EVENT = {"signup": "RING", "error": "IVR", "click": "TALK", "view": "HOLD", "purchase": "ACW"}


# ---------------------------------------------------------------- C9
def _segment_case() -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_OF_EVENT.items()) + " END"


C9_SQL = f"""
SELECT call_id,
       {", ".join(f"CAST(COALESCE(SUM(d) FILTER (WHERE st = '{t}'), 0) AS BIGINT) AS {t.lower()}_seconds"
                  for t in S.SEGMENT_TYPES)},
       CAST(COUNT(*) AS BIGINT) AS segment_count,
       COUNT(*) FILTER (WHERE st = 'TALK') = 0 AS abandoned_flag
FROM (SELECT user_id * 100 + day(ts) AS call_id, {_segment_case()} AS st, {cents('value')} AS d FROM events) s
GROUP BY call_id"""


@register("call_durations", C9_SQL)
def call_durations(spark, sf):
    ev = table(spark, sf, "events")
    segments = ev.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("call_id"),
        B.mapped("event_type", SEGMENT_OF_EVENT).alias("segment_type"),
        X.cents("value").alias("duration_seconds"))
    return S.call_durations(segments)


# ---------------------------------------------------------------- C10
C10_SQL = """
WITH m AS (SELECT conv_id, role, turn * 30000 AS ts_ms FROM conversations),
fc AS (SELECT conv_id, MIN(ts_ms) FILTER (WHERE role = 'user') AS first_c FROM m GROUP BY conv_id)
SELECT CAST(m.conv_id AS VARCHAR) AS chat_ref, CAST(COUNT(*) AS BIGINT) AS message_count,
       CAST(COUNT(*) FILTER (WHERE role = 'assistant') AS BIGINT) AS agent_message_count,
       CAST(COUNT(*) FILTER (WHERE role = 'user') AS BIGINT) AS customer_message_count,
       CAST(floor((MIN(ts_ms) FILTER (WHERE role = 'assistant' AND ts_ms > fc.first_c) - fc.first_c) / 1000) AS BIGINT)
         AS first_response_seconds
FROM m JOIN fc ON m.conv_id = fc.conv_id GROUP BY m.conv_id, fc.first_c"""


@register("chat_session", C10_SQL)
def chat_session(spark, sf):
    c = table(spark, sf, "conversations")
    return S.chat_metrics_rows(c.select(F.col("conv_id").cast("string").alias("chat_ref"), F.col("role").alias("sender"),
                                        (F.col("turn") * B.CHAT_TURN_MS).alias("ts_ms")))


# The array form over records that carry their messages: each event opens a chat
# with the customer, an agent replies after its value in seconds, and a purchase
# gets one more message of either side a second later each.
@register("chat_session_nested", """
SELECT CAST(event_id AS VARCHAR) AS chat_ref, CAST(CASE WHEN event_type = 'purchase' THEN 4 ELSE 2 END AS BIGINT) AS message_count,
       CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS agent_message_count,
       CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS customer_message_count,
       CAST(floor(CASE WHEN round(value) > 0 THEN round(value) WHEN event_type = 'purchase' THEN 2 END) AS BIGINT)
         AS first_response_seconds
FROM events""")
def chat_session_nested(spark, sf):
    start, reply = X.epoch_millis("ts"), X.epoch_millis("ts") + F.round("value").cast("bigint") * 1000

    def message(sender, ts):
        return F.struct(F.lit(sender).alias("sender"), ts.alias("ts_ms"))

    opening = F.array(message(S.CHAT_CUSTOMER, start), message(S.CHAT_AGENT, reply))
    more = F.array(message(S.CHAT_CUSTOMER, reply + 1000), message(S.CHAT_AGENT, reply + 2000))
    return S.chat_metrics(table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("chat_ref"),
        F.when(F.col("event_type") == "purchase", F.concat(opening, more)).otherwise(opening).alias("messages")))


# ---------------------------------------------------------------- C11
C11_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS qa_form_id, CAST(COUNT(*) AS BIGINT) AS section_count,
       CAST(SUM(CAST(ROUND(l_quantity) AS BIGINT)) AS BIGINT) AS scored_points,
       CAST(50 * COUNT(*) AS BIGINT) AS max_points,
       {exact_ratio("SUM(CAST(ROUND(l_quantity) AS BIGINT)) * 100", "50 * COUNT(*)")} AS overall_pct
FROM lineitem GROUP BY l_orderkey"""


def qa_sections(spark, sf):
    """lineitem as QA form sections: one section per line."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("qa_form_id"),
        F.col("l_returnflag").alias("section_code"),
        F.lit(B.QA_MAX_POINTS).cast("bigint").alias("max_points"),
        F.round("l_quantity").cast("bigint").alias("scored_points"))


@register("qa_totals", C11_SQL)
def qa_totals(spark, sf):
    return S.qa_totals_rows(qa_sections(spark, sf))


# The array form: a line as a form with three sections.
@register("qa_totals_nested", f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS qa_form_id, CAST(3 AS BIGINT) AS section_count,
       s AS scored_points, CAST(70 AS BIGINT) AS max_points, {exact_ratio("s * 100", "70")} AS overall_pct
FROM (SELECT *, CAST(ROUND(l_quantity) + ROUND(l_discount * 100) + ROUND(l_tax * 100) AS BIGINT) AS s FROM lineitem) x""")
def qa_totals_nested(spark, sf):
    def section(code, most, scored):
        return F.struct(F.lit(code).alias("section_code"), F.lit(most).cast("bigint").alias("max_points"),
                        F.round(scored).cast("bigint").alias("scored_points"))

    li = table(spark, sf, "lineitem")
    return S.qa_totals(li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("qa_form_id"),
        F.array(section("QTY", 50, F.col("l_quantity")), section("DISC", 10, F.col("l_discount") * 100),
                section("TAX", 10, F.col("l_tax") * 100)).alias("sections")))


# ---------------------------------------------------------------- C12
C12_SQL = f"""
SELECT session_ref, make_timestamp(MIN(event_ms) * 1000) AS first_event_ts,
       make_timestamp(MAX(event_ms) * 1000) AS last_event_ts,
       string_agg(menu_path, '>' ORDER BY event_ms) AS menu_path_full, CAST(COUNT(*) AS BIGINT) AS hops,
       COUNT(*) FILTER (WHERE menu_path = 'click') = 0 AS contained_flag,
       arg_max(menu_path, event_ms) AS exit_key,
       CAST(floor((MAX(event_ms) - MIN(event_ms)) / 1000) AS BIGINT) AS duration_seconds,
       MIN(event_date) AS event_date
FROM (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_ref, event_type AS menu_path,
             {epoch_ms('ts')} AS event_ms, CAST(ts AS DATE) AS event_date FROM events) s
GROUP BY session_ref"""


def ivr_log(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_ref"),
        F.col("event_type").alias("menu_path"),
        X.epoch_millis("ts").alias("event_ms"),
        F.to_date("ts").alias("event_date"))


@register("ivr_session_path", C12_SQL)
def ivr_session_path(spark, sf):
    return S.ivr_sessions(ivr_log(spark, sf))


# ---------------------------------------------------------------- C13
C13_SQL = f"""
WITH u AS (
  SELECT 'V' || CAST(event_id AS VARCHAR) AS interaction_id, 'VOICE' AS channel, user_id AS agent_id,
         'C' || CAST(user_id AS VARCHAR) AS customer_ref, ts AS start_ts,
         ts + to_seconds(CAST(ROUND(value) AS BIGINT)) AS end_ts, CAST(NULL AS BIGINT) AS given,
         'events' AS source_system, CAST(ts AS DATE) AS event_date
  FROM events
  UNION ALL
  SELECT 'C' || CAST(conv_id AS VARCHAR), 'CHAT', CAST(NULL AS BIGINT), 'C' || CAST(conv_id AS VARCHAR),
         CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), (MAX(turn) - MIN(turn)) * 30, 'conversations',
         CAST(NULL AS DATE)
  FROM conversations GROUP BY conv_id
  UNION ALL
  SELECT 'E' || CAST(o_orderkey AS VARCHAR), 'EMAIL', CAST(NULL AS BIGINT), 'C' || CAST(o_custkey AS VARCHAR),
         o_orderdate, fs.first_ship, CAST(NULL AS BIGINT), 'orders', CAST(o_orderdate AS DATE)
  FROM orders LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) fs
    ON o_orderkey = fs.l_orderkey)
SELECT interaction_id, channel, agent_id, customer_ref, start_ts, end_ts,
       COALESCE((epoch_us(end_ts) // 1000000) - (epoch_us(start_ts) // 1000000), given) AS handle_seconds,
       source_system, event_date
FROM u"""


@register("interaction_union", C13_SQL)
def interaction_union(spark, sf):
    ev = table(spark, sf, "events")
    voice = ev.select(
        F.concat(F.lit("V"), F.col("event_id").cast("string")).alias("interaction_id"),
        F.lit("VOICE").alias("channel"), F.col("user_id").alias("agent_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_ref"),
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.make_dt_interval(secs=F.round("value").cast("bigint"))).alias("end_ts"),
        F.lit("events").alias("source_system"), F.to_date("ts").alias("event_date"))
    conv = table(spark, sf, "conversations")
    chat = conv.groupBy("conv_id").agg(((F.max("turn") - F.min("turn")) * 30).alias("handle_seconds")).select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("interaction_id"),
        F.lit("CHAT").alias("channel"),
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("customer_ref"),
        F.lit(None).cast("timestamp_ntz").alias("start_ts"), F.lit(None).cast("timestamp_ntz").alias("end_ts"),
        "handle_seconds", F.lit("conversations").alias("source_system"))
    o = table(spark, sf, "orders")
    first_ship = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    email = o.join(first_ship, o.o_orderkey == first_ship.l_orderkey, "left").select(
        F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("interaction_id"),
        F.lit("EMAIL").alias("channel"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_ref"),
        F.col("o_orderdate").alias("start_ts"), F.col("first_ship").alias("end_ts"),
        F.lit("orders").alias("source_system"), F.to_date("o_orderdate").alias("event_date"))
    return S.interaction_union(voice.withColumn("agent_id", F.col("agent_id").cast("bigint")),
                               chat.withColumn("agent_id", F.lit(None).cast("bigint"))
                               .withColumn("event_date", F.lit(None).cast("date")),
                               email.withColumn("agent_id", F.lit(None).cast("bigint"))
                               .withColumn("handle_seconds", F.lit(None).cast("bigint")))


# ---------------------------------------------------------------- C14
C14_SQL = with_ctes("""
SELECT ticket_id, program_sk, priority, status, created_ts, resolved_ts,
       CAST(floor(((epoch_us(resolved_ts) // 1000000) - (epoch_us(created_ts) // 1000000)) / 60) AS BIGINT)
         AS resolution_minutes,
       sla_hours,
       CAST(floor(((epoch_us(resolved_ts) // 1000000) - (epoch_us(created_ts) // 1000000)) / 60) AS BIGINT)
         > sla_hours * 60 AS sla_breached_flag,
       event_date
FROM fact_ticket""", "fact_ticket")


@register("sla_minutes", C14_SQL)
def sla_minutes(spark, sf):
    return S.sla_minutes(B.fact_ticket(spark, sf))


# ---------------------------------------------------------------- C15, C16, C22
@register("agent_activity_daily", with_ctes("SELECT * FROM fact_agent_activity", "fact_agent_activity"))
def agent_activity_daily(spark, sf):
    return B.fact_agent_activity(spark, sf)


# A call waits ``value`` seconds and is handled for ``value`` * 40 more, which may take it over several half hours.
HANDLE_PER_WAIT = 40
C16_SQL = f"""
WITH c AS (SELECT user_id % {B.QUEUE_COUNT} AS q, epoch_us(ts) // 1000000 AS t, event_type = 'error' AS lost,
                  CAST(ROUND(value * 100) AS BIGINT) AS w FROM events),
talk AS (SELECT q, t + w // 100 AS s, t + w // 100 + w * {HANDLE_PER_WAIT} // 100 AS z FROM c WHERE NOT lost),
cut AS (SELECT q, slot, least(z, (slot + 1) * 1800) - greatest(s, slot * 1800) AS sec
        FROM (SELECT *, unnest(range(s // 1800, (z - 1) // 1800 + 1)) AS slot FROM talk WHERE z > s) x),
h AS (SELECT q, slot, SUM(sec) AS sec, COUNT(*) AS calls FROM cut GROUP BY ALL),
o AS (SELECT q, t // 1800 AS slot, COUNT(*) AS offered, COUNT(*) FILTER (NOT lost) AS answered, COUNT(*) FILTER (lost) AS abandoned,
             COUNT(*) FILTER (NOT lost AND w < {100 * B.SL_THRESHOLD_SEC}) AS in_sl, coalesce(SUM(w) FILTER (NOT lost), 0) AS wait
      FROM c GROUP BY ALL)
SELECT q AS queue_sk, make_timestamp(slot * 1800000000) AS interval_start_ts, coalesce(offered, 0) AS offered,
       coalesce(answered, 0) AS answered, coalesce(abandoned, 0) AS abandoned, coalesce(in_sl, 0) AS answered_in_sl,
       CAST({B.SL_THRESHOLD_SEC} AS BIGINT) AS sl_threshold_sec,
       {exact_ratio("wait", "answered * 100", 2, 8)} AS avg_speed_answer_sec, {exact_ratio("sec", "calls", 2, 8)} AS avg_handle_sec,
       CAST(make_timestamp(slot * 1800000000) AS DATE) AS event_date
FROM o FULL JOIN h USING (q, slot)"""


@register("queue_interval", C16_SQL)
def queue_interval(spark, sf):
    wait, at = X.cents("value"), X.epoch_seconds("ts")
    calls = table(spark, sf, "events").select(
        (F.col("user_id") % B.QUEUE_COUNT).alias("queue_sk"), at.alias("call_s"), (F.col("event_type") == "error").alias("abandoned"),
        wait.alias("wait_cents"), (at + F.floor(wait / 100) + F.floor(wait * HANDLE_PER_WAIT / 100)).alias("end_s"))
    return IV.queue_interval_measures(calls, B.INTERVAL_MINUTES, B.SL_THRESHOLD_SEC)


# ---------------------------------------------------------------- C14: replies and exceptions
# A thread per user; purchases are the agent's messages, anything else the customer's.
REPLY_SLA_MINUTES = 1440


@register("reply_sla_minutes", f"""
WITH m AS (SELECT user_id AS thread, event_id AS message_id, epoch_us(ts) // 1000000 AS sent_s, event_type <> 'purchase' AS asks FROM events),
r AS (SELECT *, min(CASE WHEN NOT asks THEN sent_s END) OVER (PARTITION BY thread ORDER BY sent_s
        RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reply_s FROM m)
SELECT thread, message_id, sent_s, reply_s, (reply_s - sent_s) // 60 AS reply_minutes,
       (reply_s - sent_s) // 60 > {REPLY_SLA_MINUTES} AS sla_breached_flag
FROM r WHERE asks""")
def reply_sla_minutes(spark, sf):
    messages = table(spark, sf, "events").select(
        F.col("user_id").alias("thread"), F.col("event_id").alias("message_id"), X.epoch_seconds("ts").alias("sent_s"),
        (F.col("event_type") != "purchase").alias("from_customer"))
    return IV.reply_minutes(messages, REPLY_SLA_MINUTES)


@register("exception_minutes", """
SELECT event_id AS adherence_event_id, user_id AS agent_id, ts AS start_ts, ts + to_microseconds(CAST(ROUND(value * 100) AS BIGINT) * 1000000) AS end_ts,
       (epoch_us(ts) // 1000000 + CAST(ROUND(value * 100) AS BIGINT) - epoch_us(ts) // 1000000) // 60 AS exception_minutes,
       event_id % 2 = 0 AS approved_flag, CAST(ts AS DATE) AS event_date
FROM events WHERE event_type = 'error'""")
def exception_minutes(spark, sf):
    """ods_adherence_event: an error is an exception for ``value`` * 100 seconds."""
    ev = table(spark, sf, "events").where("event_type = 'error'").withColumn("start_ts", X.as_instant("ts"))
    end = F.timestamp_micros(F.unix_micros("start_ts") + X.cents("value") * 1_000_000)
    return ev.withColumn("end_ts", end).select(
        F.col("event_id").alias("adherence_event_id"), F.col("user_id").alias("agent_id"), "start_ts", "end_ts",
        S.minutes_between(F.col("start_ts"), F.col("end_ts")).alias("exception_minutes"),
        (F.col("event_id") % 2 == 0).alias("approved_flag"), F.to_date("start_ts").alias("event_date"))


@register("billing_lines", with_ctes("SELECT * FROM fact_billing_line", "fact_billing_line"))
def billing_lines(spark, sf):
    return B.fact_billing_line(spark, sf)


# ---------------------------------------------------------------- C21
C21_SQL = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       CAST(isodow(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name,
       CAST(weekofyear(d) AS BIGINT) AS week_of_year, CAST(month(d) AS BIGINT) AS month_no,
       monthname(d) AS month_name, CAST(quarter(d) AS BIGINT) AS quarter_no, CAST(year(d) AS BIGINT) AS year_no,
       isodow(d) >= 6 AS is_weekend,
       (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25)
         AS is_holiday_us,
       strftime(d, '%Y') || '-P' || strftime(d, '%m') AS fiscal_period
FROM (SELECT CAST(unnest(generate_series(CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM events) s"""


@register("calendar_dim", C21_SQL)
def calendar_dim(spark, sf):
    bounds = table(spark, sf, "events").agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1"))
    return D.date_spine(bounds, "d0", "d1").select(*D.calendar_columns())

