"""Per-call / per-session / per-interval operators.

Everything is a built-in expression or aggregate. Two forms exist for chat
and QA metrics: over staged records that already carry an array (array
higher-order functions on the row -- no explode, no shuffle), and over one
row per message / section (plain aggregates, map-side combined). Arrays are
never built from rows here: gathering a key's rows into one value would put
a hot key into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import decode as X

# Call segment types (the reference names none; ours).
SEGMENT_TYPES = ["RING", "IVR", "TALK", "HOLD", "ACW"]
CHAT_AGENT = "assistant"
CHAT_CUSTOMER = "user"
IVR_AGENT_MENU = "click"   # a menu step that hands the caller to an agent
PATH_SEPARATOR = ">"


def call_durations(segments: DataFrame) -> DataFrame:
    """Seconds per segment type per call: the pivot over the fixed type list,
    written as conditional sums so that it and the segment count are one hash
    aggregate (map-side combined) per call. A call without a TALK segment is
    abandoned.
    """
    t = F.col("segment_type")
    sums = [F.sum(F.when(t == v, F.col("duration_seconds"))).alias(v) for v in SEGMENT_TYPES]
    out = segments.groupBy("call_id").agg(*sums, F.count(F.lit(1)).alias("segment_count"),
                                          F.count_if(t == "TALK").alias("_talks"))
    return out.select(
        "call_id",
        *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(f"{v.lower()}_seconds") for v in SEGMENT_TYPES],
        "segment_count",
        (F.col("_talks") == 0).alias("abandoned_flag"),
    )


def chat_metrics(chats: DataFrame) -> DataFrame:
    """ods_chat_session metrics from ``messages`` ARRAY<STRUCT<sender, ts_ms, text>>.

    first_response_seconds: from the first customer message to the first agent
    message after it, whole seconds; NULL when either is missing.
    """
    m = F.col("messages")
    first_customer = F.array_min(F.transform(F.filter(m, lambda x: x.sender == CHAT_CUSTOMER),
                                             lambda x: x.ts_ms))
    first_reply = F.array_min(F.transform(
        F.filter(m, lambda x: (x.sender == CHAT_AGENT) & (x.ts_ms > first_customer)), lambda x: x.ts_ms))
    return chats.select(
        "chat_ref",
        F.size(m).cast("bigint").alias("message_count"),
        F.size(F.filter(m, lambda x: x.sender == CHAT_AGENT)).cast("bigint").alias("agent_message_count"),
        F.size(F.filter(m, lambda x: x.sender == CHAT_CUSTOMER)).cast("bigint").alias("customer_message_count"),
        F.floor((first_reply - first_customer) / 1000).cast("bigint").alias("first_response_seconds"),
    )


def chat_metrics_rows(messages: DataFrame, chunk: str = "minute") -> DataFrame:
    """The same metrics from one row per message (chat_ref, sender, ts_ms).

    Two aggregates and no join: per (chat, minute) the counts, the first
    customer and agent times and the first reply within the minute; per chat
    these rows together. A hot chat is spread by minutes; no level gathers
    more than a minute of its messages or one entry per minute.
    """
    sender, ts = F.col("sender"), F.col("ts_ms")
    agent, customer = sender == CHAT_AGENT, sender == CHAT_CUSTOMER
    minutes = messages.groupBy("chat_ref", F.date_trunc(chunk, X.decode_epoch_millis("ts_ms")).alias("_m")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(agent).alias("n_agent"), F.count_if(customer).alias("n_customer"),
        F.min(F.when(customer, ts)).alias("asked"), F.collect_set(F.when(agent, ts)).alias("_agent"))
    minutes = minutes.withColumn("reply", F.array_min(F.filter("_agent", lambda x: x > F.col("asked")))).withColumn(
        "agent", F.array_min("_agent"))
    chats = minutes.groupBy("chat_ref").agg(
        F.sum("n").alias("message_count"), F.sum("n_agent").alias("agent_message_count"),
        F.sum("n_customer").alias("customer_message_count"),
        F.min(F.when(F.col("asked").isNotNull(), F.struct("_m", "asked", "reply"))).alias("_first"),
        F.collect_list(F.when(F.col("agent").isNotNull(), F.struct("_m", "agent"))).alias("_agents"))
    later = F.array_min(F.transform(F.filter("_agents", lambda x: x["_m"] > F.col("_first._m")), lambda x: x["agent"]))
    first_reply = F.least(F.col("_first.reply"), later)
    return chats.select(
        "chat_ref", "message_count", "agent_message_count", "customer_message_count",
        F.floor((first_reply - F.col("_first.asked")) / 1000).cast("bigint").alias("first_response_seconds"))


def qa_totals_rows(sections: DataFrame) -> DataFrame:
    """QA totals from one row per section (qa_form_id, max_points, scored_points): one aggregate."""
    agg = sections.groupBy("qa_form_id").agg(
        F.count(F.lit(1)).alias("section_count"),
        F.sum("scored_points").alias("scored_points"),
        F.sum("max_points").alias("max_points"))
    return agg.select("qa_form_id", "section_count", "scored_points", "max_points",
                      X.exact_ratio(F.col("scored_points") * 100, F.col("max_points"), 2, 5).alias("overall_pct"))


def qa_totals(forms: DataFrame) -> DataFrame:
    """ods_qa_evaluation totals from ``sections`` ARRAY<STRUCT<section_code, max_points, scored_points>>.

    Points add up as SUM does: NULL points are skipped, and a form without any
    has NULL totals. An absent array is a form without sections.
    """
    s = F.col("sections")

    def total(field: str):
        points = F.filter(F.transform(s, lambda x: x[field]), lambda p: p.isNotNull())
        return F.when(F.size(points) > 0, F.aggregate(points, F.lit(0).cast("bigint"), lambda acc, p: acc + p))

    scored, maxp = total("scored_points"), total("max_points")
    return forms.select(
        "qa_form_id",
        F.coalesce(F.size(s), F.lit(0)).cast("bigint").alias("section_count"),
        scored.alias("scored_points"),
        maxp.alias("max_points"),
        X.exact_ratio(scored * 100, maxp, 2, 5).alias("overall_pct"),
    )


def ivr_sessions(events: DataFrame, chunk: str = "minute") -> DataFrame:
    """ods_ivr_session / fact_ivr_path per session_ref.

    Two aggregates and no join: steps are counted, ordered and joined to a
    piece per (session, minute), then the minute pieces per session; ties in
    time go by menu in the path and in the exit key alike. No level gathers more than one minute of steps or one piece per
    minute, so a hot session is spread over many tasks; its full path is one
    output value by definition.
    """
    e = events.withColumn("_chunk", F.date_trunc(chunk, X.decode_epoch_millis("event_ms")))
    step = F.struct("event_ms", "menu_path")
    pieces = e.groupBy("session_ref", "_chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda x: x.menu_path), PATH_SEPARATOR).alias("_piece"),
        F.min("event_ms").alias("_first"), F.max(step).alias("_exit"), F.count(F.lit(1)).alias("hops"),
        F.count_if(F.col("menu_path") == IVR_AGENT_MENU).alias("_to_agent"), F.min("event_date").alias("event_date"))
    agg = pieces.groupBy("session_ref").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "_piece"))),
                                 lambda x: x._piece), PATH_SEPARATOR).alias("menu_path_full"),
        F.min("_first").alias("_first"), F.max("_exit").alias("_exit"), F.sum("hops").alias("hops"),
        F.sum("_to_agent").alias("_to_agent"), F.min("event_date").alias("event_date"))
    agg = agg.withColumn("_last", F.col("_exit.event_ms")).withColumn("exit_key", F.col("_exit.menu_path"))
    return agg.select(
        "session_ref",
        X.decode_epoch_millis("_first").alias("first_event_ts"),
        X.decode_epoch_millis("_last").alias("last_event_ts"),
        "menu_path_full",
        "hops",
        (F.col("_to_agent") == 0).alias("contained_flag"),
        "exit_key",
        F.floor((F.col("_last") - F.col("_first")) / 1000).cast("bigint").alias("duration_seconds"),
        "event_date",
    )


INTERACTION_COLUMNS = ["interaction_id", "channel", "agent_id", "customer_ref", "start_ts", "end_ts",
                       "handle_seconds", "source_system", "event_date"]


def interaction_union(*feeds: DataFrame) -> DataFrame:
    """ods_interaction: channel feeds unioned by name; handle_seconds = end − start when both are known.

    Feeds that carry their own handle_seconds keep it when a bound is missing.
    """
    parts = []
    for f in feeds:
        for c in INTERACTION_COLUMNS:
            if c not in f.columns:
                f = f.withColumn(c, F.lit(None))
        parts.append(f.select(*INTERACTION_COLUMNS))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # declared TIMESTAMP columns are instants (local date-times are read in the UTC session)
    u = u.withColumn("start_ts", F.col("start_ts").cast("timestamp")) \
        .withColumn("end_ts", F.col("end_ts").cast("timestamp"))
    diff = F.unix_seconds(F.col("end_ts")) - F.unix_seconds(F.col("start_ts"))
    return u.withColumn("handle_seconds", F.coalesce(diff, F.col("handle_seconds").cast("bigint")))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end (floor), NULL if either is NULL."""
    return F.floor((F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))) / 60) \
        .cast("bigint")


def sla_minutes(tickets: DataFrame) -> DataFrame:
    """fact_ticket resolution minutes and SLA breach (minutes > sla_hours × 60)."""
    mins = minutes_between(F.col("created_ts"), F.col("resolved_ts"))
    return tickets.select(
        "ticket_id", "program_sk", "priority", "status", "created_ts", "resolved_ts",
        mins.alias("resolution_minutes"), "sla_hours",
        (mins > F.col("sla_hours") * 60).alias("sla_breached_flag"),
        "event_date")


def agent_activity_daily(state_events: DataFrame) -> DataFrame:
    """fact_agent_activity: seconds and occurrences per (agent, state, day), first/last time."""
    return (state_events.groupBy("agent_sk", "state_code", F.to_date("state_ts").alias("event_date"))
            .agg(F.sum("state_seconds").alias("state_seconds"),
                 F.count(F.lit(1)).alias("occurrence_count"),
                 F.min("state_ts").alias("first_state_ts"),
                 F.max("state_ts").alias("last_state_ts"))
            .select("agent_sk", "state_code", "state_seconds", "occurrence_count",
                    "first_state_ts", "last_state_ts", "event_date"))


def queue_intervals(calls: DataFrame, minutes: int, sl_threshold_sec: int) -> DataFrame:
    """fact_queue_interval: offered / answered / abandoned / answered within SL per queue and fixed interval."""
    answered = ~F.col("abandoned")
    return (calls.groupBy("queue_sk", F.window("call_ts", f"{minutes} minutes").start.alias("interval_start_ts"))
            .agg(F.count(F.lit(1)).alias("offered"),
                 F.count_if(answered).alias("answered"),
                 F.count_if(~answered).alias("abandoned"),
                 F.count_if(answered & (F.col("wait_sec") < sl_threshold_sec)).alias("answered_in_sl"))
            .select("queue_sk", "interval_start_ts", "offered", "answered", "abandoned", "answered_in_sl",
                    F.lit(sl_threshold_sec).cast("bigint").alias("sl_threshold_sec"),
                    F.to_date("interval_start_ts").alias("event_date")))


def billing_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """fact_billing_line: invoice lines ⋈ invoice headers, month of the invoice date."""
    return lines.join(headers, "invoice_id", "inner").select(
        "invoice_id", "client_sk", "program_sk", "line_no", "qty", "line_amount", "adjustment_flag",
        "invoice_status", X.month_start(F.to_date("invoice_ts")).alias("period_month_date"))
