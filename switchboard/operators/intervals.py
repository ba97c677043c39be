"""Overlapping time intervals and messages awaiting a reply.

No range join: intervals become edges (+1 at the start, -1 at the end) that a
running sum turns into stretches, calls are cut at the fixed interval borders
they cross, and a reply is found by one ordered pass over all messages. Times
are epoch seconds. Each step is linear in its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators.history import RANGE, _beside, in_ranges

DAY = 86_400


def cut(rows: DataFrame, width: int, name: str, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """Intervals cut at the multiples of ``width`` seconds they cross; ``name`` is the number of the piece's slot.

    Intervals that are empty or lack an end are dropped.
    """
    slots = F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))
    pieces = rows.where(F.col(end) > F.col(start)).withColumn(name, F.explode(slots))
    return pieces.withColumn(start, F.greatest(F.col(start), F.col(name) * width)).withColumn(
        end, F.least(F.col(end), (F.col(name) + 1) * width))


def sweep(rows: DataFrame, keys: list[str], kind: str, kinds: list[str]) -> DataFrame:
    """Stretches between neighbouring edges of a key: ``keys``, ``seconds``, and per kind whether it is active.

    Edges at one instant are added up first (map-side), so intervals that
    overlap, repeat or touch cost one row per instant; the running sums are
    windows per key.
    """
    edges = rows.select(*keys, kind, F.explode(F.array(
        F.struct(F.col("start_s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end_s").alias("t"), F.lit(-1).alias("d")))).alias("_e"))
    steps = edges.groupBy(*keys, F.col("_e.t").alias("_t")).agg(
        *[F.sum(F.when(F.col(kind) == k, F.col("_e.d")).otherwise(0)).alias(k) for k in kinds])
    w = Window.partitionBy(*keys).orderBy("_t")
    return steps.select(*keys, (F.lead("_t").over(w) - F.col("_t")).alias("seconds"),
                        *[(F.sum(k).over(w) > 0).alias(k) for k in kinds]).where("seconds IS NOT NULL")


KINDS = ["scheduled", "worked", "exception", "timeoff"]


def adherence_minutes(intervals: DataFrame) -> DataFrame:
    """fact_adherence_daily's minutes (C17) from (agent_sk, kind, start_s, end_s), kinds as in ``KINDS``.

    Overlapping intervals of a kind count once. Work, exceptions and time off
    count while a shift is scheduled; an exception within time off is time
    off. An interval belongs to the days it covers. Whole minutes, floored.
    """
    stretches = sweep(cut(intervals, DAY, "_day"), ["agent_sk", "_day"], "kind", KINDS)

    def minutes(where: Column) -> Column:
        return F.floor(F.sum(F.when(where, F.col("seconds")).otherwise(0)) / 60).cast("bigint")

    shift = F.col("scheduled")
    return stretches.groupBy("agent_sk", "_day").agg(
        minutes(shift).alias("scheduled_minutes"), minutes(shift & F.col("worked")).alias("worked_minutes"),
        minutes(shift & F.col("exception") & ~F.col("timeoff")).alias("exception_minutes"),
        minutes(shift & F.col("timeoff")).alias("timeoff_minutes")).select(
        "agent_sk", "scheduled_minutes", "worked_minutes", "exception_minutes", "timeoff_minutes",
        F.date_from_unix_date(F.col("_day").cast("int")).alias("event_date"))


def queue_interval_measures(calls: DataFrame, minutes: int, sl_threshold_sec: int) -> DataFrame:
    """fact_queue_interval with its declared measures (C16) from (queue_sk, call_s, abandoned, wait_cents, end_s).

    Counts and the mean wait of answered calls belong to the interval in which
    a call arrives; its handled seconds, from answer to ``end_s``, are dealt to
    every interval they cover. ``avg_handle_sec`` is an interval's handled
    seconds per call handled in it, so an interval without arrivals has a row
    if calls go on in it. Both kinds of rows meet in one aggregate.
    """
    width = 60 * minutes
    answered = ~F.col("abandoned")
    zero = F.lit(0).cast("bigint")
    arrived = calls.select(
        "queue_sk", F.floor(F.col("call_s") / width).alias("_slot"), F.lit(1).cast("bigint").alias("offered"),
        answered.cast("bigint").alias("answered"), F.col("abandoned").cast("bigint").alias("abandoned"),
        (answered & (F.col("wait_cents") < 100 * sl_threshold_sec)).cast("bigint").alias("answered_in_sl"),
        F.when(answered, F.col("wait_cents")).otherwise(zero).alias("_wait"), zero.alias("_handled"), zero.alias("_calls"))
    talk = calls.where(answered).select("queue_sk", (F.col("call_s") + F.floor(F.col("wait_cents") / 100)).alias("start_s"), "end_s")
    handled = cut(talk, width, "_slot").select(
        "queue_sk", "_slot", *[zero.alias(c) for c in ("offered", "answered", "abandoned", "answered_in_sl", "_wait")],
        (F.col("end_s") - F.col("start_s")).alias("_handled"), F.lit(1).cast("bigint").alias("_calls"))
    sums = arrived.unionByName(handled).groupBy("queue_sk", "_slot").agg(
        *[F.sum(c).alias(c) for c in arrived.columns if c not in ("queue_sk", "_slot")])
    start = F.timestamp_seconds(F.col("_slot") * width)
    return sums.select(
        "queue_sk", start.alias("interval_start_ts"), "offered", "answered", "abandoned", "answered_in_sl",
        F.lit(sl_threshold_sec).cast("bigint").alias("sl_threshold_sec"),
        X.exact_ratio(F.col("_wait"), F.col("answered") * 100, 2, 8).alias("avg_speed_answer_sec"),
        X.exact_ratio(F.col("_handled"), F.col("_calls"), 2, 8).alias("avg_handle_sec"), F.to_date(start).alias("event_date"))


def reply_minutes(messages: DataFrame, sla_minutes: int) -> DataFrame:
    """Customer messages with the first agent message of their thread at or after them (C14).

    ``messages``: thread, message_id, sent_s, from_customer. Output: thread,
    message_id, sent_s, reply_s, reply_minutes (floored) and
    sla_breached_flag, NULL while there is no reply. A message without a
    thread has none. One ordered pass: the next agent message comes from the
    same range or, by one row per range, from a later one.
    """
    order = ["thread", "sent_s", "_agent", "message_id"]
    rows = in_ranges(messages.withColumn("_agent", ~F.col("from_customer")), order).withColumn(
        "_reply", F.when(F.col("_agent"), F.struct(F.col("thread").alias("k"), F.col("sent_s").alias("t"))))
    first = rows.groupBy(RANGE).agg(F.min(F.when(F.col("_agent"), F.struct(*order, "_reply"))).getField("_reply").alias("_first"))
    after = F.expr(f"lead(_reply) IGNORE NULLS OVER (PARTITION BY {RANGE} ORDER BY "
                   + ", ".join(f"{c} ASC NULLS FIRST" for c in order) + ")")
    found = rows.withColumn("_after", after).where("from_customer").join(_beside(first, "_first", forward=True), RANGE, "left")
    nxt = F.coalesce("_after", "_beside")
    reply = F.when(nxt.getField("k") == F.col("thread"), nxt.getField("t"))
    taken = F.floor((F.col("reply_s") - F.col("sent_s")) / 60).cast("bigint")
    return found.select("thread", "message_id", "sent_s", reply.alias("reply_s")).withColumn("reply_minutes", taken).withColumn(
        "sla_breached_flag", F.col("reply_minutes") > sla_minutes)
