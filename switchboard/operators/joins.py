"""Equi-joins of the reference's smoke queries.

No broadcast hints: Catalyst broadcasts a dimension only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans at
run time from real shuffle sizes, so a dimension that grows past the
threshold falls back to a shuffle join instead of exhausting memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def ods_join_queue(calls: DataFrame, queues: DataFrame) -> DataFrame:
    """ods_call ⋈ ods_queue on queue_id only, as written: a queue stored once per
    snapshot day matches once per snapshot (see ``snapshot_latest``)."""
    c = calls.select("call_id", "queue_id")
    q = queues.select("queue_id", "queue_name")
    return c.join(q, "queue_id", "inner").select("call_id", "queue_name")


def star_join(fact: DataFrame, dim_agent: DataFrame, dim_program: DataFrame,
              fact_filter: Column | None = None) -> DataFrame:
    """fact_interaction ⋈ dim_agent ⋈ dim_program; the fact filter reaches the scan
    (a partition filter when the fact is laid out by event_date)."""
    f = fact if fact_filter is None else fact.filter(fact_filter)
    f = f.select("interaction_id", "agent_sk", "program_sk")
    a = dim_agent.select("agent_sk", "full_name")
    p = dim_program.select("program_sk", "program_name")
    return (f.join(a, "agent_sk", "inner").join(p, "program_sk", "inner")
            .select("interaction_id", "full_name", "program_name"))
