"""Warehouse tables laid out as the reference declares them.

Each spec names the binding that fills the table, the input tables it reads,
and the declared partition column / grain / cluster keys. ``wh`` writes the
table once per input version into the shared folder and returns it read back,
so queries over it see real partition pruning and row-group skipping.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import aggregates as A
from switchboard.operators import history as H
from switchboard.operators.layout import materialized, materialized_path
from switchboard.plans import bindings as B
from switchboard.session import shared_dir
from switchboard.sources.tables import table

# Stored tables written at a time: enough that the short stages and commits of one leave no cores idle.
WRITERS = 6


def ods_client_acid(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("client_id"),
        F.concat(F.lit("CL"), F.col("c_custkey").cast("string")).alias("client_code"),
        F.col("c_name").alias("client_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("string").alias("hq_country"),
        F.lit("ACTIVE").alias("status"),
    )


def ods_agent_acid(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("agent_id"),
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("employee_no"),
        F.col("c_name").alias("full_name"),
        F.col("c_nationkey").cast("bigint").alias("org_unit_id"),
        F.col("c_mktsegment").alias("job_grade"),
        F.lit("ACTIVE").alias("status"),
    )


def ods_ticket_acid(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("ticket_no"),
        (F.col("o_orderkey") % B.PROGRAM_COUNT).alias("program_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_ts"),
    )


def ods_invoice_acid(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("invoice_id"),
        F.concat(F.lit("INV"), F.col("o_orderkey").cast("string")).alias("invoice_no"),
        F.col("o_custkey").alias("client_id"),
        X.encode_month("o_orderdate").alias("period_month"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )


def ods_agent_scd2(spark: SparkSession, sf: str) -> DataFrame:
    """Type-2 agent history for the year layout: orders as status changes of o_custkey."""
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("agent_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("changed_at"), F.col("o_orderkey").alias("seq"))
    hist = H.scd2_history(o, "agent_id", "changed_at", ["status"], tie_col="seq",
                          id_col="agent_history_id")
    return hist.select("agent_history_id", "agent_id", "status", "eff_from_ts", "eff_to_ts", "is_current")


def orders_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """orders as a day-partitioned table (retention and profile input)."""
    return table(spark, sf, "orders").withColumn("order_date", F.to_date("o_orderdate"))


@dataclass(frozen=True)
class Spec:
    build: object
    sources: tuple[str, ...]
    partition: str | None
    grain: str
    cluster: tuple[str, ...]
    once: bool = False      # dear rows: see layout.cluster_order


def _agg_agent_daily(spark, sf):
    return A.agg_agent_daily(B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf))


def _agg_queue_hourly(spark, sf):
    return A.agg_queue_hourly(B.fact_queue_interval(spark, sf))


# Declared layouts (partition column, grain, cluster keys) of the tables used.
SPECS: dict[str, Spec] = {
    "stg_tel_call": Spec(B.stg_tel_call, ("events",), "load_date", "day", ()),
    "fact_interaction": Spec(B.fact_interaction, ("events",), "event_date", "day",
                             ("channel", "agent_sk", "client_sk")),
    "fact_agent_activity": Spec(B.fact_agent_activity, ("events",), "event_date", "day",
                                ("agent_sk", "state_code")),
    "fact_queue_interval": Spec(B.fact_queue_interval, ("events",), "event_date", "day", ("queue_sk",)),
    "fact_csat_survey": Spec(B.fact_csat_survey, ("events",), "event_date", "day", ("program_sk", "agent_sk")),
    "fact_billing_line": Spec(B.fact_billing_line, ("lineitem", "orders"), "period_month_date", "month",
                              ("client_sk", "program_sk")),
    "fact_adherence_daily": Spec(B.fact_adherence_daily, ("events",), "event_date", "day", ("agent_sk",), once=True),
    "fact_ticket": Spec(B.fact_ticket, ("orders", "lineitem"), "event_date", "day", ("program_sk", "status")),
    "agg_agent_daily": Spec(_agg_agent_daily, ("events", "customer"), "event_date", "day",
                            ("agent_sk", "site_code")),
    "agg_queue_hourly": Spec(_agg_queue_hourly, ("events",), "event_date", "day", ("queue_sk", "hour_of_day")),
    "ods_agent_scd2": Spec(ods_agent_scd2, ("orders",), "eff_from_ts", "year", ("agent_id",), once=True),
    "ods_client_acid": Spec(ods_client_acid, ("customer",), None, "day", ("client_id",)),
    "ods_agent_acid": Spec(ods_agent_acid, ("customer",), None, "day", ("agent_id",)),
    "ods_ticket_acid": Spec(ods_ticket_acid, ("orders",), None, "day", ("ticket_id",)),
    "ods_invoice_acid": Spec(ods_invoice_acid, ("orders",), None, "day", ("invoice_id",)),
}


def _code_version() -> str:
    """Hash of the modules whose code decides the warehouse tables' rows."""
    global _CODE_VERSION
    if _CODE_VERSION is None:
        import hashlib
        import inspect
        import sys

        h = hashlib.sha1()
        for mod in ("switchboard.plans.bindings", "switchboard.plans.warehouse", "switchboard.operators.history",
                    "switchboard.operators.aggregates", "switchboard.operators.sessions", "switchboard.operators.intervals",
                    "switchboard.functions.decode", "switchboard.operators.layout"):
            try:
                h.update(inspect.getsource(sys.modules[mod]).encode())
            except (KeyError, OSError, TypeError):
                h.update(mod.encode())
        _CODE_VERSION = h.hexdigest()[:12]
    return _CODE_VERSION


_CODE_VERSION: str | None = None


def wh_path(spark: SparkSession, sf: str, name: str) -> str:
    s = SPECS[name]
    return materialized_path(spark, name, sf, list(s.sources), lambda: s.build(spark, sf), s.partition,
                             list(s.cluster), s.grain, _code_version(), s.once)


def wh(spark: SparkSession, sf: str, name: str) -> DataFrame:
    s = SPECS[name]
    return materialized(spark, name, sf, list(s.sources), lambda: s.build(spark, sf),
                        s.partition, list(s.cluster), s.grain, _code_version(), s.once)


def wh_all(spark: SparkSession, sf: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """``wh`` of several tables; those not yet stored are written ``WRITERS`` at a time, the ones of most steps first."""
    names = sorted(names, key=lambda n: not SPECS[n].once)
    shared_dir(spark)       # where there is no such folder yet, one thread makes it
    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(wh), spark, sf, n) for n in names]
    return {n: f.result() for n, f in zip(names, found, strict=True)}


# Filter literals: the reference's 2026 dates moved into the test data's range.
EVENT_DAY = dt.date(2024, 1, 15)
BILLING_MONTH = dt.date(1996, 1, 1)
SCD2_FROM = dt.datetime(1998, 1, 1)
