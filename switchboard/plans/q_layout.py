"""Registered queries: layouts (S6-S12), retention, refresh, scan-pruning pairs (K4), profiles (K3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import aggregates as A
from switchboard.operators import checks as K
from switchboard.operators import layout as L
from switchboard.plans import bindings as B
from switchboard.plans import warehouse as W
from switchboard.plans.catalog import register
from switchboard.plans.oracle import BINDINGS, with_ctes
from switchboard.plans.q_aggregates import A1_SQL, A3_SQL
from switchboard.plans.warehouse import wh
from switchboard.session import fresh_path

DAY = W.EVENT_DAY.isoformat()


def _readback(spark, path, df, extra=()):
    out = spark.read.parquet(path)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields], *extra)


# ---------------------------------------------------------------- S6 + S9
@register("layout_day_cluster", with_ctes("SELECT * FROM fact_interaction", "fact_interaction"))
def layout_day_cluster(spark, sf):
    df = B.fact_interaction(spark, sf)
    path, _ = L.write_fresh(spark, "fact_interaction", df, "event_date", ["channel", "agent_sk", "client_sk"])
    return _readback(spark, path, df)


# ---------------------------------------------------------------- S7
@register("layout_month", with_ctes(
    "SELECT *, period_month_date AS period_month_date_month FROM fact_billing_line", "fact_billing_line"))
def layout_month(spark, sf):
    df = B.fact_billing_line(spark, sf)
    path, phys = L.write_fresh(spark, "fact_billing_line", df, "period_month_date", ["client_sk", "program_sk"],
                               grain="month")
    return _readback(spark, path, df, [F.col(phys).cast("date")])


# ---------------------------------------------------------------- S8 + T8
# The legacy shape carries eff_from_year; it is dropped and the year partition is
# re-derived from eff_from_ts.
@register("layout_year", f"""
WITH h AS ({BINDINGS['ods_agent_scd2']})
SELECT *, CAST(year(eff_from_ts) AS BIGINT) AS eff_from_ts_year FROM h""")
def layout_year(spark, sf):
    legacy = W.ods_agent_scd2(spark, sf).withColumn("eff_from_year", F.year("eff_from_ts"))
    df = legacy.drop("eff_from_year")
    path, phys = L.write_fresh(spark, "ods_agent_scd2", df, "eff_from_ts", ["agent_id"], grain="year")
    return _readback(spark, path, df, [F.col(phys).cast("bigint")])


# ---------------------------------------------------------------- S10
# Legacy (date_key, channel) partitions → partition by event_date, channel
# becomes the first cluster key.
@register("layout_demoted_partition", with_ctes("SELECT * FROM fact_interaction", "fact_interaction"))
def layout_demoted_partition(spark, sf):
    legacy = B.fact_interaction(spark, sf).withColumn("date_key", X.encode_date_key("event_date")) \
        .drop("event_date")
    df = (legacy.withColumn("event_date", X.decode_date_key("date_key")).drop("date_key")
          .select(*B.fact_interaction(spark, sf).columns))
    path, _ = L.write_fresh(spark, "fact_interaction_demoted", df, "event_date", ["channel", "agent_sk", "client_sk"])
    return _readback(spark, path, df)


# ---------------------------------------------------------------- S11
RETENTION_AS_OF = dt.date(2001, 8, 1)
RETENTION_KEEP_FROM = RETENTION_AS_OF - dt.timedelta(days=90)


def _orders_by_day(spark, sf):
    return W.orders_by_day(spark, sf)


@register("retention_90d", f"""
SELECT *, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '{RETENTION_KEEP_FROM.isoformat()}'""")
def retention_90d(spark, sf):
    """Expire day partitions of a copy of orders_by_day and return what remains, read with the declared schema."""
    df = _orders_by_day(spark, sf)
    path, _ = L.write_fresh(spark, "orders_by_day", df, "order_date", ["o_custkey"])
    L.drop_expired_partitions(spark, path, "order_date", RETENTION_AS_OF, 90)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- K3
@register("partition_profile", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(COUNT(*) AS BIGINT) AS row_count,
       MIN(o_custkey) AS min_cluster_key, MAX(o_custkey) AS max_cluster_key,
       CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS distinct_cluster_keys,
       CAST(o_orderdate AS DATE) <= DATE '{RETENTION_KEEP_FROM.isoformat()}' AS expired
FROM orders GROUP BY CAST(o_orderdate AS DATE)""")
def partition_profile(spark, sf):
    return K.partition_profile(_orders_by_day(spark, sf), "order_date", "o_custkey", RETENTION_AS_OF, 90)


# From the files of the laid-out table, whose cluster key is the first of the declared ones.
@register("partition_zone_profile", with_ctes(f"""
SELECT event_date, CAST(COUNT(*) AS BIGINT) AS row_count, MIN(program_sk) AS min_cluster_key, MAX(program_sk) AS max_cluster_key,
       event_date <= DATE '{RETENTION_KEEP_FROM.isoformat()}' AS expired
FROM fact_ticket GROUP BY event_date""", "fact_ticket"))
def partition_zone_profile(spark, sf):
    zones = K.zone_map(wh(spark, sf, "fact_ticket"), "program_sk", "event_date")
    return K.zone_profile(zones, RETENTION_AS_OF, 90).withColumnRenamed("zone_partition", "event_date")


# ---------------------------------------------------------------- K4, from file statistics
# Tables whose only layout is their cluster key, and a copy of one of them with its rows dealt out by a hash of the whole row,
# for which the check turns false.
CLUSTERED = {"ods_client_acid": "client_id", "ods_agent_acid": "agent_id", "ods_ticket_acid": "ticket_id",
             "ods_invoice_acid": "invoice_id"}
UNCLUSTERED_FILES = 8


@register("clustering_check", """
SELECT * FROM (VALUES ('ods_client_acid', TRUE), ('ods_agent_acid', TRUE), ('ods_ticket_acid', TRUE), ('ods_invoice_acid', TRUE),
                      ('ods_ticket_acid, unclustered copy', FALSE)) t(table_name, clustered)
CROSS JOIN LATERAL (SELECT CAST(CASE WHEN t.table_name IN ('ods_client_acid', 'ods_agent_acid')
                                     THEN (SELECT COUNT(*) FROM customer) ELSE (SELECT COUNT(*) FROM orders) END AS BIGINT) AS row_count,
                           CASE WHEN t.table_name IN ('ods_client_acid', 'ods_agent_acid')
                                THEN (SELECT MIN(c_custkey) FROM customer) ELSE (SELECT MIN(o_orderkey) FROM orders) END AS min_key,
                           CASE WHEN t.table_name IN ('ods_client_acid', 'ods_agent_acid')
                                THEN (SELECT MAX(c_custkey) FROM customer) ELSE (SELECT MAX(o_orderkey) FROM orders) END AS max_key) r""")
def clustering_check(spark, sf):
    tickets = wh(spark, sf, "ods_ticket_acid")
    copy = fresh_path(spark, "unclustered")
    tickets.repartition(UNCLUSTERED_FILES, F.xxhash64(*tickets.columns)).write.parquet(copy)
    stored = {name: (wh(spark, sf, name), key) for name, key in CLUSTERED.items()}
    stored["ods_ticket_acid, unclustered copy"] = (spark.read.schema(tickets.schema).parquet(copy), "ticket_id")
    zones = None
    for name, (df, key) in stored.items():
        # every table is one partition of a common zone map
        own = K.zone_map(df, key).withColumn("zone_partition", F.lit(name))
        zones = own if zones is None else zones.unionByName(own)
    total = zones.groupBy(F.col("zone_partition").alias("table_name")).agg(
        F.sum("row_count").alias("row_count"), F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"))
    depth = K.overlap_depth(zones).select(F.col("zone_partition").alias("table_name"), (F.col("depth") <= 1).alias("clustered"))
    return depth.join(total, "table_name")


# ---------------------------------------------------------------- S12
# The stored fact and aggregate cover days before the split; the delta
# restates the split's previous day and brings the later days. Only touched
# day partitions of the fact and of the aggregate are rewritten.
REFRESH_SPLIT = dt.date(2024, 1, 16)


@register("mv_incremental_refresh", A1_SQL)
def mv_incremental_refresh(spark, sf):
    fact = B.fact_agent_activity(spark, sf)
    dim = B.dim_agent(spark, sf)
    base = fact.filter(F.col("event_date") < F.lit(REFRESH_SPLIT))
    delta = fact.filter(F.col("event_date") >= F.lit(REFRESH_SPLIT - dt.timedelta(days=1)))
    fact_path = fresh_path(spark, "fact_agent_activity")
    agg_path = fresh_path(spark, "agg_agent_daily")
    L.write_layout(base, fact_path, "event_date", ["agent_sk", "state_code"])
    stored_fact = _readback(spark, fact_path, fact)
    L.write_layout(A.agg_agent_daily(stored_fact, dim), agg_path, "event_date", ["agent_sk", "site_code"])
    L.refresh_aggregate(spark, fact_path, agg_path, delta, "event_date",
                        lambda f: A.agg_agent_daily(f, dim), ["agent_sk", "state_code"], ["agent_sk", "site_code"])
    return _readback(spark, agg_path, A.agg_agent_daily(fact, dim))


# ---------------------------------------------------------------- K4: 14 scan-pruning pairs
# The objects and the columns of their filters.
TICKET_DAY = dt.date(1996, 1, 15)
PRUNED = {
    "fact_interaction": (f"event_date = DATE '{DAY}' AND channel = 'VOICE'",
                         lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("channel") == "VOICE")),
    "fact_agent_activity": (f"event_date = DATE '{DAY}' AND agent_sk = 1",
                            lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("agent_sk") == 1)),
    "fact_queue_interval": (f"event_date = DATE '{DAY}' AND queue_sk = 1",
                            lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("queue_sk") == 1)),
    "fact_csat_survey": (f"event_date = DATE '{DAY}' AND program_sk = 1",
                         lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("program_sk") == 1)),
    "fact_billing_line": (f"period_month_date = DATE '{W.BILLING_MONTH.isoformat()}' AND client_sk = 1",
                          lambda: (F.col("period_month_date") == F.lit(W.BILLING_MONTH))
                          & L.implied_partition_filter("period_month_date", "month", "==", W.BILLING_MONTH)
                          & (F.col("client_sk") == 1)),
    "fact_adherence_daily": (f"event_date = DATE '{DAY}' AND agent_sk = 1",
                             lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("agent_sk") == 1)),
    "fact_ticket": (f"event_date = DATE '{TICKET_DAY.isoformat()}' AND program_sk = 1",
                    lambda: (F.col("event_date") == F.lit(TICKET_DAY)) & (F.col("program_sk") == 1)),
    "agg_agent_daily": (f"event_date = DATE '{DAY}' AND agent_sk = 1",
                        lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("agent_sk") == 1)),
    "agg_queue_hourly": (f"event_date = DATE '{DAY}' AND queue_sk = 1",
                         lambda: (F.col("event_date") == F.lit(W.EVENT_DAY)) & (F.col("queue_sk") == 1)),
    "ods_agent_scd2": (f"eff_from_ts >= TIMESTAMP '{W.SCD2_FROM.isoformat(sep=' ')}' AND agent_id = 1",
                       lambda: (F.col("eff_from_ts") >= F.lit(W.SCD2_FROM))
                       & L.implied_partition_filter("eff_from_ts", "year", ">=", W.SCD2_FROM)
                       & (F.col("agent_id") == 1)),
    "ods_client_acid": ("client_id = 1", lambda: F.col("client_id") == 1),
    "ods_agent_acid": ("agent_id = 1", lambda: F.col("agent_id") == 1),
    "ods_ticket_acid": ("ticket_id = 1", lambda: F.col("ticket_id") == 1),
    "ods_invoice_acid": ("invoice_id = 1", lambda: F.col("invoice_id") == 1),
}


def _pruned_oracle(name: str, where: str) -> str:
    if name == "agg_agent_daily":
        body = A1_SQL
    elif name == "agg_queue_hourly":
        body = A3_SQL
    else:
        body = with_ctes(f"SELECT * FROM {name}", name)
    return f"""
WITH t AS ({body})
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM t) AS total_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM t WHERE {where}) AS filtered_rows,
       TRUE AS filtered_le_total"""


def _make_pruned(name: str, pred):
    def run(spark, sf):
        return K.pruned_count(W.wh(spark, sf, name), pred())
    run.__name__ = f"pruned_count_{name}"
    return run


for _name, (_where, _pred) in PRUNED.items():
    register(f"pruned_count_{_name}", _pruned_oracle(_name, _where))(_make_pruned(_name, _pred))


# ---------------------------------------------------------------- S12, streaming form
@register("mv_refresh_on_arrival", A1_SQL)
def mv_refresh_on_arrival(spark, sf):
    """The fact lands as files in two batches (days before the split; then the
    split's previous day restated plus the later days); a file stream refreshes
    the stored aggregate after each batch (``streaming.refresh``)."""
    from switchboard.streaming.refresh import land, start_refresh

    fact = B.fact_agent_activity(spark, sf)
    dim = B.dim_agent(spark, sf)
    landing, fact_path, agg_path = (fresh_path(spark, "landing_fact"), fresh_path(spark, "fact_agent_activity"),
                                    fresh_path(spark, "agg_agent_daily"))
    batches = [fact.filter(F.col("event_date") < F.lit(REFRESH_SPLIT)),
               fact.filter(F.col("event_date") >= F.lit(REFRESH_SPLIT - dt.timedelta(days=1)))]
    for i, batch in enumerate(batches):
        land(batch, landing, i)
        q = start_refresh(spark, landing, fact.schema, fact_path, agg_path, lambda f: A.agg_agent_daily(f, dim),
                          "event_date", ["agent_sk", "state_code"], ["agent_sk", "site_code"],
                          name=f"refresh_{landing.rsplit('-', 1)[-1]}_{i}", checkpoint=landing + "_checkpoint")
        q.awaitTermination()
    return _readback(spark, agg_path, A.agg_agent_daily(fact, dim))
