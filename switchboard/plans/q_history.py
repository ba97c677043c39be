"""Registered queries: change feeds, upserts, history, snapshots, keys and org tree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from switchboard.operators import dimensions as D
from switchboard.operators import history as H
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.oracle import scd2_sql, with_ctes
from switchboard.plans.warehouse import ods_ticket_acid
from switchboard.sources.tables import table

# ---------------------------------------------------------------- C1
LATEST_SQL = with_ctes("""
SELECT entity_id, change_ms, change_id, op, status, amount_cents, extract_ts,
       make_timestamp(change_ms * 1000) AS last_change_ts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY change_ms DESC, change_id DESC) AS rn
      FROM change_feed) x
WHERE rn = 1 AND op IS DISTINCT FROM 'D'""", "change_feed")


@register("cdc_latest_wins", LATEST_SQL)
def cdc_latest_wins(spark, sf):
    return H.cdc_latest_wins(B.change_feed(spark, sf), ["entity_id"])


# The state (deletes included) of the feed before the split, the delta merged
# in, read as current rows: the same as latest-wins over the whole feed.
@register("cdc_merge_into_base", LATEST_SQL)
def cdc_merge_into_base(spark, sf):
    state = H.cdc_state(B.feed_base(spark, sf), ["entity_id"])
    return H.cdc_current(H.cdc_merge_into_base(state, B.feed_delta(spark, sf), ["entity_id"]))


# ---------------------------------------------------------------- C2
# Base: tickets created before 1998; delta: tickets from 1997-07 on, escalated.
UPSERT_BASE_BEFORE = dt.datetime(1998, 1, 1)
UPSERT_DELTA_FROM = dt.datetime(1997, 7, 1)
UPSERT_SQL = with_ctes(f"""
, b AS (SELECT ticket_id, ticket_no, program_id, priority, status, created_ts, 'base' AS version
        FROM ods_ticket_acid WHERE created_ts < TIMESTAMP '{UPSERT_BASE_BEFORE}'),
  d AS (SELECT ticket_id, ticket_no, program_id, '1-URGENT' AS priority, status, created_ts, 'delta' AS version
        FROM ods_ticket_acid WHERE created_ts >= TIMESTAMP '{UPSERT_DELTA_FROM}')
SELECT * FROM d
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.ticket_id = b.ticket_id)""", "ods_ticket_acid")


@register("upsert_merge", UPSERT_SQL)
def upsert_merge(spark, sf):
    t = ods_ticket_acid(spark, sf)
    base = t.filter(F.col("created_ts") < F.lit(UPSERT_BASE_BEFORE)).withColumn("version", F.lit("base"))
    delta = (t.filter(F.col("created_ts") >= F.lit(UPSERT_DELTA_FROM))
             .withColumn("priority", F.lit("1-URGENT")).withColumn("version", F.lit("delta")))
    return H.upsert(base, delta, ["ticket_id"])


# ---------------------------------------------------------------- C3
SCD2_SQL = scd2_sql("SELECT user_id AS agent_id, event_type AS status, ts, event_id FROM events",
                    "agent_id", "ts", ["status"], "event_id", "agent_history_id")


@register("scd2_history", SCD2_SQL)
def scd2_history(spark, sf):
    ev = table(spark, sf, "events").select(
        F.col("user_id").alias("agent_id"), F.col("event_type").alias("status"), "ts", "event_id")
    h = H.scd2_history(ev, "agent_id", "ts", ["status"], tie_col="event_id", id_col="agent_history_id")
    return h.select("agent_history_id", "agent_id", "status", "eff_from_ts", "eff_to_ts", "is_current")


# ---------------------------------------------------------------- C18
@register("snapshot_latest", """
SELECT o_custkey, load_date, o_orderkey, o_orderstatus, o_orderpriority
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS load_date, o_orderkey, o_orderstatus, o_orderpriority,
             ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
      FROM orders) x WHERE rn = 1""")
def snapshot_latest(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("load_date"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    return H.latest_per_key(o, ["o_custkey"], ["load_date", "o_orderkey"])


# ---------------------------------------------------------------- C19
@register("dim_sk_lookup", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, c.c_custkey AS client_id, s.s_suppkey AS program_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer c ON o_custkey = c.c_custkey
LEFT JOIN supplier s ON l_suppkey = s.s_suppkey""")
def dim_sk_lookup(spark, sf):
    clients = D.with_surrogate_key(table(spark, sf, "customer").select(F.col("c_custkey").alias("client_id")),
                                   "client_sk", ["client_id"], "client")
    programs = D.with_surrogate_key(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("program_id")),
                                    "program_sk", ["program_id"], "program")
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    fact = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("o_custkey").alias("client_id"), F.col("l_suppkey").alias("program_id"))
    keyed = D.lookup_keys(fact, [(clients, ["client_id"], "client_sk"), (programs, ["program_id"], "program_sk")])
    back = D.resolve_keys(keyed, [(clients, "client_sk", ["client_id"]), (programs, "program_sk", ["program_id"])])
    return back.select("l_orderkey", "l_linenumber", "client_id", "program_id")


# ---------------------------------------------------------------- C20
ORG_SQL = """
WITH units AS (
  SELECT CAST(0 AS BIGINT) AS org_unit_id, CAST(NULL AS BIGINT) AS parent_unit_id, 'ROOT' AS unit_code,
         'ROOT' AS unit_name, 'ROOT' AS unit_type
  UNION ALL SELECT 1000000000000 + r_regionkey, 0, 'R' || CAST(r_regionkey AS VARCHAR), r_name, 'REGION' FROM region
  UNION ALL SELECT 2000000000000 + n_nationkey, 1000000000000 + n_regionkey, 'N' || CAST(n_nationkey AS VARCHAR),
                   n_name, 'NATION' FROM nation
  UNION ALL SELECT 3000000000000 + s_suppkey, 2000000000000 + s_nationkey, 'S' || CAST(s_suppkey AS VARCHAR),
                   s_name, 'SITE' FROM supplier),
p AS (
  SELECT u.org_unit_id, u.unit_code, u.unit_name, u.unit_type,
         list_filter([p3.unit_name, p2.unit_name, p1.unit_name, u.unit_name], lambda x: x IS NOT NULL) AS path
  FROM units u
  LEFT JOIN units p1 ON u.parent_unit_id = p1.org_unit_id
  LEFT JOIN units p2 ON p1.parent_unit_id = p2.org_unit_id
  LEFT JOIN units p3 ON p2.parent_unit_id = p3.org_unit_id)
SELECT org_unit_id, unit_code, unit_name, unit_type,
       path[1] AS level1_name, path[2] AS level2_name, path[3] AS level3_name, path[4] AS level4_name
FROM p"""


@register("org_levels", ORG_SQL)
def org_levels(spark, sf):
    units = D.org_units(table(spark, sf, "region"), table(spark, sf, "nation"), table(spark, sf, "supplier"))
    return D.flatten_org(units, depth=4)


# ---------------------------------------------------------------- C23
@register("primary_contact", """
SELECT client_id, contact_id, primary_contact_name, primary_contact_email
FROM (SELECT CAST(c_nationkey AS BIGINT) AS client_id, c_custkey AS contact_id, c_name AS primary_contact_name,
             'contact' || CAST(c_custkey AS VARCHAR) || '@client.example' AS primary_contact_email,
             ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey ASC) AS rn
      FROM customer) x WHERE rn = 1""")
def primary_contact(spark, sf):
    contacts = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("client_id"),
        F.col("c_custkey").alias("contact_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("contact"), F.col("c_custkey").cast("string"), F.lit("@client.example")).alias("email"),
        F.col("c_acctbal"))
    return D.primary_contact(contacts, "client_id", rank=[F.col("c_acctbal"), -F.col("contact_id")])
