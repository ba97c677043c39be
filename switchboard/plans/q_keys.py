"""Registered queries: states by key bucket (C1, C2), the key registry (C19), org trees of any depth (C20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.operators import dimensions as D
from switchboard.operators import history as H
from switchboard.operators import key_registry as R
from switchboard.operators import keyed_state as K
from switchboard.plans import bindings as B
from switchboard.plans.catalog import register
from switchboard.plans.q_history import LATEST_SQL, UPSERT_BASE_BEFORE, UPSERT_DELTA_FROM, UPSERT_SQL
from switchboard.plans.warehouse import ods_ticket_acid
from switchboard.session import fresh_path
from switchboard.sources.tables import table


# ---------------------------------------------------------------- C1, C2 by key bucket
def _state(spark, sf: str, name: str, source: str, key: str) -> K.KeyedState:
    buckets = K.buckets_for(K.stored_bytes(spark, f"{sf.rstrip('/')}/{source}.parquet"))
    return K.KeyedState(fresh_path(spark, name), (key,), buckets)


# The feed before the split is stored as a state; the delta is merged into the buckets of its keys.
@register("cdc_bucket_merge", LATEST_SQL)
def cdc_bucket_merge(spark, sf):
    state = _state(spark, sf, "cdc_state", "events", "entity_id")
    stored = H.cdc_state(B.feed_base(spark, sf), ["entity_id"])
    K.store(state, stored)
    K.merge_changes(spark, state, B.feed_delta(spark, sf))
    return H.cdc_current(K.read(spark, state, stored))


@register("upsert_bucket_merge", UPSERT_SQL)
def upsert_bucket_merge(spark, sf):
    t = ods_ticket_acid(spark, sf)
    base = t.filter(F.col("created_ts") < F.lit(UPSERT_BASE_BEFORE)).withColumn("version", F.lit("base"))
    delta = (t.filter(F.col("created_ts") >= F.lit(UPSERT_DELTA_FROM))
             .withColumn("priority", F.lit("1-URGENT")).withColumn("version", F.lit("delta")))
    state = _state(spark, sf, "ods_ticket", "orders", "ticket_id")
    K.store(state, base)
    K.merge_upsert(spark, state, delta)
    return K.read(spark, state, base)


# ---------------------------------------------------------------- C19
# Day 1 brings the clients of three segments; then the orders come, also those of clients unknown so far; day 2
# brings one segment more. Clients of the last segment never come: those with orders have placeholder rows.
DAY_2, NEVER = "BUILDING", "MACHINERY"
UNKNOWN_NAME = "(not yet known)"


@register("dim_key_registry", f"""
WITH day1 AS (SELECT DISTINCT c_custkey AS client_id FROM customer WHERE c_mktsegment NOT IN ('{DAY_2}', '{NEVER}')),
     day2 AS (SELECT DISTINCT c_custkey AS client_id FROM customer WHERE c_mktsegment <> '{NEVER}'),
     k1 AS (SELECT client_id, ROW_NUMBER() OVER (ORDER BY client_id) AS client_sk, FALSE AS late FROM day1),
     f AS (SELECT DISTINCT o_custkey AS client_id FROM orders WHERE o_custkey IS NOT NULL),
     k2 AS (SELECT client_id, (SELECT COUNT(*) FROM k1) + ROW_NUMBER() OVER (ORDER BY client_id) AS client_sk, TRUE AS late
            FROM f WHERE client_id NOT IN (SELECT client_id FROM k1)),
     k12 AS (SELECT * FROM k1 UNION ALL SELECT * FROM k2),
     k3 AS (SELECT client_id, (SELECT COUNT(*) FROM k12) + ROW_NUMBER() OVER (ORDER BY client_id) AS client_sk, FALSE AS late
            FROM day2 WHERE client_id NOT IN (SELECT client_id FROM k12)),
     k AS (SELECT * FROM k12 UNION ALL SELECT * FROM k3)
SELECT k.client_sk, k.client_id,
       CASE WHEN c.c_custkey IS NULL THEN '{UNKNOWN_NAME}' ELSE c.c_name END AS client_name,
       c.c_custkey IS NULL AS is_placeholder, k.late, COALESCE(o.n, 0) AS order_count
FROM k LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> '{NEVER}') c ON c.c_custkey = k.client_id
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) o ON o.o_custkey = k.client_id""")
def dim_key_registry(spark, sf):
    """Orders are counted by surrogate key, so a wrong key shows in the client's row."""
    customer = table(spark, sf, "customer")
    segment, keys = F.col("c_mktsegment"), ["client_id"]
    clients = customer.select(F.col("c_custkey").alias("client_id"), F.col("c_name").alias("client_name"), "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("client_id"))
    path = fresh_path(spark, "client_keys")
    R.create(spark, path, clients, keys, "client_sk")
    R.add_keys(spark, path, clients.where(~segment.isin(DAY_2, NEVER)), keys, "client_sk")
    R.add_keys(spark, path, orders, keys, "client_sk", late=True)
    arrived = clients.where(segment != NEVER).drop("c_mktsegment")
    R.add_keys(spark, path, arrived, keys, "client_sk")
    registry = R.read(spark, path, clients, keys, "client_sk")
    # one row per key before the facts meet the registry
    facts = R.with_keys(orders.groupBy("client_id").agg(F.count(F.lit(1)).alias("order_count")), registry, keys, "client_sk")
    dim = R.dimension_rows(registry, arrived, keys, "client_sk", {"client_name": UNKNOWN_NAME})
    return (dim.join(registry.select("client_sk", R.LATE), "client_sk")
            .join(facts.select("client_sk", "order_count"), "client_sk", "left")
            .select("client_sk", "client_id", "client_name", "is_placeholder", R.LATE,
                    F.coalesce("order_count", F.lit(0).cast("bigint")).alias("order_count")))


# ---------------------------------------------------------------- C20, seven levels
def deep_units(region: DataFrame, nation: DataFrame, customer: DataFrame, orders: DataFrame) -> DataFrame:
    """root → region → nation → segment of a nation → customer → year of its orders → order."""
    def unit(df: DataFrame, own: str, above: str, name: str) -> DataFrame:
        return df.select(F.expr(own).alias("unit_id"), F.expr(above).alias("parent_id"), F.expr(name).alias("unit_name"))

    root = unit(region.sparkSession.range(1), "'ROOT'", "CAST(NULL AS STRING)", "'ROOT'")
    nation_of = "concat('N', c_nationkey)"
    parts = [
        unit(region, "concat('R', r_regionkey)", "'ROOT'", "r_name"),
        unit(nation, "concat('N', n_nationkey)", "concat('R', n_regionkey)", "n_name"),
        unit(customer.select("c_nationkey", "c_mktsegment").distinct(),
             f"concat({nation_of}, '-', c_mktsegment)", nation_of, "c_mktsegment"),
        unit(customer, "concat('C', c_custkey)", f"concat({nation_of}, '-', c_mktsegment)", "c_name"),
        unit(orders.select("o_custkey", F.year("o_orderdate").alias("y")).distinct(),
             "concat('C', o_custkey, '-', y)", "concat('C', o_custkey)", "CAST(y AS STRING)"),
        unit(orders, "concat('O', o_orderkey)", "concat('C', o_custkey, '-', year(o_orderdate))", "concat('order ', o_orderkey)"),
    ]
    out = root
    for part in parts:
        out = out.unionByName(part)
    return out


@register("org_levels_deep", """
WITH RECURSIVE units AS (
  SELECT 'ROOT' AS unit_id, CAST(NULL AS VARCHAR) AS parent_id, 'ROOT' AS unit_name
  UNION ALL SELECT 'R' || r_regionkey, 'ROOT', r_name FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
  UNION ALL SELECT DISTINCT 'N' || c_nationkey || '-' || c_mktsegment, 'N' || c_nationkey, c_mktsegment FROM customer
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey || '-' || c_mktsegment, c_name FROM customer
  UNION ALL SELECT DISTINCT 'C' || o_custkey || '-' || year(o_orderdate), 'C' || o_custkey,
                   CAST(year(o_orderdate) AS VARCHAR) FROM orders
  UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey || '-' || year(o_orderdate), 'order ' || o_orderkey FROM orders),
paths AS (
  SELECT unit_id, [unit_name] AS path FROM units u
  WHERE NOT EXISTS (SELECT 1 FROM units p WHERE p.unit_id = u.parent_id)
  UNION ALL SELECT u.unit_id, list_append(p.path, u.unit_name) FROM units u JOIN paths p ON u.parent_id = p.unit_id)
SELECT unit_id, CAST(len(path) AS INTEGER) AS unit_level, path[1] AS level1_name, path[2] AS level2_name,
       array_to_string(path, ' / ') AS full_path, FALSE AS is_cyclic
FROM paths""")
def org_levels_deep(spark, sf):
    units = deep_units(*(table(spark, sf, t) for t in ("region", "nation", "customer", "orders")))
    path = F.col("path")
    return D.org_paths(units, "unit_id", "parent_id", "unit_name").select(
        "unit_id", F.size(path).alias("unit_level"), F.get(path, 0).alias("level1_name"), F.get(path, 1).alias("level2_name"),
        F.concat_ws(" / ", path).alias("full_path"), "is_cyclic")
