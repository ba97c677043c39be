"""Registered queries: the reference's smoke scans and joins, key checks, as-of join."""

from __future__ import annotations

from pyspark.sql import functions as F

from switchboard.operators import checks as K
from switchboard.operators import history as H
from switchboard.operators import joins as J
from switchboard.plans import bindings as B
from switchboard.plans import warehouse as W
from switchboard.plans.catalog import register
from switchboard.plans.oracle import scd2_sql, with_ctes
from switchboard.plans.warehouse import EVENT_DAY, wh
from switchboard.sources.tables import table

DAY = EVENT_DAY.isoformat()

# ---------------------------------------------------------------- S2
# The reference's LIMIT 10 has no ORDER BY; a total order makes it comparable.
S2_SQL = with_ctes(f"""
SELECT * FROM stg_tel_call WHERE load_date = DATE '{DAY}' ORDER BY call_id LIMIT 10""", "stg_tel_call")


@register("scan_partition_filter", S2_SQL)
def scan_partition_filter(spark, sf):
    t = wh(spark, sf, "stg_tel_call")
    return t.filter(F.col("load_date") == F.lit(EVENT_DAY)).orderBy("call_id").limit(10)


# ---------------------------------------------------------------- J2
J2_SQL = with_ctes("""
SELECT c.call_id, q.queue_name FROM ods_call c JOIN ods_queue q ON c.queue_id = q.queue_id
ORDER BY c.call_id, q.queue_name LIMIT 10""", "ods_call", "ods_queue")


@register("ods_join_queue", J2_SQL)
def ods_join_queue(spark, sf):
    return J.ods_join_queue(B.ods_call(spark, sf), B.ods_queue(spark, sf)) \
        .orderBy("call_id", "queue_name").limit(10)


# ---------------------------------------------------------------- J3
J3_SQL = with_ctes(f"""
SELECT f.interaction_id, a.full_name, p.program_name
FROM fact_interaction f JOIN dim_agent a ON f.agent_sk = a.agent_sk
JOIN dim_program p ON f.program_sk = p.program_sk
WHERE f.event_date = DATE '{DAY}'
ORDER BY f.interaction_id, a.full_name, p.program_name LIMIT 10""",
                   "fact_interaction", "dim_agent", "dim_program")


@register("dm_star_join", J3_SQL)
def dm_star_join(spark, sf):
    out = J.star_join(wh(spark, sf, "fact_interaction"), B.dim_agent(spark, sf), B.dim_program(spark, sf),
                      F.col("event_date") == F.lit(EVENT_DAY))
    return out.orderBy("interaction_id", "full_name", "program_name").limit(10)


# ---------------------------------------------------------------- J4 / K2
# Documented key paths that the test tables can fill: child table -> {path: key column}, and each path's parent.
KEY_PATHS = {
    "fact_agent_activity": {"fact_agent_activity.agent_sk": "agent_sk"},
    "fact_interaction": {f"fact_interaction.{c}": c for c in ("agent_sk", "client_sk", "program_sk", "queue_sk")},
    "fact_queue_interval": {"fact_queue_interval.queue_sk": "queue_sk"},
    "fact_csat_survey": {f"fact_csat_survey.{c}": c for c in ("agent_sk", "client_sk", "program_sk")},
    "fact_billing_line": {f"fact_billing_line.{c}": c for c in ("client_sk", "program_sk")},
    "fact_adherence_daily": {"fact_adherence_daily.agent_sk": "agent_sk"},
    "fact_ticket": {"fact_ticket.program_sk": "program_sk"},
    "ods_invoice_acid": {"ods_invoice_acid.client_id": "client_id"},
    "ods_ticket_acid": {"ods_ticket_acid.program_id": "program_id"},
    "ods_agent_scd2": {"ods_agent_scd2.agent_id": "agent_id"},
}
# Key name (without _sk / _id) -> parent table and its key.
PARENTS = {"agent": ("dim_agent", "agent_sk"), "client": ("ods_client_acid", "client_id"),
           "program": ("dim_program", "program_sk"), "queue": ("ods_queue", "queue_id")}


def _parent_paths() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for paths in KEY_PATHS.values():
        for path, key in paths.items():
            out.setdefault(key.rsplit("_", 1)[0], []).append(path)
    return out


ORPHAN_SQL = with_ctes(
    ", paths AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT '{path}' AS path, {key} AS k FROM {t}" for t, paths in KEY_PATHS.items() for path, key in paths.items())
    + "),\nparents AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT DISTINCT '{path}' AS path, {PARENTS[p][1]} AS k, 1 AS hit FROM {PARENTS[p][0]}"
        for p, paths in _parent_paths().items() for path in paths) + """)
SELECT x.path, CAST(COUNT(*) AS BIGINT) AS child_rows,
       CAST(COUNT(*) FILTER (WHERE x.k IS NULL) AS BIGINT) AS null_key_rows,
       CAST(COUNT(*) FILTER (WHERE x.k IS NOT NULL AND hit IS NULL) AS BIGINT) AS orphan_rows,
       CAST(COUNT(DISTINCT CASE WHEN x.k IS NOT NULL AND hit IS NULL THEN x.k END) AS BIGINT) AS orphan_keys
FROM paths x LEFT JOIN parents p ON x.path = p.path AND x.k = p.k
GROUP BY x.path""", *KEY_PATHS, *[t for t, _ in PARENTS.values()]).replace("\n, paths", ",\npaths", 1)


@register("fk_orphans", ORPHAN_SQL)
def fk_orphans(spark, sf):
    children = parents = None
    # the stored tables: only the key columns are read, and no binding is computed again
    stored = W.wh_all(spark, sf, [t for t in KEY_PATHS if t in W.SPECS])
    for t, paths in KEY_PATHS.items():
        rows = K.key_paths(stored[t] if t in stored else getattr(B, t)(spark, sf), paths)
        children = rows if children is None else children.unionByName(rows)
    for p, paths in _parent_paths().items():
        name, key = PARENTS[p]
        rows = K.key_paths((getattr(B, name) if hasattr(B, name) else getattr(W, name))(spark, sf), {x: key for x in paths})
        parents = rows if parents is None else parents.unionByName(rows)
    return K.fk_orphans(children, parents)


DUP_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(COUNT(*) AS BIGINT) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""


@register("pk_duplicates", DUP_SQL)
def pk_duplicates(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint"))
    return K.pk_duplicates(li, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- J5
# Each shipped line with the status its customer had at ship time
# (history: orders as status changes of o_custkey).
ASOF_SQL = f"""
WITH hist AS ({scd2_sql(
    "SELECT o_custkey AS agent_id, o_orderstatus AS status, o_orderdate AS changed_at, o_orderkey AS seq "
    "FROM orders", "agent_id", "changed_at", ["status"], "seq", "agent_history_id")}),
probe AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, o_custkey AS agent_id,
                 l_shipdate AS ship_ts
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT p.l_orderkey, p.l_linenumber, p.agent_id, p.ship_ts, h.eff_from_ts, h.status
FROM probe p LEFT JOIN hist h ON p.agent_id = h.agent_id AND p.ship_ts >= h.eff_from_ts
  AND (h.eff_to_ts IS NULL OR p.ship_ts < h.eff_to_ts)"""


@register("scd2_asof_join", ASOF_SQL)
def scd2_asof_join(spark, sf):
    """Probes against the stored type-2 table (``ods_agent_scd2``: the same
    history, written once in its year layout) rather than a recomputed one."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    hist = wh(spark, sf, "ods_agent_scd2")
    probe = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("o_custkey").alias("agent_id"), F.col("l_shipdate").alias("ship_ts"))
    out = H.asof_join(probe, hist, "agent_id", "ship_ts", ["status"])
    return out.select("l_orderkey", "l_linenumber", "agent_id", "ship_ts", "eff_from_ts", "status")
