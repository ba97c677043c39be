"""The bindings of ``plans/bindings.py`` as DuckDB SQL, for the oracle check.

Each entry is a CTE body over the pre-registered test views. ``with_ctes``
prefixes a query with the CTEs it names, in dependency order.
"""

from __future__ import annotations

CENTS = "CAST(ROUND({x} * 100) AS BIGINT)"
EPOCH_MS = "(epoch_us({x}) // 1000)"
EPOCH_S = "(epoch_us({x}) // 1000000)"
STATE_CASE = ("CASE event_type WHEN 'click' THEN 'TALK' WHEN 'view' THEN 'ACW' "
              "WHEN 'purchase' THEN 'AUX1' WHEN 'signup' THEN 'AUX2' WHEN 'error' THEN 'AVAIL' END")
CHANNEL_CASE = "CASE event_type WHEN 'click' THEN 'VOICE' WHEN 'view' THEN 'CHAT' ELSE 'EMAIL' END"
OP_CASE = "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END"


def cents(x: str) -> str:
    return CENTS.format(x=x)


def epoch_ms(x: str) -> str:
    return EPOCH_MS.format(x=x)


def exact_mean(total: str, count: str) -> str:
    """Non-negative total / count, rounded HALF_UP at scale 9, as DECIMAL(38,9), exactly."""
    q = f"((CAST({total} AS HUGEINT) * 2000000000 + {count}) // (2 * {count}))"
    return f"CAST(CAST({q} AS DECIMAL(28,0)) * CAST(0.000000001 AS DECIMAL(10,9)) AS DECIMAL(38,9))"


def dec_avg(x: str) -> str:
    """AVG(CAST(x AS NUMERIC)) for a non-negative integer x."""
    return exact_mean(f"SUM({x})", f"COUNT({x})")


BINDINGS: dict[str, str] = {}

BINDINGS["fact_agent_activity"] = f"""
  SELECT user_id AS agent_sk, {STATE_CASE} AS state_code,
         CAST(SUM({cents('value')}) AS BIGINT) AS state_seconds,
         CAST(COUNT(*) AS BIGINT) AS occurrence_count,
         MIN(ts) AS first_state_ts, MAX(ts) AS last_state_ts,
         CAST(ts AS DATE) AS event_date
  FROM events GROUP BY user_id, {STATE_CASE}, CAST(ts AS DATE)"""

BINDINGS["dim_agent"] = """
  SELECT c_custkey AS agent_sk, c_custkey AS agent_id, 'E' || CAST(c_custkey AS VARCHAR) AS employee_no,
         c_name AS full_name, CAST(c_nationkey AS BIGINT) AS org_unit_id, c_mktsegment AS team_name,
         'SITE_' || CAST(c_nationkey AS VARCHAR) AS site_code, TRUE AS is_current
  FROM customer"""

BINDINGS["fact_queue_interval"] = """
  SELECT queue_sk, interval_start_ts, offered, answered, abandoned, answered_in_sl,
         CAST(20 AS BIGINT) AS sl_threshold_sec, CAST(interval_start_ts AS DATE) AS event_date
  FROM (
    SELECT user_id % 25 AS queue_sk, time_bucket(INTERVAL 30 MINUTE, ts) AS interval_start_ts,
           CAST(COUNT(*) AS BIGINT) AS offered,
           CAST(COUNT(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS answered,
           CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS abandoned,
           CAST(COUNT(*) FILTER (WHERE event_type <> 'error' AND value < 20) AS BIGINT) AS answered_in_sl
    FROM events GROUP BY 1, 2) q"""

BINDINGS["fact_interaction"] = f"""
  SELECT CAST(event_id AS VARCHAR) AS interaction_id, user_id % 25 AS client_sk, event_id % 10 AS program_sk,
         user_id % 25 AS queue_sk, user_id AS agent_sk, 'C' || CAST(user_id AS VARCHAR) AS customer_ref,
         ts AS start_ts, CAST(ROUND(value) AS BIGINT) AS handle_seconds,
         (event_type = 'purchase') AS resolved_flag, 'events' AS source_system,
         CAST(ts AS DATE) AS event_date, {CHANNEL_CASE} AS channel
  FROM events"""

BINDINGS["dim_program"] = """
  SELECT s_suppkey AS program_sk, s_suppkey AS program_id, s_name AS program_name,
         CAST(s_nationkey AS BIGINT) AS client_id
  FROM supplier"""

BINDINGS["fact_csat_survey"] = """
  SELECT CAST(event_id AS VARCHAR) AS survey_id, CAST(event_id AS VARCHAR) AS interaction_id,
         user_id % 25 AS client_sk, event_id % 10 AS program_sk, user_id AS agent_sk, ts AS survey_ts,
         1 + event_id % 5 AS csat_score, event_id % 11 AS nps_score, event_type AS site_code,
         CAST(ts AS DATE) AS event_date
  FROM events"""

BINDINGS["fact_billing_line"] = """
  SELECT l_orderkey AS invoice_id, o_custkey AS client_sk, l_suppkey AS program_sk,
         CAST(l_linenumber AS BIGINT) AS line_no,
         CAST(l_quantity AS DECIMAL(12,2)) AS qty, CAST(l_extendedprice AS DECIMAL(14,2)) AS line_amount,
         (l_returnflag = 'R') AS adjustment_flag, o_orderstatus AS invoice_status,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS period_month_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

BINDINGS["fact_ticket"] = """
  SELECT o_orderkey AS ticket_id, o_orderkey % 10 AS program_sk, o_orderpriority AS priority,
         o_orderstatus AS status, o_orderdate AS created_ts, fs.resolved_ts,
         24 * (1 + o_orderkey % 60) AS sla_hours, CAST(o_orderdate AS DATE) AS event_date
  FROM orders LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS resolved_ts FROM lineitem GROUP BY l_orderkey) fs
    ON o_orderkey = fs.l_orderkey"""

# Stretches between neighbouring edges of an agent's day; active is what covers a whole stretch.
BINDINGS["fact_adherence_daily"] = """
  WITH e AS (SELECT user_id AS a, event_type AS kind, epoch_us(ts) // 1000000 AS t, CAST(ROUND(value * 100) AS BIGINT) AS work
             FROM events),
  shift AS (SELECT a, d * 86400 + (6 + a % 12) * 3600 AS s FROM (SELECT DISTINCT a, t // 86400 AS d FROM e) x),
  iv AS (SELECT a, 'S' AS kind, s, s + 28800 AS z FROM shift
         UNION ALL SELECT a, 'S', s + 25200, s + 36000 FROM shift WHERE a % 3 = 0
         UNION ALL SELECT a, 'W', t, t + work FROM e
         UNION ALL SELECT a, 'X', t - 900, t + 1800 FROM e WHERE kind = 'error'
         UNION ALL SELECT a, 'T', t - 3600, t + 3600 FROM e WHERE kind = 'signup'),
  cut AS (SELECT a, kind, d, greatest(s, d * 86400) AS s, least(z, (d + 1) * 86400) AS z
          FROM (SELECT *, unnest(range(s // 86400, (z - 1) // 86400 + 1)) AS d FROM iv WHERE z > s) x),
  edge AS (SELECT a, d, s AS t FROM cut UNION SELECT a, d, z FROM cut),
  seg AS (SELECT *, lead(t) OVER (PARTITION BY a, d ORDER BY t) AS u FROM edge),
  act AS (SELECT seg.a, seg.d, u - t AS len, bool_or(kind = 'S') AS s, bool_or(kind = 'W') AS w, bool_or(kind = 'X') AS x,
                 bool_or(kind = 'T') AS o
          FROM seg JOIN cut ON seg.a = cut.a AND seg.d = cut.d AND cut.s <= t AND cut.z >= u GROUP BY seg.a, seg.d, t, u)
  SELECT a AS agent_sk, CAST(coalesce(SUM(len) FILTER (s), 0) // 60 AS BIGINT) AS scheduled_minutes,
         CAST(coalesce(SUM(len) FILTER (s AND w), 0) // 60 AS BIGINT) AS worked_minutes,
         CAST(coalesce(SUM(len) FILTER (s AND x AND NOT o), 0) // 60 AS BIGINT) AS exception_minutes,
         CAST(coalesce(SUM(len) FILTER (s AND o), 0) // 60 AS BIGINT) AS timeoff_minutes,
         DATE '1970-01-01' + CAST(d AS INTEGER) AS event_date
  FROM act GROUP BY a, d"""

BINDINGS["stg_tel_call"] = """
  SELECT event_id AS call_id, '+1555' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS ani,
         '+1800' || lpad(CAST(user_id % 25 AS VARCHAR), 7, '0') AS dnis,
         user_id % 25 AS queue_id, user_id AS agent_id, event_id % 10 AS program_id,
         (epoch_us(ts) // 1000000) AS start_epoch,
         CASE WHEN event_type <> 'error' THEN (epoch_us(ts) // 1000000) END AS answer_epoch,
         (epoch_us(ts) // 1000000) + CAST(ROUND(value) AS BIGINT) AS end_epoch,
         upper(event_type) AS disposition_code, 'INBOUND' AS direction,
         'REC' || CAST(event_id AS VARCHAR) AS recording_id, CAST(ts AS DATE) AS load_date
  FROM events"""

BINDINGS["ods_call"] = """
  SELECT event_id AS call_id, user_id % 25 AS queue_id, user_id AS agent_id, event_id % 10 AS program_id,
         ts AS start_ts, CAST(ts AS DATE) AS call_date
  FROM events"""

BINDINGS["ods_queue"] = """
  SELECT CAST(n_nationkey AS BIGINT) AS queue_id, 'Q' || CAST(n_nationkey AS VARCHAR) AS queue_code,
         n_name AS queue_name, CAST(n_regionkey AS BIGINT) AS program_id, s.snapshot_date
  FROM nation, (VALUES (DATE '2024-01-01'), (DATE '2024-01-02')) s(snapshot_date)"""

BINDINGS["change_feed"] = f"""
  SELECT user_id AS entity_id, event_id AS change_id, {OP_CASE} AS op, {epoch_ms('ts')} AS change_ms,
         event_type AS status, {cents('value')} AS amount_cents, CAST(ts AS DATE) AS extract_ts
  FROM events"""

BINDINGS["feed_base"] = "SELECT * FROM change_feed WHERE extract_ts < DATE '2024-01-16'"
BINDINGS["feed_delta"] = "SELECT * FROM change_feed WHERE extract_ts >= DATE '2024-01-16'"

DEPENDS = {
    "feed_base": ["change_feed"],
    "feed_delta": ["change_feed"],
}


def with_ctes(sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n]}\n)" for n in order)
    return f"WITH {ctes}\n{sql}"

BINDINGS["ods_client_acid"] = """
  SELECT c_custkey AS client_id, 'CL' || CAST(c_custkey AS VARCHAR) AS client_code, c_name AS client_name,
         c_mktsegment AS industry, CAST(c_nationkey AS VARCHAR) AS hq_country, 'ACTIVE' AS status
  FROM customer"""

BINDINGS["ods_agent_acid"] = """
  SELECT c_custkey AS agent_id, 'E' || CAST(c_custkey AS VARCHAR) AS employee_no, c_name AS full_name,
         CAST(c_nationkey AS BIGINT) AS org_unit_id, c_mktsegment AS job_grade, 'ACTIVE' AS status
  FROM customer"""

BINDINGS["ods_ticket_acid"] = """
  SELECT o_orderkey AS ticket_id, 'T' || CAST(o_orderkey AS VARCHAR) AS ticket_no, o_orderkey % 10 AS program_id,
         o_orderpriority AS priority, o_orderstatus AS status, o_orderdate AS created_ts
  FROM orders"""

BINDINGS["ods_invoice_acid"] = """
  SELECT o_orderkey AS invoice_id, 'INV' || CAST(o_orderkey AS VARCHAR) AS invoice_no, o_custkey AS client_id,
         strftime(o_orderdate, '%Y-%m') AS period_month, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
         o_orderstatus AS status
  FROM orders"""


def scd2_sql(src: str, key: str, ts: str, attrs: list[str], seq: str, id_col: str) -> str:
    """Type-2 history over ``src`` (a subquery with key, ts, attrs, seq) in DuckDB."""
    a = ", ".join(attrs)
    prev = " OR ".join(f"prev_{x} IS DISTINCT FROM {x}" for x in attrs)
    lags = ", ".join(f"LAG({x}) OVER w AS prev_{x}" for x in attrs)
    return f"""
  SELECT CAST({key} AS VARCHAR) || ':' || CAST(epoch_us({ts}) AS VARCHAR) || ':' || CAST({seq} AS VARCHAR) AS {id_col},
         {key}, {a},
         CAST({ts} AS TIMESTAMP) AS eff_from_ts,
         CAST(LEAD({ts}) OVER (PARTITION BY {key} ORDER BY {ts}, {seq}) AS TIMESTAMP) AS eff_to_ts,
         LEAD({ts}) OVER (PARTITION BY {key} ORDER BY {ts}, {seq}) IS NULL AS is_current
  FROM (SELECT *, ROW_NUMBER() OVER w AS rn, {lags}
        FROM ({src}) s WINDOW w AS (PARTITION BY {key} ORDER BY {ts}, {seq})) t
  WHERE rn = 1 OR {prev}"""


BINDINGS["ods_agent_scd2"] = scd2_sql(
    "SELECT o_custkey AS agent_id, o_orderstatus AS status, o_orderdate AS changed_at, o_orderkey AS seq FROM orders",
    "agent_id", "changed_at", ["status"], "seq", "agent_history_id")


def exact_ratio(num: str, den: str, scale: int = 2, precision: int = 5) -> str:
    """num / den (non-negative integers), HALF_UP at ``scale``; NULL when den is 0."""
    mult = 10 ** scale
    q = f"((CAST({num} AS HUGEINT) * {2 * mult} + ({den})) // NULLIF(2 * ({den}), 0))"
    unit = f"CAST({1 / mult:.{scale}f} AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({q} AS DECIMAL(28,0)) * {unit} AS DECIMAL({precision},{scale}))"
