"""Registered queries: type and key conversions (T1-T13) and the cast-loss audit (K1).

Legacy encodings are produced from ``events.ts`` / ``lineitem`` and decoded
back with the helpers of ``functions.decode``; each query returns the
encoded and decoded columns side by side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import checks as K
from switchboard.plans.catalog import register
from switchboard.sources.tables import table

# Declared target types of the lineitem columns.
LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "bigint",
    "l_quantity": "decimal(12,2)",
    "l_extendedprice": "decimal(14,2)",
    "l_discount": "decimal(12,4)",
    "l_tax": "decimal(12,4)",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp",
}


def cast_to_declared(df, types: dict[str, str]):
    """Every column cast to its declared target type (BIGINT, NUMERIC(p,s), ...)."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


@register("type_map_cast", """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(14,2)) AS l_extendedprice,
       CAST(l_discount AS DECIMAL(12,4)) AS l_discount, CAST(l_tax AS DECIMAL(12,4)) AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem""")
def type_map_cast(spark, sf):
    return cast_to_declared(table(spark, sf, "lineitem"), LINEITEM_TYPES)


def _ev(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type")


@register("string_date_partition", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS load_date_str, CAST(ts AS DATE) AS load_date,
       strftime(ts, '%Y-%m') AS work_month_str, CAST(date_trunc('month', ts) AS DATE) AS work_month
FROM events""")
def string_date_partition(spark, sf):
    e = _ev(spark, sf).select(
        "event_id",
        F.date_format("ts", X.DAY_FORMAT).alias("load_date_str"),
        X.encode_month("ts").alias("work_month_str"))
    return e.select("event_id", "load_date_str", X.decode_day("load_date_str").alias("load_date"),
                    "work_month_str", X.decode_month("work_month_str").alias("work_month"))


@register("date_key_to_date", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key, CAST(ts AS DATE) AS event_date
FROM events""")
def date_key_to_date(spark, sf):
    e = _ev(spark, sf).select("event_id", X.encode_date_key("ts").alias("date_key"))
    return e.select("event_id", "date_key", X.decode_date_key("date_key").alias("event_date"))


@register("period_month_to_date", """
SELECT event_id, strftime(ts, '%Y-%m') AS period_month, CAST(date_trunc('month', ts) AS DATE) AS period_month_date
FROM events""")
def period_month_to_date(spark, sf):
    e = _ev(spark, sf).select("event_id", X.encode_month("ts").alias("period_month"))
    return e.select("event_id", "period_month", X.decode_month("period_month").alias("period_month_date"))


@register("week_key_to_date", """
SELECT event_id, CAST(strftime(date_trunc('week', ts), '%Y%m%d') AS BIGINT) AS week_start_key,
       CAST(date_trunc('week', ts) AS DATE) AS week_start_date
FROM events""")
def week_key_to_date(spark, sf):
    e = _ev(spark, sf).select(
        "event_id", X.encode_date_key(X.iso_week_start(F.to_date("ts"))).alias("week_start_key"))
    return e.select("event_id", "week_start_key", X.decode_date_key("week_start_key").alias("week_start_date"))


@register("map_to_entries", """
SELECT event_id, k AS key, CAST(json_extract(props, '$."' || k || '"') AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def map_to_entries(spark, sf):
    """Legacy MAP<string,bigint> → ARRAY<STRUCT<key,value>>, returned one entry per row."""
    e = table(spark, sf, "events").select(
        "event_id", F.from_json("props", "map<string,bigint>").alias("props_map"))
    entries = e.select("event_id", F.map_entries("props_map").alias("entries"))
    return entries.select("event_id", F.explode("entries").alias("e")).select("event_id", "e.key", "e.value")


@register("decode_epoch_seconds", """
SELECT event_id, epoch_us(ts) // 1000000 AS start_epoch,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS start_ts
FROM events""")
def decode_epoch_seconds(spark, sf):
    e = _ev(spark, sf).select("event_id", X.epoch_seconds("ts").alias("start_epoch"))
    return e.select("event_id", "start_epoch", X.decode_epoch_seconds("start_epoch").alias("start_ts"))


@register("decode_epoch_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS created_ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS created_ts
FROM events""")
def decode_epoch_millis(spark, sf):
    e = _ev(spark, sf).select("event_id", X.epoch_millis("ts").alias("created_ms"))
    return e.select("event_id", "created_ms", X.decode_epoch_millis("created_ms").alias("created_ts"))


@register("decode_misnamed_epoch", """
SELECT event_id, epoch_us(ts) // 1000 AS issued_ts_sec, make_timestamp((epoch_us(ts) // 1000) * 1000) AS issued_ts
FROM events""")
def decode_misnamed_epoch(spark, sf):
    """``issued_ts_sec`` is named seconds but holds milliseconds."""
    e = _ev(spark, sf).select("event_id", X.epoch_millis("ts").alias("issued_ts_sec"))
    return e.select("event_id", "issued_ts_sec", X.decode_misnamed_epoch("issued_ts_sec").alias("issued_ts"))


# Error events carry only the date part (8 characters): junk for the
# 14-character format, so they decode to NULL.
@register("decode_oracle_string", """
SELECT event_id, s AS signed_dt, try_strptime(s, '%Y%m%d%H%M%S') AS signed_ts
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN strftime(ts, '%Y%m%d')
                            ELSE strftime(ts, '%Y%m%d%H%M%S') END AS s FROM events)""")
def decode_oracle_string(spark, sf):
    e = _ev(spark, sf).select(
        "event_id",
        F.when(F.col("event_type") == "error", F.date_format("ts", X.DATE_KEY_FORMAT))
        .otherwise(X.encode_oracle_string("ts")).alias("signed_dt"))
    return e.select("event_id", "signed_dt", X.decode_oracle_string("signed_dt").alias("signed_ts"))


# ---------------------------------------------------------------- K1
AUDIT_TARGETS = [("props", "bigint", "varchar"), ("value", "decimal(5,2)", "double"), ("value", "decimal(4,1)", "double"),
                 ("value", "decimal(38,9)", "double"), ("value", "float", "double"), ("event_id", "int", "bigint"),
                 ("user_id", "smallint", "bigint"), ("event_type", "date", "varchar")]


def _audit_sql(col: str, target: str, source: str) -> str:
    t = target.upper()
    loss = "FALSE"
    if source != "varchar":
        loss = f"TRY_CAST({col} AS {t}) IS NOT NULL AND CAST(TRY_CAST({col} AS {t}) AS {source.upper()}) IS DISTINCT FROM {col}"
    return f"""
SELECT '{col}' AS column_name, '{target}' AS target_type, CAST(COUNT(*) AS BIGINT) AS row_count,
       CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS null_count,
       CAST(COUNT(*) FILTER (WHERE {col} IS NOT NULL AND TRY_CAST({col} AS {t}) IS NULL) AS BIGINT) AS failed_casts,
       CAST(COUNT(*) FILTER (WHERE {loss}) AS BIGINT) AS scale_losses
FROM events"""


@register("cast_loss_audit", " UNION ALL ".join(_audit_sql(c, t, src) for c, t, src in AUDIT_TARGETS))
def cast_loss_audit(spark, sf):
    return K.cast_loss_audit(table(spark, sf, "events"), [(c, t) for c, t, _ in AUDIT_TARGETS])
