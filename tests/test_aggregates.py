"""A1-A4 on inline edge frames: NULL keys, NULL / lower-case state codes, duplicate
dimension keys, zero occurrences, ISO-week and UTC-hour boundaries, decimal ties."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import aggregates as A

FACT_SCHEMA = ("agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, "
               "first_state_ts timestamp, last_state_ts timestamp, event_date date")
DIM_SCHEMA = "agent_sk bigint, site_code string"


def _fact(spark, rows):
    return spark.createDataFrame([(a, c, s, n, None, None, d) for a, c, s, n, d in rows], FACT_SCHEMA)


def test_agent_daily_edges(spark):
    d = dt.date(2026, 1, 1)
    fact = _fact(spark, [
        (1, "TALK", 100, 2, d),
        (1, "ACW", 50, 1, d),
        (1, "AUX1", 30, 1, d),
        (1, "AUX2", 20, 1, d),
        (1, "talk", 7, 1, d),      # lower case: not TALK
        (1, None, 3, 1, d),        # NULL state: ELSE 0
        (None, "TALK", 999, 1, d),  # NULL key never joins
        (2, "TALK", 10, 1, d),
    ])
    dim = spark.createDataFrame([(1, "S1"), (2, "S2"), (2, "S2")], DIM_SCHEMA)  # agent 2 twice: fan-out
    rows = {r.agent_sk: r for r in A.agg_agent_daily(fact, dim).collect()}
    assert set(rows) == {1, 2}
    r1 = rows[1]
    assert r1.interactions_handled == 7
    assert (r1.talk_seconds, r1.acw_seconds, r1.aux_seconds) == (100, 50, 50)
    # mean of state_seconds over the six rows: 210 / 6
    assert r1.avg_handle_seconds == Decimal("35.000000000")
    assert r1.adherence_pct == Decimal("0E-9") and r1.occupancy_pct == Decimal("0E-9")
    r2 = rows[2]
    assert r2.interactions_handled == 2 and r2.talk_seconds == 20      # doubled by the duplicate key
    assert r2.avg_handle_seconds == Decimal("10.000000000")            # mean unchanged


def test_agent_weekly_iso_week_and_zero_occurrences(spark):
    days = [dt.date(2025, 12, 29), dt.date(2026, 1, 1), dt.date(2026, 1, 4), dt.date(2026, 1, 5)]
    fact = _fact(spark, [(1, "TALK", 60, 1, d) for d in days] + [(3, "TALK", 5, 0, days[0])])
    dim = spark.createDataFrame([(1, "S1"), (3, "S3")], DIM_SCHEMA)
    out = {(r.agent_sk, r.week_start_date): r for r in A.agg_agent_weekly(fact, dim).collect()}
    wk1 = out[(1, dt.date(2025, 12, 29))]
    assert wk1.days_worked == 3 and wk1.interactions_handled == 3
    assert wk1.avg_handle_seconds == Decimal("60.000000000")
    assert out[(1, dt.date(2026, 1, 5))].days_worked == 1
    assert out[(3, dt.date(2025, 12, 29))].avg_handle_seconds is None   # SAFE_DIVIDE by 0


def test_queue_hourly_utc_hours_and_mean(spark):
    schema = "queue_sk bigint, interval_start_ts timestamp, offered bigint, answered bigint, abandoned bigint, " \
             "answered_in_sl bigint, event_date date"
    rows = [(1, dt.datetime(2026, 1, 1, 23, 59, 59), 3, 2, 1, 1, dt.date(2026, 1, 1)),
            (1, dt.datetime(2026, 1, 1, 23, 30, 0), 2, 2, 0, 2, dt.date(2026, 1, 1)),
            (1, dt.datetime(2026, 1, 2, 0, 0, 0), 1, 1, 0, 0, dt.date(2026, 1, 1))]  # own event_date kept
    out = {(r.hour_of_day, r.event_date): r for r in A.agg_queue_hourly(spark.createDataFrame(rows, schema)).collect()}
    assert out[(23, dt.date(2026, 1, 1))].offered == 5
    assert out[(23, dt.date(2026, 1, 1))].sl_pct == Decimal("1.500000000")
    assert out[(0, dt.date(2026, 1, 1))].offered == 1


def test_site_daily_agents_exact_and_estimated(spark):
    fact = _fact(spark, [(i, "TALK", 1, 1, dt.date(2026, 1, 1)) for i in range(300)])
    dim = spark.createDataFrame([(i, "S") for i in range(300)], DIM_SCHEMA)
    assert A.agg_site_daily(fact, dim).collect()[0].agents_active == 300
    assert abs(A.agg_site_daily(fact, dim, rsd=0.01).collect()[0].agents_active - 300) <= 15


def test_decimal_tie_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 1024)], "t bigint, n bigint")
    got = df.select(X.exact_mean(F.col("t"), F.col("n")).alias("m")).collect()[0].m
    assert got == Decimal("0.000976563")  # 0.0009765625 → HALF_UP at 9 places
    got2 = df.select(X.exact_ratio(F.lit(1), F.lit(8), 2, 5).alias("m")).collect()[0].m
    assert got2 == Decimal("0.13")        # 0.125 → 0.13


def test_declared_output_schemas(spark):
    """Column names, order and types of A1-A4 as declared (the data side of the schema specs)."""
    from pyspark.sql.types import _parse_datatype_string  # noqa: PLC0415 - test-only parser

    from switchboard.plans import bindings as B
    sf = "/root/testdata/sf0.001"
    fact, dim = B.fact_agent_activity(spark, sf), B.dim_agent(spark, sf)
    produced = {
        "agg_agent_daily": A.agg_agent_daily(fact, dim),
        "agg_agent_weekly": A.agg_agent_weekly(fact, dim),
        "agg_queue_hourly": A.agg_queue_hourly(B.fact_queue_interval(spark, sf)),
        "agg_site_daily": A.agg_site_daily(fact, dim),
    }
    for name, df in produced.items():
        want = _parse_datatype_string(A.DECLARED[name])
        got = [(f.name, f.dataType) for f in df.schema.fields]
        assert got == [(f.name, f.dataType) for f in want.fields], name
        assert df.limit(0).count() == 0     # SELECT * ... LIMIT 0 runs


def test_safe_ratio_negative_and_zero(spark):
    df = spark.createDataFrame([(-50, 4), (7, 0), (1, 3)], "n bigint, d bigint")
    got = [r.v for r in df.select(X.safe_ratio_numeric(F.col("n") * 100, F.col("d")).alias("v")).collect()]
    assert got == [Decimal("-1250.000000000"), None, Decimal("33.333333333")]


def test_forecast_rows_of_one_hour_are_summed(spark):
    from switchboard.operators import rollups
    hourly = spark.sql("SELECT 1L AS queue_sk, 9L AS hour_of_day, h AS offered, 1L AS answered, 0L AS abandoned, "
                       "CAST(1 AS DECIMAL(38,9)) AS sl_pct, CAST(NULL AS BIGINT) AS forecast_volume, "
                       "CAST(NULL AS DECIMAL(38,9)) AS volume_variance_pct, DATE'2024-01-01' + CAST(h AS INT) AS event_date "
                       "FROM VALUES 30L, 40L AS t(h)")
    forecast = spark.sql("SELECT 1L AS queue_sk, 9L AS hour_of_day, v AS forecast_volume, DATE'2024-01-01' + 30 AS event_date "
                         "FROM VALUES 5L, 15L AS t(v)")
    got = {r.offered: (r.forecast_volume, r.volume_variance_pct) for r in rollups.queue_hourly_forecast(hourly, forecast).collect()}
    assert got == {30: (20, 50), 40: (None, None)}
    assert rollups.queue_hourly_forecast(hourly, forecast).count() == 2
