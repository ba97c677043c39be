"""Change feeds, upsert, type-2 history, as-of join, and the legacy decoders."""

import datetime as dt

from pyspark.sql import functions as F

from switchboard.functions import decode as X
from switchboard.operators import history as H

FEED = "entity_id bigint, change_id bigint, op string, change_ms bigint, status string"


def test_latest_wins_ties_and_deletes(spark):
    feed = spark.createDataFrame([
        (1, 10, "I", 1000, "a"), (1, 11, "U", 2000, "b"), (1, 12, "U", 2000, "c"),  # tie on change_ms → id 12
        (2, 20, "I", 1000, "a"), (2, 21, "D", 3000, None),                            # deleted last
        (3, 30, "D", 1000, None), (3, 31, "U", 4000, "z"),                            # re-created
    ], FEED)
    out = {r.entity_id: r for r in H.cdc_latest_wins(feed, ["entity_id"]).collect()}
    assert set(out) == {1, 3}
    assert out[1].status == "c" and out[1].change_id == 12
    assert out[1].last_change_ts == dt.datetime(1970, 1, 1, 0, 0, 2)
    assert out[3].status == "z"


def test_merge_into_base_equals_latest_over_all(spark):
    base = spark.createDataFrame([(1, 1, "I", 10, "a"), (2, 2, "I", 10, "a"), (3, 3, "D", 10, None)], FEED)
    delta = spark.createDataFrame([(1, 4, "U", 20, "b"), (2, 5, "D", 20, None), (3, 6, "U", 20, "c"),
                                   (4, 7, "I", 20, "d")], FEED)
    state = H.cdc_merge_into_base(H.cdc_state(base, ["entity_id"]), delta, ["entity_id"])
    assert {r.entity_id: r.status for r in H.cdc_current(state).collect()} == {1: "b", 3: "c", 4: "d"}
    # an update older than the delete arrives late: the key stays deleted; a NULL op deletes nothing
    late = spark.createDataFrame([(2, 8, "U", 15, "late"), (1, 9, None, 30, "null op")], FEED)
    state = H.cdc_merge_into_base(state, late, ["entity_id"])
    assert {r.entity_id: r.status for r in H.cdc_current(state).collect()} == {1: "null op", 3: "c", 4: "d"}


def test_upsert_delta_wins(spark):
    base = spark.createDataFrame([(1, "old"), (2, "keep")], "k bigint, v string")
    delta = spark.createDataFrame([(1, "new"), (3, "ins")], "k bigint, v string")
    assert sorted(H.upsert(base, delta, ["k"]).collect()) == [(1, "new"), (2, "keep"), (3, "ins")]
    # base rows that share a key stay, unless the delta has it; of equal delta keys the greatest order wins
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d")], "k bigint, v string")
    delta = spark.createDataFrame([(2, "x"), (2, "y")], "k bigint, v string")
    assert sorted(H.upsert(base, delta, ["k"], order=["v"]).collect()) == [(1, "a"), (1, "b"), (2, "y")]


def test_scd2_collapses_repeats_and_asof(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(5)]
    ev = spark.createDataFrame([(1, "A", t[0], 1), (1, "A", t[1], 2), (1, "B", t[2], 3), (1, None, t[3], 4),
                                (1, None, t[4], 5)], "agent_id bigint, status string, ts timestamp, seq bigint")
    h = H.scd2_history(ev, "agent_id", "ts", ["status"], tie_col="seq").orderBy("eff_from_ts").collect()
    assert [(r.status, r.eff_from_ts, r.eff_to_ts, r.is_current) for r in h] == [
        ("A", t[0], t[2], False), ("B", t[2], t[3], False), (None, t[3], None, True)]
    hist = H.scd2_history(ev, "agent_id", "ts", ["status"], tie_col="seq")
    probes = spark.createDataFrame([(1, dt.datetime(2023, 12, 31)), (1, t[2]), (1, dt.datetime(2024, 1, 1, 2, 30)),
                                    (2, t[0])], "agent_id bigint, at timestamp")
    got = {(r.agent_id, r.at): r.status for r in H.asof_join(probes, hist, "agent_id", "at", ["status"]).collect()}
    assert got[(1, dt.datetime(2023, 12, 31))] is None          # before the first row
    assert got[(1, t[2])] == "B"                                 # start is inclusive
    assert got[(1, dt.datetime(2024, 1, 1, 2, 30))] == "B"
    assert got[(2, t[0])] is None                                # no history for the key


def test_decoders(spark):
    df = spark.createDataFrame([
        (1704067199, 1704067199123, "20240101235959", 20240101, "2024-01"),
        (0, 0, "", 20251229, "2025-12"),
        (None, None, "junk", None, None),
        (None, None, "20240101", None, None),
    ], "s bigint, ms bigint, o string, k bigint, m string")
    rows = df.select(
        X.decode_epoch_seconds("s").alias("a"), X.decode_epoch_millis("ms").alias("b"),
        X.decode_misnamed_epoch("ms").alias("c"), X.decode_oracle_string("o").alias("d"),
        X.decode_date_key("k").alias("e"), X.decode_month("m").alias("f"),
        X.hour_of_day(X.decode_epoch_seconds("s")).alias("h")).collect()
    assert rows[0].a == dt.datetime(2023, 12, 31, 23, 59, 59) and rows[0].h == 23
    assert rows[0].b == dt.datetime(2023, 12, 31, 23, 59, 59, 123000) == rows[0].c
    assert rows[0].d == dt.datetime(2024, 1, 1, 23, 59, 59)
    assert rows[0].e == dt.date(2024, 1, 1) and rows[0].f == dt.date(2024, 1, 1)
    assert rows[1].a == dt.datetime(1970, 1, 1) and rows[1].h == 0 and rows[1].d is None
    assert rows[2].d is None and rows[3].d is None


def test_iso_week_start(spark):
    days = [dt.date(2025, 12, 29), dt.date(2026, 1, 1), dt.date(2026, 1, 4), dt.date(2026, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(X.iso_week_start("d").alias("w")).collect()]
    assert got == [dt.date(2025, 12, 29)] * 3 + [dt.date(2026, 1, 5)]
    assert df.select(X.encode_date_key(X.iso_week_start("d")).alias("k")).collect()[0].k == 20251229


def test_latest_per_key_uses_partial_aggregation(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = H.latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_chat_and_qa_array_forms_equal_row_forms(spark):
    from switchboard.operators import sessions as S
    msgs = spark.createDataFrame([("c1", "user", 0), ("c1", "assistant", 30000), ("c1", "assistant", 90000),
                                  ("c2", "assistant", 0), ("c2", "user", 30000), ("c3", "system", 0),
                                  ("c4", "assistant", 50), ("c4", "user", 100), ("c4", "assistant", 90), ("c4", "assistant", 5100),
                                  ("c5", "user", 59000), ("c5", "user", 61000), ("c5", "assistant", 62000), ("c5", None, None)],
                                 "chat_ref string, sender string, ts_ms bigint")
    arrays = msgs.groupBy("chat_ref").agg(F.collect_list(F.struct("sender", "ts_ms")).alias("messages"))
    a = sorted(map(tuple, S.chat_metrics(arrays).collect()))
    r = sorted(map(tuple, S.chat_metrics_rows(msgs).collect()))
    assert a == r
    assert [x[4] for x in a] == [30, None, None, 5, 3]
    secs = spark.createDataFrame([("f1", 50, 40), ("f1", 50, 25), ("f2", 50, 0)],
                                 "qa_form_id string, max_points bigint, scored_points bigint")
    forms = secs.groupBy("qa_form_id").agg(F.collect_list(F.struct("max_points", "scored_points")).alias("sections"))
    assert sorted(map(tuple, S.qa_totals(forms).collect())) == sorted(map(tuple, S.qa_totals_rows(secs).collect()))


def test_upsert_null_keys_never_match(spark):
    base = spark.createDataFrame([(None, "b1"), (1, "old")], "k bigint, v string")
    delta = spark.createDataFrame([(None, "d1"), (1, "new")], "k bigint, v string")
    got = sorted(H.upsert(base, delta, ["k"]).collect(), key=lambda r: (r.k is not None, r.k, r.v))
    assert [(r.k, r.v) for r in got] == [(None, "b1"), (None, "d1"), (1, "new")]


def test_asof_null_key_matches_nothing(spark):
    t0 = dt.datetime(2024, 1, 1)
    hist = spark.createDataFrame([(None, "X", t0, None), (1, "A", t0, None)],
                                 "agent_id bigint, status string, eff_from_ts timestamp, eff_to_ts timestamp")
    probes = spark.createDataFrame([(None, dt.datetime(2024, 1, 2)), (1, dt.datetime(2024, 1, 2))],
                                   "agent_id bigint, at timestamp")
    got = {r.agent_id: r.status for r in H.asof_join(probes, hist, "agent_id", "at", ["status"]).collect()}
    assert got == {None: None, 1: "A"}


def test_exact_ratio_at_any_denominator(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from pyspark.sql import functions as F

    from switchboard.functions import decode as X
    pairs = [(499999999999, 10**14), (500000000000, 10**14), (1, 3), (2, 3), (5, 1000), (0, 7), (7, 0), (10**17 + 5, 10**18),
             (123456789, 987654321987)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = {(r.n, r.d): r.q for r in df.select("n", "d", X.exact_ratio(F.col("n"), F.col("d")).alias("q")).collect()}
    for n, d in pairs:
        want = (Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP) if d else None
        assert got[n, d] == want
