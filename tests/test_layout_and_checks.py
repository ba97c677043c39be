"""Layouts, retention at the 90-day edge, incremental refresh, pruning pairs, data checks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from switchboard.operators import aggregates as A
from switchboard.operators import checks as K
from switchboard.operators import layout as L
from switchboard.session import fresh_path


def test_retention_edge(spark):
    as_of = dt.date(2026, 4, 1)
    days = [as_of - dt.timedelta(days=n) for n in (91, 90, 89, 0)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id bigint, load_date date")
    path = fresh_path(spark, "ret")
    L.write_layout(df, path, "load_date", ["id"])
    dropped = L.drop_expired_partitions(spark, path, "load_date", as_of, 90)
    assert dropped == [days[0].isoformat(), days[1].isoformat()]     # 91 and exactly 90 days old
    kept = sorted(r.load_date for r in spark.read.parquet(path).collect())
    assert kept == sorted([days[2], days[3]])
    # the same rule as a filter
    assert L.expire_partitions(df, "load_date", as_of, 90).count() == 2


def test_month_layout_and_implied_filter(spark):
    df = spark.createDataFrame([(i, dt.date(2026, 1 + i % 3, 1)) for i in range(30)], "id bigint, m date")
    path = fresh_path(spark, "month")
    phys = L.write_layout(df, path, "m", ["id"], grain="month")
    assert phys == "m_month"
    assert "m_month=2026-01-01" in os.listdir(path.replace("file:", ""))
    t = spark.read.parquet(path)
    pred = (F.col("m") == F.lit(dt.date(2026, 2, 1))) & L.implied_partition_filter("m", "month", "==",
                                                                                     dt.date(2026, 2, 1))
    q = t.filter(pred)
    assert q.count() == 10
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m_month" in plan


def test_pruned_count_pair(spark):
    df = spark.createDataFrame([(i % 5, dt.date(2026, 1, 1 + i % 3)) for i in range(60)], "k bigint, d date")
    path = fresh_path(spark, "pruned")
    L.write_layout(df, path, "d", ["k"])
    r = K.pruned_count(spark.read.parquet(path),
                       (F.col("d") == F.lit(dt.date(2026, 1, 2))) & (F.col("k") == 1)).collect()[0]
    assert (r.total_rows, r.filtered_rows, r.filtered_le_total) == (60, 4, True)


def test_incremental_refresh_matches_full(spark):
    schema = ("agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, "
              "first_state_ts timestamp, last_state_ts timestamp, event_date date")
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    rows = [(a, "TALK", 10 * a + i, 1, None, None, d) for i, d in enumerate(days) for a in (1, 2)]
    fact = spark.createDataFrame(rows, schema)
    dim = spark.createDataFrame([(1, "S1"), (2, "S2")], "agent_sk bigint, site_code string")
    fact_path, agg_path = fresh_path(spark, "f"), fresh_path(spark, "a")
    L.write_layout(fact.filter(F.col("event_date") < days[2]), fact_path, "event_date", ["agent_sk"])
    L.write_layout(A.agg_agent_daily(spark.read.parquet(fact_path), dim), agg_path, "event_date", ["agent_sk"])
    touched = L.refresh_aggregate(spark, fact_path, agg_path, fact.filter(F.col("event_date") >= days[1]),
                                  "event_date", lambda f: A.agg_agent_daily(f, dim), ["agent_sk"], ["agent_sk"])
    assert touched == days[1:]
    got = sorted((r.agent_sk, r.event_date, r.talk_seconds) for r in spark.read.parquet(agg_path).collect())
    want = sorted((r.agent_sk, r.event_date, r.talk_seconds) for r in A.agg_agent_daily(fact, dim).collect())
    assert got == want


def test_refresh_with_null_days_and_emptied_days(spark):
    schema = "k bigint, v bigint, d date"
    days = [dt.date(2026, 1, d) for d in (1, 2)]
    agg = lambda f: f.filter("v > 0").groupBy("k", "d").agg(F.sum("v").alias("v")).select("k", "v", "d")
    fact_path, agg_path = fresh_path(spark, "nf"), fresh_path(spark, "na")
    base = spark.createDataFrame([(1, 5, days[0]), (1, 6, days[1]), (2, 7, None)], schema)
    L.write_layout(base, fact_path, "d", ["k"])
    L.write_layout(agg(base), agg_path, "d", ["k"])
    # the restated first day has no rows that count; NULL and the second day change
    delta = spark.createDataFrame([(1, -1, days[0]), (1, 8, days[1]), (2, 9, None), (3, 1, None)], schema)
    assert L.refresh_aggregate(spark, fact_path, agg_path, delta, "d", agg, ["k"], ["k"]) == [*days, None]
    got = spark.read.schema(schema).parquet(agg_path).collect()
    assert sorted(((r.k, r.v, r.d) for r in got), key=repr) == sorted([(1, 8, days[1]), (2, 9, None), (3, 1, None)], key=repr)


def test_concurrent_builds_and_changed_inputs(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    src = str(tmp_path / "src")
    spark.range(10).write.parquet(f"{src}/t.parquet")

    def build(_=None):
        return L.materialized_path(spark, f"race-{tmp_path.name}", src, ["t"], spark.read.parquet(f"{src}/t.parquet"), None, ["id"])

    with ThreadPoolExecutor(4) as pool:
        paths = set(pool.map(build, range(4)))
    assert len(paths) == 1 and spark.read.parquet(paths.pop()).count() == 10
    first = build()
    assert build() == first
    spark.range(12).write.mode("overwrite").parquet(f"{src}/t.parquet")
    assert build() != first and spark.read.parquet(build()).count() == 12


def test_hot_child_key_is_one_row_at_the_join(spark):
    child = spark.range(3000).selectExpr("CASE WHEN id % 3 < 2 THEN 1 ELSE id END AS k")
    plan = K.fk_orphans(K.key_paths(child, {"c": "k"}), K.key_paths(child, {"c": "k"}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [path", plan.index("Join"))


def test_fk_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k bigint")
    r = K.fk_orphans(K.key_paths(child, {"c.k": "k"}), K.key_paths(parent, {"c.k": "k"})).collect()[0]
    assert (r.child_rows, r.null_key_rows, r.orphan_rows, r.orphan_keys) == (5, 1, 1, 1)
    d = K.pk_duplicates(parent, ["k"]).collect()
    assert [(x.k, x.copies) for x in d] == [(2, 2)]


def test_cast_loss_audit(spark):
    df = spark.createDataFrame([("12", 1.25), ("x", 1000.5), (None, 3.0)], "s string, v double")
    out = {(r.column_name, r.target_type): r for r in
           K.cast_loss_audit(df, [("s", "bigint"), ("v", "decimal(4,1)")]).collect()}
    s = out[("s", "bigint")]
    assert (s.row_count, s.null_count, s.failed_casts) == (3, 1, 1)
    v = out[("v", "decimal(4,1)")]
    assert (v.failed_casts, v.scale_losses) == (1, 1)   # 1000.5 overflows; 1.25 rounds
    df = spark.createDataFrame([(1.7, 2**40), (2.0, 5), (1e30, 6)], "v double, n bigint")
    out = {(r.column_name, r.target_type): (r.failed_casts, r.scale_losses) for r in K.cast_loss_audit(
        df, [("v", "bigint"), ("v", "decimal(38,0)"), ("n", "double"), ("n", "int")]).collect()}
    # 1.7 is cut or rounded; 1e30 does not fit a bigint but does fit the decimal
    assert out == {("v", "bigint"): (1, 1), ("v", "decimal(38,0)"): (0, 1), ("n", "double"): (0, 0), ("n", "int"): (1, 0)}


def test_weekly_refresh_recomputes_touched_weeks(spark):
    from switchboard.functions import decode as X
    schema = ("agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, "
              "first_state_ts timestamp, last_state_ts timestamp, event_date date")
    days = [dt.date(2026, 1, d) for d in (1, 2, 5, 6, 12)]        # weeks of 12-29, 01-05, 01-12
    rows = [(a, "TALK", 10 * a + i, 1 + a, None, None, d) for i, d in enumerate(days) for a in (1, 2)]
    fact = spark.createDataFrame(rows, schema)
    dim = spark.createDataFrame([(1, "S1"), (2, "S2")], "agent_sk bigint, site_code string")
    fact_path, agg_path = fresh_path(spark, "wf"), fresh_path(spark, "wa")
    base = fact.filter(F.col("event_date") < days[3])
    L.write_layout(base, fact_path, "event_date", ["agent_sk"])
    L.full_refresh(A.agg_agent_weekly(spark.read.parquet(fact_path), dim), agg_path, "week_start_date", ["agent_sk"])
    delta = fact.filter(F.col("event_date") >= days[3])            # day 6 joins the week of 01-05
    touched = L.refresh_aggregate(spark, fact_path, agg_path, delta, "event_date",
                                  lambda f: A.agg_agent_weekly(f, dim), ["agent_sk"], ["agent_sk"],
                                  agg_partition="week_start_date", agg_partition_of=X.iso_week_start)
    assert touched == [dt.date(2026, 1, 5), dt.date(2026, 1, 12)]
    cols = ["agent_sk", "week_start_date", "days_worked", "interactions_handled", "avg_handle_seconds"]
    got = sorted(map(tuple, spark.read.parquet(agg_path).select(*cols).collect()))
    want = sorted(map(tuple, A.agg_agent_weekly(fact, dim).select(*cols).collect()))
    assert got == want


def test_warehouse_table_written_once(spark):
    """A partitioned warehouse table is committed with its marker and reused, not rewritten."""
    from switchboard.plans import warehouse as W
    sf = "/root/testdata/sf0.001"
    p1 = W.wh_path(spark, sf, "fact_interaction")
    assert L.table_ready(spark, p1)
    stamp = os.path.getmtime(os.path.join(p1.replace("file:", ""), "_SUCCESS"))
    assert W.wh_path(spark, sf, "fact_interaction") == p1
    assert os.path.getmtime(os.path.join(p1.replace("file:", ""), "_SUCCESS")) == stamp


def test_rows_of_a_dear_plan_are_computed_once(spark):
    """The ranges are found and dealt from one shuffle: without ``once`` the rows are computed for each."""
    made = {}
    for once in (False, True):
        seen = spark.sparkContext.accumulator(0)
        rdd = spark.sparkContext.parallelize(range(200), 4).map(lambda i, seen=seen: (seen.add(1), (i % 7, i if i % 50 else None))[1])
        df = spark.createDataFrame(rdd, "d int, k bigint")
        path = fresh_path(spark, "once")
        L.write_layout(df, path, "d", ["k"], once=once)
        assert sorted(spark.read.parquet(path).select("d", "k").na.fill(-1).collect()) == sorted(df.na.fill(-1).collect())
        made[once] = seen.value - 200                 # less the rows computed for the comparison
    assert made == {False: 400, True: 200}


def test_stored_tables_are_written_several_at_a_time(spark, monkeypatch):
    """fk_orphans has its ten stored tables written side by side, each once."""
    import threading

    from switchboard.plans import q_joins as Q
    from switchboard.plans import warehouse as W
    together, asked = threading.Barrier(2), []

    def build(name):
        def rows(session, sf):
            asked.append(name)
            together.wait(timeout=60)             # breaks if one build waits for the other's end
            return session.createDataFrame([(1, 2)], "k bigint, v bigint")
        return rows

    monkeypatch.setattr(W, "SPECS", {n: W.Spec(build(n), ("orders",), None, "day", ("k",)) for n in ("side_a", "side_b")})
    monkeypatch.setattr(W, "_CODE_VERSION", os.urandom(6).hex())
    out = W.wh_all(spark, "/root/testdata/sf0.001", ["side_a", "side_b"])
    assert sorted(asked) == ["side_a", "side_b"] and {n: df.collect() for n, df in out.items()} == {n: [(1, 2)] for n in out}
    monkeypatch.undo()
    taken = []
    monkeypatch.setattr(W, "wh_all", lambda s, sf, names, real=W.wh_all: (taken.extend(names), real(s, sf, names))[1])
    assert Q.fk_orphans(spark, "/root/testdata/sf0.001").count() == 16 and taken == [t for t in Q.KEY_PATHS if t in W.SPECS]


def test_scale_settings_bounds():
    from switchboard.session import scale_settings
    big = scale_settings(100 * 1024 ** 4, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"            # capped
    assert big["spark.sql.sources.parallelPartitionDiscovery.parallelism"] == "10000"
    small = scale_settings(1024 ** 3, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"              # at least 3 waves of cores
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)


def test_implied_year_filter_keeps_partial_year(spark):
    """eff_from_ts >= mid-year keeps that year's partition (the row filter then trims it)."""
    ts = [dt.datetime(1997, 12, 31, 23, 59), dt.datetime(1998, 3, 1), dt.datetime(1998, 9, 1),
          dt.datetime(1999, 1, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id bigint, eff_from_ts timestamp")
    path = fresh_path(spark, "year")
    L.write_layout(df, path, "eff_from_ts", ["id"], grain="year")
    bound = dt.datetime(1998, 6, 1)
    q = spark.read.parquet(path).filter(
        (F.col("eff_from_ts") >= F.lit(bound)) & L.implied_partition_filter("eff_from_ts", "year", ">=", bound))
    assert sorted(r.id for r in q.collect()) == [2, 3]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "eff_from_ts_year" in plan.split("PartitionFilters:")[-1].split("]")[0]


def test_retention_keeps_null_partition(spark):
    as_of = dt.date(2026, 4, 1)
    df = spark.createDataFrame([(1, as_of - dt.timedelta(days=200)), (2, None), (3, as_of)],
                               "id bigint, load_date date")
    path = fresh_path(spark, "ret_null")
    L.write_layout(df, path, "load_date", ["id"])
    assert L.drop_expired_partitions(spark, path, "load_date", as_of, 90) == [(as_of - dt.timedelta(days=200)).isoformat()]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_zone_checks_turn_false_on_an_unclustered_copy(spark):
    """Sorted files do not overlap, also where a hot key fills several of them; shuffled files do."""
    rows = spark.range(6000).select(F.expr("CASE WHEN id % 3 = 0 THEN 50 WHEN id % 100 = 1 THEN NULL ELSE id % 1000 END").alias("k"),
                                    F.col("id").alias("v"), F.expr("CASE WHEN id % 2 = 0 THEN 'a' END").alias("p"))
    found = {}
    for name, df in (("sorted", rows.repartitionByRange(6, "p", "k", "v")), ("shuffled", rows.repartition(6, "v"))):
        path = fresh_path(spark, "zones")
        df.write.partitionBy("p").parquet(path)
        stored = spark.read.parquet(path)
        zones = K.zone_map(stored, "k", "p").cache()
        files = [(r.zone_partition, r.min_key, r.max_key, r.row_count) for r in zones.collect()]
        for part, depth in ((r.zone_partition, r.depth) for r in K.overlap_depth(zones).collect()):
            wide = [(lo, hi) for p, lo, hi, _ in files if p == part and lo is not None and lo < hi]
            keys = sorted({x for lo, hi in wide for x in (lo, hi)})
            assert depth == max([sum(lo <= a and b <= hi for lo, hi in wide) for a, b in zip(keys, keys[1:])] or [0])
        found[name] = K.clustering_check(zones).first()
        read = K.files_to_read(zones, 900, 910).first()
        assert read.files == len(files) and read.files_read == sum(lo is not None and hi >= 900 and lo <= 910 for _, lo, hi, _ in files)
        assert zones.agg(F.sum("row_count"), F.sum("null_keys")).first() == (6000, rows.where("k IS NULL").count())
    assert found["sorted"].clustered and not found["shuffled"].clustered and found["shuffled"].max_depth > 1
    assert K.clustering_check(zones.limit(0)).first().clustered


def test_qa_totals_forms_agree_on_null_points(spark):
    from switchboard.operators import sessions as S
    forms = spark.createDataFrame(
        [(1, [("a", 10, 5), ("b", 5, None)]), (2, [("a", None, None)]), (3, [("a", 4, 4), ("b", 6, 3)])],
        "qa_form_id bigint, sections array<struct<section_code:string,max_points:bigint,scored_points:bigint>>")
    rows = forms.select("qa_form_id", F.inline("sections"))
    as_rows = sorted(map(tuple, S.qa_totals_rows(rows).collect()))
    assert sorted(map(tuple, S.qa_totals(forms).collect())) == as_rows
    absent = forms.limit(1).select(F.lit(4).alias("qa_form_id"), F.lit(None).cast(forms.schema["sections"].dataType).alias("sections"))
    assert tuple(S.qa_totals(absent).first()) == (4, 0, None, None, None)
