"""Stored results maintained by deltas equal their rebuild; untouched partitions keep their files."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from switchboard.operators import aggregates as A
from switchboard.operators import history as H
from switchboard.operators import incremental as I
from switchboard.operators import layout as L
from switchboard.session import fresh_path

CHANGES = "k bigint, status string, grade string, at timestamp, seq bigint"
BY = ("k", "at", ["status", "grade"], "seq")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(path):
    root = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root)
            for f in names if f.endswith(".parquet")}


def _changes(rnd, n, first=0, years=range(2015, 2025)):
    """A hot key and NULL keys hold a third of the rows each; many changes confirm what was known."""
    out = []
    for i in range(first, first + n):
        at = dt.datetime(rnd.choice(years), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 2))
        out.append(((0, None, rnd.randint(1, 9))[i % 3], rnd.choice(["A", "B", None]), rnd.choice("xy"), at, i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_merges_equal_the_rebuild(spark, seed):
    rnd = random.Random(seed)
    rows = _changes(rnd, 400)
    rnd.shuffle(rows)  # late changes in every step
    steps = [rows[:200], rows[200:203], rows[203:330], rows[330:]]
    # restated: the identity of stored changes with other attributes
    steps.append([(k, "C", g, at, seq) for k, s, g, at, seq in rnd.sample(rows, 5)])
    path, now = fresh_path(spark, "scd2"), {}
    for n, step in enumerate(steps):
        frame = spark.createDataFrame(step, CHANGES)
        I.build_scd2(spark, path, frame, *BY) if not n else I.merge_scd2(spark, path, frame, *BY)
        now.update({(k, at, seq): (k, s, g, at, seq) for k, s, g, at, seq in step})
        every = spark.createDataFrame(list(now.values()), CHANGES)
        want = H.scd2_history(every, "k", "at", ["status", "grade"], "seq")
        got = I.read_scd2(spark, path, every, "k", "seq")
        assert _rows(got.select(want.columns)) == _rows(want)


def test_scd2_merge_rewrites_touched_years_only(spark):
    t = [dt.datetime(y, 6, 1) for y in range(2018, 2025)]
    rows = [(k, "AB"[i % 2], "x", at, 10 * k + i) for k in (1, 2) for i, at in enumerate(t)]
    path = fresh_path(spark, "scd2")
    I.build_scd2(spark, path, spark.createDataFrame(rows, CHANGES), *BY)
    before = _files(path)
    # closes the row of 2020 earlier and stands between it and that of 2021
    late = spark.createDataFrame([(1, "C", "x", dt.datetime(2020, 9, 1), 99)], CHANGES)
    assert I.merge_scd2(spark, path, late, *BY) == ["2020"]
    after = _files(path)
    assert {f for f in before if "2020" not in f} <= set(after) and all(after[f] == before[f] for f in before if "2020" not in f)
    assert not any(f in after for f in before if "eff_from_ts_year=2020" in f)
    # a confirmation changes no validity row, but is stored; the same delta again changes nothing
    again = spark.createDataFrame([(2, "A", "x", dt.datetime(2018, 7, 1), 98)], CHANGES)
    assert I.merge_scd2(spark, path, again, *BY) == ["2018"]
    before = _files(path)
    assert I.merge_scd2(spark, path, again, *BY) == [] and _files(path) == before
    # a change in front of the confirmation makes it a row of its own
    I.merge_scd2(spark, path, spark.createDataFrame([(2, "B", "x", dt.datetime(2018, 6, 15), 97)], CHANGES), *BY)
    got = I.read_scd2(spark, path, late, "k", "seq").where("k = 2 AND year(eff_from_ts) = 2018").orderBy("eff_from_ts").collect()
    assert [(r.status, r.eff_from_ts.month, r.eff_to_ts.month) for r in got] == [("A", 6, 6), ("B", 6, 7), ("A", 7, 6)]


STATE = "g bigint, v bigint, day date"


def _groups():
    return {"g": F.col("g"), "day": F.col("day")}


def _view(state):
    return state.select("g", "day", "n_rows", I.summed("v").alias("v"), F.col("v_n").alias("n"))


@pytest.mark.parametrize("seed", [3, 4])
def test_signed_deltas_equal_the_rebuild(spark, seed):
    rnd = random.Random(seed)
    days = [dt.date(2024, 1, d) for d in range(1, 6)] + [None]

    def row():
        return rnd.choice([1, 2, None]), rnd.choice([None, 0, 5, -5, 7]), rnd.choice(days)

    now = [row() for _ in range(60)]
    path = fresh_path(spark, "signed")
    first = I.signed_state(spark.createDataFrame(now, STATE), _groups(), ["v"])
    L.write_layout(first, path, "day", ["g"])
    for step in range(4):
        gone = rnd.sample(now, 12)
        if step == 1:
            gone = [r for r in now if r[2] == days[2]]  # a day becomes empty
        new = [] if step == 3 else [row() for _ in range(10)]
        new = [r for r in new if step != 1 or r[2] != days[2]]
        touched = I.apply_signed(spark, path, spark.createDataFrame(gone, STATE), spark.createDataFrame(new, STATE),
                                 _groups(), ["v"], "day", ["g"])
        now = list((Counter(now) - Counter(gone)).elements()) + new
        assert set(touched) <= {str(r[2]) if r[2] else None for r in gone + new}
        want = spark.createDataFrame(now, STATE).groupBy("g", "day").agg(
            F.count("*").alias("n_rows"), F.sum("v").alias("v"), F.count("v").alias("n"))
        assert _rows(_view(spark.read.schema(first.schema).parquet(path))) == _rows(want)
        if step == 1:
            assert str(days[2]) not in L.partition_values(spark, path, "day")


def test_signed_delta_touches_its_days_only_and_knows_its_rows(spark):
    rows = [(1, 5, dt.date(2024, 1, d)) for d in (1, 2, 3)]
    path = fresh_path(spark, "signed")
    L.write_layout(I.signed_state(spark.createDataFrame(rows, STATE), _groups(), ["v"]), path, "day", ["g"])
    before = _files(path)
    one, none = spark.createDataFrame([(1, 5, dt.date(2024, 1, 2))], STATE), spark.createDataFrame([], STATE)
    assert I.apply_signed(spark, path, one, one, _groups(), ["v"], "day", ["g"]) == []  # the images cancel out
    assert I.apply_signed(spark, path, none, one, _groups(), ["v"], "day", ["g"]) == ["2024-01-02"]
    after = _files(path)
    assert all(after.get(f) == before[f] for f in before if "2024-01-02" not in f)
    with pytest.raises(Exception, match="before image"):
        I.apply_signed(spark, path, spark.createDataFrame([(7, 5, dt.date(2024, 1, 1))], STATE), none, _groups(), ["v"], "day", ["g"])


FACT = "agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, event_date date"


def test_merged_distinct_state_equals_the_recomputed_one(spark):
    rnd = random.Random(5)
    # one day per agent and state, as the fact has them; ids far apart, negative ones too
    ids = [-70_000, -1, 0, 1, 32_768, 32_769, 10**12] + list(range(100, 400))
    rows = [(a, s, rnd.choice([None, 10, 25]), 1, dt.date(2024, 1, d)) for a in ids for s in ("TALK", "ACW") for d in (1, 2, 3)
            if rnd.random() < 0.7]
    fact = spark.createDataFrame(rows, FACT)
    dim = spark.createDataFrame([(a, (None, "S1", "S2")[a % 3]) for a in ids], "agent_sk bigint, site_code string")
    paths = [fresh_path(spark, "sums"), fresh_path(spark, "ids")]
    part = F.pmod("agent_sk", F.lit(4))
    states = I.site_day_states(fact.where(part == 0), dim)
    for p, s in zip(paths, states):
        L.write_layout(s, p, "event_date", ["site_code"])
    for k in (1, 2, 3):
        I.refresh_site_daily(spark, *paths, fact.where(part == k), dim)
    sums, found = (spark.read.schema(s.schema).parquet(p) for p, s in zip(paths, states))
    want = A.agg_site_daily(fact, dim)
    assert _rows(I.site_daily_view(sums, found)) == _rows(want)
    exact = {(r.site_code, r.event_date): r.agents_active for r in want.collect()}
    for r in I.site_daily_view(sums, found, estimate=True).collect():
        assert abs(r.agents_active - exact[r.site_code, r.event_date]) <= 0.05 * exact[r.site_code, r.event_date] + 1
    # a restated day drops its old state
    day = fact.where((F.col("event_date") == dt.date(2024, 1, 2)) & (part < 2))
    assert I.refresh_site_daily(spark, *paths, day, dim, restated=True) == ["2024-01-02"]
    whole = fact.where(F.col("event_date") != dt.date(2024, 1, 2)).unionByName(day)
    sums, found = (spark.read.schema(s.schema).parquet(p) for p, s in zip(paths, states))
    assert _rows(I.site_daily_view(sums, found)) == _rows(A.agg_site_daily(whole, dim))
