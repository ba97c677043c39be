"""The ordered passes of scd2_history / asof_join give the same rows whatever the number of
ranges: many ranges force many carries, one range is one window over all rows.
A hot key and NULL keys hold a third of the rows each."""

import datetime as dt
import random

import pytest

from switchboard.operators import history as H


def _events(spark, n=600, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = (0, None, rnd.randint(1, 12))[i % 3]
        ts = t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
        status = rnd.choice(["A", "B", None])
        rows.append((key, status, ts, i))
    return spark.createDataFrame(rows, "k bigint, status string, ts timestamp, seq bigint")


def _hist(df):
    h = H.scd2_history(df, "k", "ts", ["status"], tie_col="seq")
    return h.select("history_id", "k", "status", "eff_from_ts", "eff_to_ts", "is_current")


RANGES = ["1", "3", "64"]


@pytest.fixture(params=RANGES)
def ranged(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _brute(rows):
    """Plain loop over each key's changes."""
    out, by = [], {}
    for k, status, ts, seq in rows:
        by.setdefault(k, []).append((ts, seq, status))
    for k, changes in by.items():
        kept = []
        for ts, seq, status in sorted(changes):
            if not kept or kept[-1][1] != status:
                kept.append((ts, status))
        for i, (ts, status) in enumerate(kept):
            end = kept[i + 1][0] if i + 1 < len(kept) else None
            out.append((k, status, ts, end, end is None))
    return sorted(out, key=repr)


def test_scd2_as_a_plain_loop(ranged):
    df = _events(ranged)
    assert sorted((r[1:] for r in _rows(_hist(df))), key=repr) == _brute(map(tuple, df.collect()))


def test_one_instant_of_one_key_in_many_ranges(ranged):
    t = dt.datetime(2024, 1, 1)
    df = ranged.createDataFrame([(1, "AB"[i // 5 % 2], t, i) for i in range(300)], "k bigint, status string, ts timestamp, seq bigint")
    assert sorted((r[1:] for r in _rows(_hist(df))), key=repr) == _brute(map(tuple, df.collect()))


def test_one_full_shuffle(spark):
    plan = _hist(_events(spark))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    # what is left once the ranges are stored: one row per range
    assert exchanges and all("SinglePartition" in x or "BroadcastExchange" in x for x in exchanges)


def test_null_keys_collapse_across_days_and_ids_are_unique(spark):
    t = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    df = spark.createDataFrame([(None, "A", t, 1), (None, "A", t + day, 2), (5, "A", t, 3), (5, "B", t, 4), (5, "A", t, 5)],
                               "k bigint, status string, ts timestamp, seq bigint")
    got = _hist(df).collect()
    assert [(r.k, r.is_current) for r in got if r.k is None] == [(None, True)]
    assert len({r.history_id for r in got}) == len(got) == 4


def test_asof_as_a_plain_loop(ranged):
    df = _events(ranged)
    hist = _hist(df).drop("history_id")
    rnd = random.Random(3)
    probes = [(rnd.choice([None, *range(14)]), dt.datetime(2023, 12, 31) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 7)))
              for _ in range(400)]
    rows = [tuple(r) for r in hist.select("k", "status", "eff_from_ts", "eff_to_ts").collect()]
    want = []
    for k, at in probes:
        found = [(s, x) for key, x, s, e in rows if k is not None and key == k and s <= at and (e is None or at < e)]
        want.append((k, at, *(found[0] if found else (None, None))))
    got = H.asof_join(ranged.createDataFrame(probes, "k bigint, at timestamp"), hist, "k", "at", ["status"])
    assert _rows(got) == sorted(want, key=repr) and any(r[2] is not None for r in want)
