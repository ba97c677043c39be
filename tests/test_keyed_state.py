"""States by key bucket, the key registry and org paths of any depth against plain Python and the whole-table operators."""

import os
import random

import pytest
from pyspark.sql import functions as F

from switchboard.operators import dimensions as D
from switchboard.operators import history as H
from switchboard.operators import key_registry as R
from switchboard.operators import keyed_state as K
from switchboard.session import fresh_path

FEED = "k bigint, change_ms bigint, change_id bigint, op string, v string"
ROWS = "k bigint, v string, seq bigint"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(path):
    root = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root)
            for f in names if f.endswith(".parquet")}


def _changes(rnd, n, first):
    """A third of the changes at one key, some at a NULL key; deletes, NULL ops and late changes."""
    return [((7, None, rnd.randint(100, 140))[0 if i % 3 == 0 else 1 if i % 10 == 1 else 2], rnd.randint(0, 50), i,
             rnd.choice(["I", "U", "D", None]), f"v{i}") for i in range(first, first + n)]


@pytest.mark.parametrize("seed", [3, 4])
def test_change_feed_by_bucket_equals_the_whole_feed(spark, seed):
    rnd = random.Random(seed)
    state, everything = K.KeyedState(fresh_path(spark, "state"), ("k",), 8), []
    for n in range(3):
        step = _changes(rnd, 60, 60 * n)
        everything += step
        delta = spark.createDataFrame(step, FEED)
        if n:
            K.merge_changes(spark, state, delta)
        else:
            like = H.cdc_state(delta, ["k"])
            K.store(state, like)
    want = H.cdc_state(spark.createDataFrame(everything, FEED), ["k"])
    assert _rows(K.read(spark, state, like)) == _rows(want.select(like.columns))


def test_only_touched_buckets_are_rewritten(spark):
    state = K.KeyedState(fresh_path(spark, "state"), ("k",), 16)
    base = spark.createDataFrame([(k, f"old{k}", 0) for k in range(200)], ROWS)
    K.store(state, base)
    before = _files(state.path)
    delta = spark.createDataFrame([(5, "new5", 1), (5, "newer5", 2), (900, "new900", 1)], ROWS)
    touched = K.merge_upsert(spark, state, delta, ["seq"])
    assert touched == sorted({str(r[0]) for r in state.with_bucket(delta).select(state.column).collect()}) and len(touched) < 3
    after = _files(state.path)
    other = {f for f in before if not any(f"{state.column}={b}/" in f for b in touched)}
    assert other and all(after[f] == before[f] for f in other)
    assert not (set(before) - other) & set(after)
    got = {k: v for k, v, _ in _rows(K.read(spark, state, base))}
    assert got == {**{k: f"old{k}" for k in range(200)}, 5: "newer5", 900: "new900"}


def test_upsert_by_bucket_equals_the_upsert(spark):
    """Base rows that share a key, NULL keys on both sides, an empty delta."""
    base = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "c", 0), (2, "d", 0), (None, "n", 0)], ROWS)
    delta = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1), (None, "m", 1)], ROWS)
    state = K.KeyedState(fresh_path(spark, "state"), ("k",), 4)
    K.store(state, base)
    assert K.merge_upsert(spark, state, delta.limit(0)) == []
    K.merge_upsert(spark, state, delta, ["seq"])
    assert _rows(K.read(spark, state, base)) == _rows(H.upsert(base, delta, ["k"], ["seq"]))


def test_look_up_reads_one_bucket(spark):
    state = K.KeyedState(fresh_path(spark, "state"), ("k",), 16)
    base = spark.createDataFrame([(k, f"v{k}", 0) for k in range(100)] + [(None, "none", 0)], ROWS)
    K.store(state, base)
    found = K.look_up(spark, state, base, {"k": 42})
    assert _rows(found) == [(42, "v42", 0)] and _rows(K.look_up(spark, state, base, {"k": None})) == [(None, "none", 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert state.column in plan.split("PartitionFilters:")[1].split("]")[0]
    assert len(found.inputFiles()) and len({os.path.dirname(f) for f in found.inputFiles()}) <= 16


def test_bucket_count_follows_the_size():
    assert [K.buckets_for(n * K.BUCKET_BYTES) for n in (0, 16, 17, 10**9)] == [16, 16, 32, K.MAX_BUCKETS]


# ---------------------------------------------------------------- C19
def _registry(spark, path, like, natural):
    return {tuple(r[:-2]): (r[-2], r[-1]) for r in R.read(spark, path, like, natural, "sk").collect()}


def test_registry_numbers_unseen_keys_once(spark):
    rnd = random.Random(5)
    schema = "a bigint, b string"
    path = fresh_path(spark, "keys")
    R.create(spark, path, spark.createDataFrame([], schema), ["a", "b"], "sk")
    want = {}
    for n in range(3):
        rows = [(rnd.randint(0, 30), rnd.choice("xyz")) for _ in range(120)] + [(1, "x")] * 60 + [(None, "x"), (2, None)]
        rnd.shuffle(rows)
        for key in sorted({r for r in rows if None not in r} - set(want)):
            want[key] = (len(want) + 1, n == 1)
        frame = spark.createDataFrame(rows, schema)
        R.add_keys(spark, path, frame, ["a", "b"], "sk", late=n == 1)
        before = _files(path)
        R.add_keys(spark, path, frame, ["a", "b"], "sk")  # a rerun gives no key a second number
        assert _registry(spark, path, frame, ["a", "b"]) == want
        assert all(_files(path)[f] == t for f, t in before.items())


def test_placeholders_until_the_dimension_row_comes(spark):
    path, dim = fresh_path(spark, "keys"), "id bigint, name string"
    first = spark.createDataFrame([(10, "ten")], dim)
    fact = spark.createDataFrame([(10, 1.0), (20, 2.0), (None, 3.0)], "client bigint, x double")
    R.create(spark, path, first, ["id"], "sk")
    R.add_keys(spark, path, first, ["id"], "sk")
    R.add_keys(spark, path, fact.select(F.col("client").alias("id")), ["id"], "sk", late=True)
    registry = R.read(spark, path, first, ["id"], "sk")
    assert _rows(R.with_keys(fact, registry, ["id"], "sk", ["client"]).select("client", "sk")) == [(10, 1), (20, 2), (None, R.NO_KEY)]
    assert _rows(R.dimension_rows(registry, first, ["id"], "sk", {"name": "?"})) == [(1, 10, "ten", False), (2, 20, "?", True)]
    second = spark.createDataFrame([(10, None), (20, "twenty"), (5, "five")], dim)
    R.add_keys(spark, path, second, ["id"], "sk")
    registry = R.read(spark, path, first, ["id"], "sk")
    assert _rows(R.dimension_rows(registry, second, ["id"], "sk", {"name": "?"})) == [
        (1, 10, None, False), (2, 20, "twenty", False), (3, 5, "five", False)]


# ---------------------------------------------------------------- C20
UNITS = "org_unit_id bigint, parent_unit_id bigint, unit_code string, unit_name string, unit_type string"


def _units(spark, links):
    return spark.createDataFrame([(u, p, f"c{u}", f"n{u}", "T") for u, p in links], UNITS)


def test_seven_levels_start_at_the_root(spark):
    units = _units(spark, [(1, None)] + [(u, u - 1) for u in range(2, 8)])
    got = {r.org_unit_id: (r.level1_name, r.level4_name) for r in D.flatten_org(units).collect()}
    assert got == {u: ("n1", "n4" if u >= 4 else None) for u in range(1, 8)}
    paths = {r.org_unit_id: r.path for r in D.org_paths(units).collect()}
    assert paths[7] == [f"n{u}" for u in range(1, 8)]


@pytest.mark.parametrize("seed", [6, 7])
def test_paths_equal_walks_up(spark, seed):
    """Deep chains, wide parents, unknown parents, cycles with trees below them, a unit that is its own parent."""
    rnd = random.Random(seed)
    parent = {0: None, 1: 999}
    for u in range(2, 80):
        parent[u] = rnd.choice([u - 1, u - 1, u - 1, rnd.randrange(u)])
    parent.update({100: 102, 101: 100, 102: 101, 103: 100, 104: 103, 105: 105, 106: 105})

    def walk(u):
        path, seen = [], set()
        while u in parent and u not in seen:
            seen.add(u)
            path.insert(0, f"n{u}")
            u = parent[u]
        return None if u in seen else path

    got = {r.org_unit_id: (r.path, r.is_cyclic) for r in D.org_paths(_units(spark, parent.items())).collect()}
    assert got == {u: (walk(u), walk(u) is None) for u in parent}


def test_null_unit_ids_and_no_units(spark):
    units = _units(spark, [(1, None), (None, 1), (None, None)])
    assert sorted((r.level1_name, r.level2_name or "") for r in D.flatten_org(units).collect()) == [
        ("n1", ""), ("n1", "nNone"), ("nNone", "")]
    assert D.flatten_org(units.limit(0)).collect() == []
