"""Refresh-on-arrival: two landed batches give the same aggregate as a full rebuild."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import aggregates as A
from switchboard.session import fresh_path
from switchboard.streaming.refresh import land, start_refresh

SCHEMA = ("agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, "
          "first_state_ts timestamp, last_state_ts timestamp, event_date date")


def test_stream_refresh_matches_full(spark):
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    rows = [(a, s, 10 * a + i, 1 + i, None, None, d)
            for i, d in enumerate(days) for a in (1, 2, 3) for s in ("TALK", "AUX1")]
    fact = spark.createDataFrame(rows, SCHEMA)
    dim = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, "S2")], "agent_sk bigint, site_code string")
    landing, fact_path, agg_path = fresh_path(spark, "landing"), fresh_path(spark, "fact"), fresh_path(spark, "agg")

    def run():
        q = start_refresh(spark, landing, fact.schema, fact_path, agg_path, lambda f: A.agg_agent_daily(f, dim),
                          "event_date", ["agent_sk"], ["agent_sk"], name=f"t{id(landing) % 1000}",
                          checkpoint=landing + "_ckpt")
        q.awaitTermination(120)

    land(fact.filter(F.col("event_date") < days[2]), landing, 0)
    run()
    # a restatement of day 2 and a new day 3
    land(fact.filter(F.col("event_date") >= days[1]), landing, 1)
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(agg_path)
                 .select("agent_sk", "site_code", "interactions_handled", "avg_handle_seconds", "event_date").collect())
    want = sorted(tuple(r) for r in A.agg_agent_daily(fact, dim)
                  .select("agent_sk", "site_code", "interactions_handled", "avg_handle_seconds", "event_date").collect())
    assert got == want


def test_two_restatements_and_many_files_in_one_batch(spark):
    day = dt.date(2026, 1, 1)
    schema = "k bigint, v bigint, d date"
    landing, fact_path, agg_path = (fresh_path(spark, n) for n in ("landing", "fact", "agg"))
    land(spark.createDataFrame([(1, 10, day), (9, 1, None)], schema), landing, 0)
    # one day in four files, seen together with what it restates
    land(spark.createDataFrame([(i, 1, day) for i in range(4)], schema).repartition(4), landing, 1)
    land(spark.createDataFrame([(9, 5, None)], schema), landing, 2)
    q = start_refresh(spark, landing, T.StructType.fromDDL(schema), fact_path, agg_path,
                      lambda f: f.groupBy("d").agg(F.sum("v").alias("total"), F.count("*").alias("n")).select("total", "n", "d"),
                      "d", ["k"], [], name="two_in_one", checkpoint=landing + "_ckpt")
    q.awaitTermination(120)
    got = spark.read.schema("total bigint, n bigint, d date").parquet(agg_path).collect()
    assert sorted(((r.d, r.total, r.n) for r in got), key=repr) == sorted([(day, 4, 4), (None, 5, 1)], key=repr)
