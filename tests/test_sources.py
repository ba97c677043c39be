"""Landed-file readers: pipe-delimited change feed (PERMISSIVE, corrupt lines kept) and nested JSON."""

from pyspark.sql import types as T

from switchboard.sources.tables import feed_counts, read_nested, read_pipe_feed

FEED = T.StructType([T.StructField("entity_id", T.LongType()), T.StructField("change_id", T.LongType()),
                     T.StructField("op", T.StringType()), T.StructField("change_ms", T.LongType()),
                     T.StructField("status", T.StringType())])


def test_pipe_feed_keeps_corrupt_lines(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    (d / "part-0.csv").write_text("1|10|I|1000|a\nx|11|U|abc|b\n2|20|D|2000|\n")
    rows = sorted(read_pipe_feed(spark, str(d), FEED).collect(), key=lambda r: r.change_id)
    assert (rows[0].entity_id, rows[0].op, rows[0].status, rows[0]._corrupt_record) == (1, "I", "a", None)
    assert rows[1].entity_id is None and rows[1]._corrupt_record == "x|11|U|abc|b"
    assert rows[2].status is None and rows[2]._corrupt_record is None
    (d / "part-1.csv").write_text("3|30||1000|a\n")
    # cached, as Spark asks for when only the corrupt-line column is read
    assert tuple(feed_counts(read_pipe_feed(spark, str(d), FEED).cache()).first()) == (4, 1, 1)


def test_delta_merged_from_a_landed_feed(spark, tmp_path):
    """The change feed written as pipe-delimited lines and read back merges like the frame itself."""
    from switchboard.operators import history as H
    from switchboard.plans import bindings as B
    sf = "/root/testdata/sf0.001"
    delta = B.feed_delta(spark, sf)
    path = str(tmp_path / "delta")
    delta.write.option("sep", "|").csv(path)
    landed = read_pipe_feed(spark, path, delta.schema).drop("_corrupt_record")
    state = H.cdc_state(B.feed_base(spark, sf), ["entity_id"])
    a, b = (H.cdc_merge_into_base(state, d, ["entity_id"]) for d in (landed, delta))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_nested_json_with_declared_schema(spark, tmp_path):
    d = tmp_path / "chats"
    d.mkdir()
    (d / "a.json").write_text('{"chat_ref": "c1", "messages": [{"sender": "user", "ts_ms": 5, "text": "hi"}], '
                              '"extra": 1}\n')
    schema = T.StructType([T.StructField("chat_ref", T.StringType()), T.StructField("messages", T.ArrayType(
        T.StructType([T.StructField("sender", T.StringType()), T.StructField("ts_ms", T.LongType())])))])
    r = read_nested(spark, str(d), schema, fmt="json").collect()[0]
    assert r.chat_ref == "c1" and r.messages[0].ts_ms == 5 and "extra" not in r.asDict()


def test_shared_dir_is_the_configured_checkpoint_dir(spark):
    from switchboard.session import fresh_path, shared_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = shared_dir(spark)
    if configured:
        assert d == configured.rstrip("/")
    assert fresh_path(spark, "x").startswith(d + "/tables/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_shared_dir_is_required_on_a_cluster():
    import pytest

    from switchboard.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
