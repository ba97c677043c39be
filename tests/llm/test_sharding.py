import zlib

from llm_cases import corpus, docs, edge_rows, words  # noqa: F401
from pyspark.sql import functions as F

from switchboard.llm import sharding as S


def test_walks_permute_every_size(corpus):
    for n in (1, 2, 3, 5, 7, 10, 17, 31, 100, 257, 1000):
        for seed in (1, 7):
            places = [r[0] for r in corpus.range(n).select(S.permuted(F.col("id"), n, seed)).collect()]
            assert sorted(places) == list(range(n))
    assert places != list(range(n))


def test_large_numbers_stay_in_range_and_apart(corpus):
    n = 10**12 + 39
    frame = corpus.range(10**12 - 20_000, n).select(S.permuted(F.col("id"), n, 3).alias("p"))
    r = frame.agg(F.min("p"), F.max("p"), F.countDistinct("p"), F.avg("p")).first()
    assert 0 <= r[0] and r[1] < n and r[2] == 20_039 and abs(r[3] / n - 0.5) < 0.02


def check(rows, got, shards):
    want = sorted((d is not None, d if d is not None else 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    by = {}
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_edge_cases(corpus):
    rows = edge_rows()
    check(rows, [r.asDict() for r in S.shard_rows(docs(corpus, rows, clashing=True)).collect()], 24)
    assert S.shard_rows(docs(corpus, [])).collect() == []


def test_equal_rows_and_null_ids_and_reproducibility(corpus):
    rows = [(None, "same")] * 150 + [(7, "same")] * 150 + [(i, words(4, i)) for i in range(300)]
    frame = docs(corpus, rows)
    got = [r.asDict() for r in S.shard_rows(frame, shards=7).collect()]
    check(rows, got, 7)
    again = [r.asDict() for r in S.shard_rows(frame.repartition(5), shards=7).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = [r.asDict() for r in S.shard_rows(frame, shards=7, seed=2).collect()]
    assert sorted(map(repr, got)) != sorted(map(repr, other))


def test_shard_and_slot_follow_from_the_row_number(corpus):
    rows = [(i * 3, words(3, i)) for i in range(200)]
    place = [r[0] for r in corpus.range(200).select(S.permuted(F.col("id"), 200, 20240607)).collect()]
    got = {r.doc_id: (r.shard, r.slot) for r in S.shard_rows(docs(corpus, rows)).collect()}
    assert got == {i * 3: (place[i] % 24, place[i] // 24) for i in range(200)}
