"""Registered queries against DuckDB, and the pipeline against its stages by brute force, on the sf0.001 tables."""

import duckdb
import pytest
from llm_cases import SMALL, corpus, docs, edge_rows  # noqa: F401

import __spark_entry__ as E
import corpus_pipeline
from switchboard.llm.queries import ORACLE, QUERIES


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(corpus, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    frame = QUERIES[name](corpus, SMALL)
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(repr, map(tuple, frame.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_pipeline_stages_against_brute_force(corpus):
    import public_tokenizers
    import sentencepiece
    from test_line_dedup import key
    from test_near_dup import brute as components
    from test_quality import brute as base

    from switchboard.llm import decontaminate, quality
    now = corpus.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    columns = now.columns

    kept = steps["quality_rules"](corpus, now, SMALL)
    judged = quality.judge(now, corpus.read.parquet(f"{SMALL}/labels.parquet")).where("kept").collect()
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged)
    assert not any(base(r.text)[-1] for r in kept.collect())

    before = [(r.doc_id, r.text) for r in kept.collect()]
    holders = {}
    for d, t in before:
        for k in {key(x) for x in t.split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(d)
    want = {d: "\n".join(x for x in t.split("\n") if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == d) for d, t in before}
    now = steps["line_dedup"](corpus, kept, SMALL)
    got = now.collect()
    assert now.columns == columns and {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)

    want = {d for d, _, c in components(sorted(want.items()), 80) if d == c or c is None or not want[d].split()}
    now = steps["near_dedup"](corpus, now, SMALL)
    assert now.columns == columns and {r.doc_id for r in now.collect()} == want

    leaks = {r.doc_id for r in decontaminate.leaks(now, corpus.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    after = steps["decontamination"](corpus, now, SMALL)
    assert after.columns == columns and {r.doc_id for r in after.collect()} == want - leaks

    texts = {r.doc_id: r.text for r in after.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = steps["sentencepiece"](corpus, after, SMALL).collect()
    assert {r.doc_id: list(r.ids) for r in last} == {d: library.encode(t) for d, t in texts.items()}

    whole = corpus_pipeline.run(corpus, SMALL).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, last))


def test_stages_take_edge_cases(corpus):
    now = docs(corpus, edge_rows(), clashing=True)
    columns = now.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(corpus, now, SMALL)
        assert now.columns == columns
    assert corpus_pipeline.STAGES[-1][1](corpus, now, SMALL).count() == now.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(corpus, docs(corpus, []), SMALL).count() == 0
