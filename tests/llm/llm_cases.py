"""Shared fixture and tables of the corpus operators' tests."""

import random

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside; as extra columns of the input they must not clash.
CLASHING = ["key", "digest", "node", "sig", "bands", "form", "tokens", "window", "number", "position", "kept", "component_id",
            "n_words", "features", "anomaly", "slot", "shard", "payload", "base", "spans", "cluster", "bucket", "n",
            "_sp", "_line", "_line_id", "_line_key", "_n_id", "_n_key", "_l_id", "_l_key", "_q_id", "_q_key", "id", "lost", "lost_id",
            "lost_key", "found", "bits", "touched", "fingerprint", "tree", "leaf", "part", "value"]


@pytest.fixture
def corpus(spark):
    from switchboard.llm.common import ship_package
    ship_package(spark)
    return spark


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))


def docs(spark, rows, clashing=False):
    """(doc_id, text) rows, or longer ones, as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    schema = DOCS
    if clashing:
        full = [r + tuple("x" for _ in CLASHING) for r in full]
        schema += "".join(f", {c} string" for c in CLASHING)
    return spark.createDataFrame(full, schema)


def edge_rows():
    same = words(60, 1)
    return [(1, None), (2, ""), (3, " \t\n \x0b"), (4, "few words"), (None, words(30, 2)), (None, None), (5, words(60_000, 3)),
            (6, same), (7, same), (7, same), (8, same.upper()), (9, "\n".join([words(12, 4)] * 3)), (10, "é" * 70_000),
            (11, "ﬀ 日本語 \U0001f600 \x00 \x85   text"), (-12, words(20, 5))]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
