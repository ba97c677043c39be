from hashlib import sha256

import numpy as np
from llm_cases import corpus, docs, edge_rows, words  # noqa: F401

from switchboard.llm import line_dedup as L


def key(line):
    k = line.strip(" \t\n\r\x0b\x0c")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)


def brute(rows):
    holders = {}
    for n, (d, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(d)
    stays = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if len(ds) >= 3}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in stays or stays[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = L.dedup_lines(docs(spark, rows, clashing=True)).collect()
    assert sorted(((r.doc_id, r._line_n, r._line_dropped, sha256(r._line_text.encode()).hexdigest()) for r in got),
                  key=repr) == brute(rows)


def test_edge_cases(corpus):
    check(corpus, edge_rows())


def test_key_rules_and_places(corpus):
    line = "A line of more than TWENTY characters"
    check(corpus, [
        (1, f"{line}\nown one"), (2, f"  \t{line.lower()}\x0b\nx\n{line}"), (3, f"y\n{line.upper()}\r"), (3, line),
        (4, "twenty characters..."), (5, "twenty characters..."), (6, "twenty characters..."),
        (7, "nineteen characters"), (8, "nineteen characters"), (9, "nineteen characters"),
        (10, "é" * 20), (11, "é" * 20), (12, "é" * 20), (13, "é" * 19), (14, "é" * 19), (15, "é" * 19),
        (16, "É" * 20), (17, "É" * 20), (18, " " + "É" * 20),
        (None, words(9, 3)), (None, words(9, 3)), (None, words(9, 3)), (20, "two only, in two documents"),
        (21, "two only, in two documents\ntwo only, in two documents"), (22, "\n\n"), (23, "")])


def test_many_lines_and_a_line_in_a_third_of_all_documents(corpus):
    rows = [(i, "\n".join([words(6, i * 7 + j) for j in range(5)] + (["the very same line, again and again"] if i % 3 == 0 else [])
                          + [f"shared by a few documents {i // 4}"])) for i in range(400)]
    check(corpus, rows)


def test_empty_table(corpus):
    assert L.dedup_lines(docs(corpus, [])).collect() == []


def test_full_filters_change_no_result(corpus, monkeypatch):
    # a filter far too small passes every line on to the exact step
    monkeypatch.setattr(L, "MIN_FILTER_BITS", 64)
    monkeypatch.setattr(L, "BITS_PER_ROW", 1)
    check(corpus, [(i, f"{words(8, i)}\n{words(8, i // 3)}") for i in range(200)])


def test_filters_fold_in_any_grouping():
    rng = np.random.default_rng(1)
    bits = 1 << 20
    sets = [rng.integers(0, 2**64, n, dtype=np.uint64) for n in (50, 3000, 300_000)]
    sets[2][:10] = sets[0][:10]
    sets[1][:5] = sets[1][5:10]
    # sparse slices as places, dense ones as bits; a task may send several parts
    parts = [b for s in sets for b in L._partial_slices([s[:20], s[20:]], bits)]
    sizes = {len(x.as_py()) for b in parts for x in b.column("once")}
    assert max(sizes) == L.SLICE_BITS // 8 and min(sizes) < 200
    by_slice = sorted(((r["slice"], b, i) for b in parts for i, r in enumerate(b.select(["slice"]).to_pylist())), key=lambda x: x[0])
    folded = {r["slice"]: L._unpacked(r["twice"]) for out in L._fold(b.slice(i, 1) for _, b, i in by_slice)
              for r in out.to_pylist()}
    whole = np.concatenate([folded.get(k, np.zeros(L.SLICE_BITS // 8, dtype=np.uint8)) for k in range(bits // L.SLICE_BITS)])
    held = L._holds(whole.view(np.uint64), L._positions(np.concatenate([sets[0][:10], sets[1][:5]]), bits))
    assert held.all()
    assert L._holds(whole.view(np.uint64), L._positions(sets[0][10:], bits)).mean() < 0.7
