import re

from llm_cases import SMALL, corpus, docs, edge_rows, words  # noqa: F401

from switchboard.llm import decontaminate as D

ITEM = ("Tom has 12 red apples and Mary has 7.5 kg of green pears, so Tom asks Mary how many apples they would share "
        "if Mary gave 12 more")


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, key string")


def found(spark, rows, items):
    return {(r.doc_id, r.item_id): r for r in D.leaks(docs(spark, rows, clashing=True), bench(spark, items)).collect()}


def test_reparameterised_questions(corpus):
    other = ITEM.replace("Tom", "Ann").replace("Mary", "Bob").replace("12", "35").replace("7.5", "1,200")
    torn = other.replace("35 more", "36 more")         # 12 would stand for 35 and for 36
    got = found(corpus, [
        (1, f"{words(30, 1)} {ITEM} {words(30, 2)}"), (2, f"{words(30, 1)}. {other} {words(30, 2)}"),
        (3, f"{words(30, 1)}. {torn} {words(30, 2)}"), (4, words(90, 3)), (5, f"{words(9, 1)}\n{ITEM.upper()}\n{words(9, 2)}"),
        (6, " ".join(ITEM.split()[:9]) + " " + words(30, 4)), (7, ITEM.replace(" ", "\n\t ")),
        (8, f"{words(5, 5)} {ITEM} {words(7, 6)} {ITEM}")], [(1, ITEM), (2, words(40, 77))])
    assert {k for k in got} >= {(1, 1), (2, 1), (5, 1), (7, 1), (8, 1)}
    assert (4, 1) not in got and (6, 1) not in got and not any(i == 2 for _, i in got)
    assert got[1, 1].changed_slots == 0 and got[2, 1].changed_slots >= 3 and got[1, 1].position == 30
    # the torn copy still has a consistent stretch only if that is long enough by itself; the whole diagonal is not consistent
    assert (3, 1) not in got


def test_a_conflicting_slot_does_not_hide_a_copy(corpus):
    left, mid, right = words(20, 31), words(19, 32), words(19, 33)
    item = f"{left} 12 {mid} 12 {right}"
    edited = f"{left} 12 {mid} 35 {right}"                      # one of two equal numbers edited, the rest word for word
    apart = f"{left} 40 {mid} {words(20, 34)}"                  # one consistent stretch, other words on the rest of the diagonal
    # two stretches that contradict each other, each consistent by itself
    two = f"{left} 40 {mid.rsplit(' ', 10)[0]} {words(10, 35)} 41 {right}"
    rows = [(1, f"{words(9, 36)} {edited}"), (2, f"x {apart}"), (3, two), (4, f"{words(30, 37)} 12 {words(19, 38)} 35")]
    got = found(corpus, rows, [(1, item)])
    assert set(got) == {(1, 1), (2, 1), (3, 1)}
    assert got[1, 1].changed_slots == 1 and got[1, 1].position == 9


def test_short_items_and_items_of_mostly_placeholders(corpus):
    arithmetic = "Add 12 kg 7 kg 30 g 5 kg and 9 l now"
    short = "Tom has 12 red apples and gives 5 away today"
    sums = words(16, 41) + " 3 + 4 = 7 and 5 + 6 = 11 or 8 - 2 = 6"
    items = [(1, arithmetic), (2, short), (3, sums)]
    got = found(corpus, [
        (1, f"{words(9, 42)} {arithmetic} {words(9, 43)}"), (2, f"{words(9, 44)} {arithmetic.replace('30', '31')}"),
        (3, f"{words(9, 45)}. {short.replace('Tom', 'Ann')}"), (4, f"{words(9, 46)}\n{short.replace('Tom', 'Mary Ann')}"),
        (5, f"{words(5, 47)} and {short.replace('Tom', 'Mary Ann').replace('12', '40')}"), (6, words(9, 48) + sums[-34:]),
        (7, "Ann has 3 green pears and gives 5 away today"), (8, "5 kg 7 kg 30 g 5 kg 9 l")], items)
    assert set(got) == {(1, 1), (3, 2), (4, 2), (5, 2), (6, 3)}
    assert got[1, 1].position == 9 and got[4, 2].position == 9 and got[5, 2].position == 6


def test_edge_cases(corpus):
    rows = edge_rows() + [(30, "one two three four five"), (31, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (32, "a b c d"),
                          (30, "one two three four five")]
    items = [(1, "one two three four five"), (2, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (3, "a b c d"), (4, None), (5, ""),
             (None, words(20, 2)), (6, words(60, 1)), (6, words(60, 1)), (7, words(60, 1))]
    got = found(corpus, rows, items)
    # equal texts under two item ids are two items; short and placeholder-only items never match
    assert set(got) == {(30, 1), (None, None), (6, 6), (6, 7), (7, 6), (7, 7), (8, 6), (8, 7)}
    assert D.leaks(docs(corpus, []), bench(corpus, items)).collect() == []
    assert D.leaks(docs(corpus, rows), bench(corpus, [])).collect() == []


def test_drop_leaks_keeps_clean_rows_and_columns(corpus):
    frame = docs(corpus, edge_rows(), clashing=True)
    kept = D.drop_leaks(frame, bench(corpus, [(1, words(60, 1))]))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (d is None, d or 0) for d, _ in edge_rows() if d not in (6, 7, 8))
    assert D.drop_leaks(frame, bench(corpus, [])).count() == len(edge_rows())


def test_shuffled_when_the_benchmark_is_large(corpus, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert set(found(corpus, [(1, f"x y {ITEM}")], [(1, ITEM)])) == {(1, 1)}


def test_documents_of_the_test_table_against_brute_force(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in corpus.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def tokens(t):
        return re.sub(r"[\x09-\x0d.,;:!?]+", " ", (t or "").lower()).split()

    want = set()
    for d, t in rows:
        w = tokens(t)
        at = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k:k + 8]), []).append(k)
        for i, text in items:
            b = tokens(text)
            shifts = {}
            for q in range(len(b) - 7):
                for k in at.get(tuple(b[q:q + 8]), ()):
                    shifts.setdefault(k - q, set()).add(q)
            if any(len(s) >= min(13, len(b)) - 7 for s in shifts.values()):
                want.add((d, i))
    got = D.leaks(docs(corpus, rows), bench(corpus, items)).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want


def test_no_python_on_the_main_path(corpus):
    plan = D.leaks(docs(corpus, edge_rows()), bench(corpus, [(1, ITEM)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
