from llm_cases import corpus, rows, words  # noqa: F401

from switchboard.llm import preference as P

SCHEMA = "conv_id long, turn long, role string, text string, side string, position string, number string, digest string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "x", "x", "x") for t in turns], SCHEMA)


def brute(turns):
    convs = {}
    for c, n, role, text in turns:
        if c is not None:
            convs.setdefault(c, []).append((n if n is not None else -10**9, role or "", text or ""))
    out = [(None, "unpaired", None, role or "", f"<|{role or ''}|>\n{text or ''}\n", 0, 0, False)
           for c, n, role, text in turns if c is None]
    for pair in {c >> 1 for c in convs}:
        a, b = (sorted(convs.get(2 * pair + s, [])) for s in (0, 1))
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1
        for side, part, own in ((0, "chosen", a), (1, "rejected", b)):
            for i, (_, role, text) in enumerate(own):
                rendered = f"<|{role}|>\n{text}\n"
                train = i >= n and role == "assistant"
                if i >= n or side == 0:
                    out.append((pair, "prompt" if i < n else part, i, role, rendered, len(role) + 5 if train else 0,
                                len(rendered) if train else 0, bool(a and b)))
    return sorted(out, key=repr)


def turns():
    shared = [("system", "be brief"), ("user", "hé?"), ("assistant", "first")]
    out = [(0, i, *t) for i, t in enumerate(shared + [("user", "more"), ("assistant", "good")])]
    out += [(1, i, *t) for i, t in enumerate(shared + [("user", "more"), ("assistant", "bad"), ("user", "why")])]
    out += [(2, i, *t) for i, t in enumerate(shared)] + [(3, i, *t) for i, t in enumerate(shared)]   # equal
    out += [(4, 0, "user", "alone"), (4, 1, "assistant", None)]                                     # no partner
    out += [(6, 0, None, None), (7, 0, "", ""), (7, 5, "assistant", ""), (6, None, "user", "first by null")]
    out += [(8, 0, "user", "same turn"), (8, 0, "assistant", "same turn"), (9, 0, "assistant", "same turn"), (9, 2, "user", "x")]
    out += [(None, 0, "user", "nobody"), (None, None, None, None), (-3, 0, "user", "minus"), (-4, 0, "user", "minus")]
    out += [(10, 0, "user", words(50_000, 1)), (11, 0, "user", words(50_000, 1)), (11, 1, "assistant", words(50_000, 2))]
    return out


def test_against_brute_force(corpus):
    assert rows(P.format_pairs(P.adjacent_pairs(frame(corpus, turns())))) == brute(turns())


def test_a_conversation_with_a_third_of_all_turns(corpus):
    many = [(i % 20 + 2, i // 20, "assistant" if i % 2 else "user", words(3, i)) for i in range(1200)]
    many += [(c, i, "assistant" if i % 2 else "user", words(3, i)) for c in (0, 1) for i in range(700 + c)]
    assert rows(P.format_pairs(P.adjacent_pairs(frame(corpus, many)))) == brute(many)


def test_empty_table(corpus):
    assert P.format_pairs(P.adjacent_pairs(frame(corpus, []))).collect() == []


def test_assembled_parts_and_spans(corpus):
    formatted = P.format_pairs(P.adjacent_pairs(frame(corpus, turns()[:11])))
    got = {r.part: r for r in P.assemble(formatted).collect()}
    assert got["prompt"].text == "<|system|>\nbe brief\n<|user|>\nhé?\n<|assistant|>\nfirst\n<|user|>\nmore\n"
    assert got["prompt"].spans == []
    for part, want in (("chosen", "good\n"), ("rejected", "bad\n")):
        (span,) = got[part].spans
        assert got[part].text[span.start:span.end] == want


def test_last_answers_are_replaced(corpus):
    own = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "b1"), (1, 4, "user", "s"),
           (3, 0, "user", "q3"), (5, 0, "user", "q"), (5, 1, "assistant", None), (7, 0, "user", "q7"), (7, 9, "assistant", "c7"),
           (7, 9, "assistant", "d7"), (7, None, "assistant", "first"), (None, 0, "assistant", "nobody")]
    pairs = P.replaced_answers(frame(corpus, own))
    got = sorted(((r.pair_id, r.turn, r.role, r.text) for r in pairs.where("rejected").collect()), key=repr)
    last = max(("c7", "d7"), key=lambda t: __import__("hashlib").sha256(f"<|assistant|>\n{t}\n".encode()).hexdigest())
    other = ({"c7", "d7"} - {last}).pop()
    assert got == sorted([(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", None), (1, 4, "user", "s"),
                          (5, 0, "user", "q"), (5, 1, "assistant", last), (7, 0, "user", "q7"), (7, 9, "assistant", "b1"),
                          (7, 9, "assistant", other), (7, None, "assistant", "first")], key=repr)
    assert sorted(map(repr, pairs.where("NOT rejected").select("pair_id", "turn", "role", "text").collect())) == sorted(
        map(repr, frame(corpus, own).select(*"conv_id turn role text".split()).withColumnRenamed("conv_id", "pair_id").collect()))
    parts = {(r.pair_id, r.part, r.position) for r in P.format_pairs(pairs).where("pair_id = 1").collect()}
    assert parts == {(1, "prompt", 0), (1, "prompt", 1), (1, "prompt", 2), (1, "chosen", 3), (1, "chosen", 4), (1, "rejected", 3), (1, "rejected", 4)}
    assert P.format_pairs(P.replaced_answers(frame(corpus, []))).collect() == []
