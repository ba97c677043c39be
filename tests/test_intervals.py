"""Interval sweeps, calls over several intervals, and replies, against plain loops."""

import random

import pytest

from switchboard.operators import intervals as I
from test_bucketed_windows import ranged  # noqa: F401

DAY = 86_400


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_adherence_minutes_second_by_second(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(160):
        start = rnd.randint(0, 3 * DAY)
        rows.append((rnd.choice([1, 1, 2, None]), rnd.choice(I.KINDS), start, start + rnd.choice([0, -5, 60, 4000, 30_000, 100_000])))
    rows += [(1, "scheduled", None, 5), (1, "worked", 5, None), (3, "timeoff", 10, 20), *rows[:20]]
    seconds = {}
    for a, kind, s, e in rows:
        for t in range(s or 0, e or 0) if s is not None and e is not None else ():
            seconds.setdefault((a, t // DAY), {}).setdefault(t, set()).add(kind)
    want = []
    for (a, d), of in seconds.items():
        on = [k for k in of.values() if "scheduled" in k]
        want.append((a, len(on) // 60, sum("worked" in k for k in on) // 60, sum("exception" in k and "timeoff" not in k for k in on) // 60,
                     sum("timeoff" in k for k in on) // 60, d))
    got = I.adherence_minutes(spark.createDataFrame(rows, "agent_sk bigint, kind string, start_s bigint, end_s bigint"))
    got = [(*r[:5], r.event_date.toordinal() - 719_163) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_calls_are_dealt_to_the_intervals_they_cover(spark):
    rnd = random.Random(2)
    calls = []
    for i in range(120):
        at, wait = rnd.randint(0, 20_000), rnd.randint(0, 40_000)
        calls.append((rnd.choice([1, 2, None]), at, rnd.random() < 0.2, wait, at + wait // 100 + rnd.choice([0, 30, 1800, 9000])))
    got = I.queue_interval_measures(spark.createDataFrame(
        calls, "queue_sk bigint, call_s bigint, abandoned boolean, wait_cents bigint, end_s bigint"), 30, 20)
    want = {}
    for q, at, lost, wait, end in calls:
        own = want.setdefault((q, at // 1800), [0, 0, 0, 0, 0, 0, 0])
        for k, v in enumerate((1, not lost, lost, not lost and wait < 2000, 0 if lost else wait)):
            own[k] += int(v)
        covered = {}
        for t in range(at + wait // 100, end) if not lost else ():
            covered[t // 1800] = covered.get(t // 1800, 0) + 1
        for slot, n in covered.items():
            own = want.setdefault((q, slot), [0, 0, 0, 0, 0, 0, 0])
            own[5] += n
            own[6] += 1

    def half_up(n, d):
        return (2 * 100 * n + d) // (2 * d) if d else None

    rows = {(r.queue_sk, int(r.interval_start_ts.timestamp()) // 1800): r for r in got.collect()}
    assert rows.keys() == want.keys()
    for key, (o, a, b, s, wait, sec, n) in want.items():
        r = rows[key]
        assert (r.offered, r.answered, r.abandoned, r.answered_in_sl) == (o, a, b, s)
        assert [None if x is None else int(x * 100) for x in (r.avg_speed_answer_sec, r.avg_handle_sec)] == [half_up(wait, 100 * a), half_up(sec, n)]


def test_replies_across_ranges(ranged):  # noqa: F811
    rnd = random.Random(3)
    rows = [((1, None, rnd.randint(2, 6))[i % 3], i, rnd.randint(0, 5000), rnd.random() < 0.8) for i in range(300)]
    rows += [(9, 1000, 7, True), (9, 1001, 7, False), (8, 1002, 9, True), (8, 1003, 8, False)]
    got = I.reply_minutes(ranged.createDataFrame(rows, "thread bigint, message_id bigint, sent_s bigint, from_customer boolean"), 2)
    want = []
    for k, m, t, asks in rows:
        if asks:
            reply = min((u for q, _, u, other in rows if k is not None and q == k and not other and u >= t), default=None)
            taken = None if reply is None else (reply - t) // 60
            want.append((k, m, t, reply, taken, None if taken is None else taken > 2))
    assert _rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("rows", [[], [(1, 1, 5, True)]])
def test_no_messages_or_no_reply(spark, rows):
    got = I.reply_minutes(spark.createDataFrame(rows, "thread bigint, message_id bigint, sent_s bigint, from_customer boolean"), 2)
    assert [tuple(r) for r in got.collect()] == [(*r[:3], None, None, None) for r in rows]
