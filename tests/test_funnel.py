import random
from datetime import datetime, timedelta

from shelfstrata.plans.insights import funnel_steps

STEPS = ["a", "b", "c", "d"]


def reached(events, within):
    """How many users come to each step, by trying every beginning."""
    users = {}
    for user, at, kind in events:
        if None not in (user, at):
            users.setdefault(user, []).append((at, kind))
    counts = [0] * len(STEPS)
    for rows in users.values():
        best = -1
        for begin in [at for at, kind in rows if kind == STEPS[0]]:
            now, step = begin, 0
            for at, kind in sorted(rows):
                if step + 1 < len(STEPS) and kind == STEPS[step + 1] and now < at <= begin + within:
                    now, step = at, step + 1
            best = max(best, step)
        for step in range(best + 1):
            counts[step] += 1
    return counts


def test_equals_trying_every_beginning_with_a_hot_user(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    events = []
    for n in range(3_000):
        user = "hot" if n % 3 == 0 else f"u{rng.randrange(150)}"
        events.append((user, start + timedelta(minutes=rng.randrange(30 * 24 * 6) * 10), rng.choice([*STEPS, "other"])))
    events += [(None, start, "a"), ("x", None, "a"), ("x", start, None), ("y", start, "a"), ("y", start, "b")]
    df = spark.createDataFrame(events, "user_id string, ts timestamp, event_type string").repartition(3)
    for hours in (5, 60):
        for chunk in (3_600, 86_400, 10**9):
            found = funnel_steps(df, STEPS, hours * 3_600, chunk).orderBy("position").collect()
            assert [r.users for r in found] == reached(events, timedelta(hours=hours))
            assert [r.step for r in found] == STEPS and found[0].share_of_first == 1.0


def test_no_events(spark):
    empty = spark.createDataFrame([], "user_id string, ts timestamp, event_type string")
    assert [(r.users, r.share_of_first) for r in funnel_steps(empty, STEPS, 60).collect()] == [(0, None)] * 4
