"""Sessions of a stream over many triggers equal one pass over all rows; late rows are kept."""

import random
from datetime import timedelta

from sessionlab.streaming.windowed import add_batch, all_sessions, read_state, run_sessions
from tests.helpers import EVENT_SCHEMA, ev, frame

GAP = timedelta(hours=12)


def islands(rows):
    """By hand: (user, start) -> (end, non-purchase rows, mean price, purchased)."""
    by_user, want = {}, {}
    for r in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1]):
        by_user.setdefault(r[8], []).append(r)
    for user, evs in by_user.items():
        groups = [[evs[0]]]
        for a, b in zip(evs, evs[1:]):
            if b[1] - a[1] >= GAP:
                groups.append([])
            groups[-1].append(b)
        for g in groups:
            prices = [r[7] for r in g if r[2] != "purchase"]
            want[(user, g[0][1])] = (g[-1][1] + GAP, len(prices), round(sum(prices) / len(prices), 9) if prices else None,
                                     int(any(r[2] == "purchase" for r in g)))
    return want


def told(spark, root):
    out = all_sessions(spark, root).collect()
    got = {(r.user_id, r.session_start): (r.session_end, r.n_events, r.avg_price and round(r.avg_price, 9), r.purchased) for r in out}
    assert len(got) == len(out)
    return got


def some_rows(n):
    """A hot user with a third of the rows, pauses of exactly the gap, rows of no user."""
    rnd, rows, t_user = random.Random(11), [], {}
    for i in range(n):
        user = 1 if rnd.random() < 0.34 else rnd.choice([2, 3, 4, 5, None])
        t_user[user] = t_user.get(user, 0) + rnd.choice([rnd.randint(1, 600), 720, rnd.randint(730, 2400)])
        rows.append(ev(i, t_user[user] * 60, rnd.choice(["view", "view", "cart", "purchase"]), None, price=float(rnd.randint(1, 50)), user=user))
    return rows


def test_triggers_in_any_order(spark, tmp_path):
    """One batch, batches in the order of time, and shuffled ones; no state is an empty table."""
    assert told(spark, str(tmp_path / "none")) == {}
    rows = some_rows(160)
    want, in_time, mixed = islands(rows), sorted(rows, key=lambda r: r[1]), random.Random(2).sample(rows, len(rows))
    for name, source, batches in (("one", rows, 1), ("time", in_time, 4), ("mixed", mixed, 4)):
        root, size = str(tmp_path / name), -(-len(rows) // batches)
        for b in range(batches):
            add_batch(spark, frame(spark, source[b * size:(b + 1) * size]), root, b)
        assert told(spark, root) == want, name
        log = read_state(spark, root, "progress").collect()
        late = read_state(spark, root, "late").count()
        assert sum(r.n_rows for r in log) == len(rows) and sum(r.n_late for r in log) == late
        assert (late > 0) == (name == "mixed") and max(log, key=lambda r: r.batch).n_open < len(want)


def test_restart_replay_and_empty_batches(spark, tmp_path):
    """A stream that is stopped after each file; its last batch again; a batch without rows; rows
    without a time."""
    root, src, rows = str(tmp_path / "s"), str(tmp_path / "src"), some_rows(60)
    timeless = (900, None) + ev(900, 0, "view", None)[2:]
    steps = [rows[20:40] + [timeless], rows[:20], rows[40:]]
    for k, part in enumerate(steps):
        frame(spark, part).coalesce(1).write.mode("append").parquet(src)
        run_sessions(spark, src, EVENT_SCHEMA, root, str(tmp_path / "ckpt"))
        if k != 1:
            assert told(spark, root) == islands([r for s in steps[:k + 1] for r in s])
    add_batch(spark, frame(spark, steps[2]), root, 2)
    add_batch(spark, frame(spark, rows).limit(0), root, 3)
    assert told(spark, root) == islands(rows)
    log = {r.batch: r for r in read_state(spark, root, "progress").collect()}
    assert [log[b].n_rows for b in range(4)] == [21, 20, 20, 0] and [log[b].n_timeless for b in range(4)] == [1, 0, 0, 0]
    assert log[3].latest == log[2].latest and log[3].n_late == 0
