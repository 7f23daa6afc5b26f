"""Labels kept by batch equal the batch table in any order, and read only what a change concerns."""

import itertools
import random

from pyspark.sql import functions as F

from sessionlab.operators import sessions as S
from sessionlab.streaming.incremental import merge_partials_exact
from sessionlab.streaming.relabel import BUCKETS, add_batch, current_labels, read_state, run_labelled
from tests.helpers import EVENT_SCHEMA, ev, frame

DAY = 86400


def labels(spark, root):
    return {r.user_session: r.main_cat for r in current_labels(spark, root).collect()}


def truth(events):
    return {r.user_session: r.main_cat for r in S.sessions_all(events, drop=()).collect() if r.main_cat is not None}


def test_any_order_of_batches(spark, tmp_path):
    """Random codes that a later period changes, a session with a third of all events, ties, null
    sessions and null categories: every order of three batches, after each of them."""
    rnd, rows = random.Random(3), []
    for i in range(90):
        p = rnd.randrange(3)
        s = rnd.choice(["hot", "hot", "hot", "a", "b", "c", "d", "e", None])
        rows.append(ev(i, p * 9 * DAY + rnd.randrange(DAY), rnd.choice(["view", "cart", "purchase"]), s, product=i,
                       category=rnd.choice([1, 2, 3, 4, 5, None]), code=rnd.choice([None, None, "x.k", "y.k", "z", "x.l"]), period=p))
    events = frame(spark, rows)
    for n, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 2, 0)]):
        root = str(tmp_path / f"p{n}")
        for b, p in enumerate(order):
            add_batch(spark, events.filter(F.col("period") == p), root, b)
            assert labels(spark, root) == truth(events.filter(F.col("period").isin(*order[:b + 1])))
    exact = {r.user_session: r.asDict() for r in S.sessions_all(events, drop=()).collect()}
    got = {r.user_session: r.asDict() for r in merge_partials_exact(spark, root, drop=(), labels=current_labels(spark, root)).collect()}
    assert got.keys() == exact.keys()
    for k, c in itertools.product(exact, ("n_events", "unique_products", "unique_categories", "user_id", "purchased", "main_cat")):
        assert got[k][c] == exact[k][c], (k, c)


def test_reads_only_changed_categories(spark, tmp_path):
    """One of 200 categories gets another name: its bucket is read, its sessions alone are labelled
    anew; the same code again, a losing earlier code and a replay change nothing."""
    root = str(tmp_path / "p")
    base = [ev(i, 9 * DAY + i, "view", f"s{i}", category=i, code="a.b", period=1) for i in range(200)]
    add_batch(spark, frame(spark, base), root, 0)
    add_batch(spark, frame(spark, [ev(900, 18 * DAY, "view", "n", category=7, code="q.r", period=2)]), root, 1)
    add_batch(spark, frame(spark, [ev(901, 18 * DAY + 5, "view", "n", category=7, code="w", period=2),
                                   ev(902, 5, "view", "o", category=8, code="w", period=0),
                                   ev(903, 27 * DAY, "view", "o", category=9, code="a.z", period=3)]), root, 2)
    add_batch(spark, frame(spark, base).limit(0), root, 3)
    once = labels(spark, root)
    add_batch(spark, frame(spark, base).limit(0), root, 3)  # replayed
    log = {r.batch: r for r in read_state(spark, root, "label_log").collect()}
    assert labels(spark, root) == once and once["s7"] == once["n"] == "q" and once["s8"] == once["o"] == "a" and len(once) == 202
    assert (log[0].n_changed, log[0].n_read_items, log[0].n_labelled) == (200, 0, 200)
    assert (log[1].n_changed, log[1].n_earlier_items, log[1].n_moved_items, log[1].n_labelled) == (1, 200, 1, 2)
    assert 1 <= log[1].n_read_items <= 200 * 4 // BUCKETS
    assert [(log[b].n_changed, log[b].n_read_items, log[b].n_moved_items) for b in (2, 3)] == [(0, 0, 0)] * 2
    assert (log[2].n_labelled, log[3].n_labelled) == (2, 0)


def test_no_batch_and_restart(spark, tmp_path):
    """No state at all is an empty table; a stream that is stopped and started goes on."""
    root, src = str(tmp_path / "p"), str(tmp_path / "src")
    assert labels(spark, root) == {}
    rows = [ev(1, 0, "view", "a", category=1, period=0), ev(2, 9 * DAY, "view", "b", category=1, code="m.n", period=1),
            ev(3, 18 * DAY, "purchase", "a", category=2, code="c", period=2), ev(4, 18 * DAY + 1, "view", "a", category=1, code="d", period=2)]
    want = [{}, {"a": "m", "b": "m"}, {"a": "d", "b": "d"}]
    for p in range(3):
        frame(spark, [r for r in rows if r[-1] == p]).coalesce(1).write.mode("append").parquet(src)
        run_labelled(spark, src, EVENT_SCHEMA, root, str(tmp_path / "ckpt"))
        assert labels(spark, root) == want[p] == truth(frame(spark, [r for r in rows if r[-1] <= p]))
