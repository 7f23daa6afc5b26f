"""Incremental partials equal the exact batch table; session windows close."""

from pyspark.sql import functions as F

from sessionlab.operators import sessions as S
from sessionlab.streaming.incremental import batch_partials, merge_partials_exact, write_partials
from tests.helpers import ev, frame


def test_partials_merge_equals_batch(spark, tmp_path):
    rows = [
        ev(1, 0, "view", "a", product=1, category=1, code="x.k", price=2.0, period=0),
        ev(2, 50, "cart", "a", product=2, category=2, price=4.0, period=0, brand="b"),
        ev(3, 86400 * 9, "view", "a", product=2, category=2, price=9.0, period=1),
        ev(4, 86400 * 9 + 5, "purchase", "a", product=3, category=2, code="y.k", price=1.0, period=1),
        ev(5, 10, "purchase", "p", product=3, category=2, price=1.0, period=0, user=3),
        ev(6, 86400 * 9, "view", "c", product=5, category=1, code="z.k", price=7.0, period=1, user=4),
    ]
    events = frame(spark, rows)
    root = str(tmp_path / "partials")
    for b, p in enumerate((0, 1)):  # one batch per period
        write_partials(batch_partials(events.filter(F.col("period") == p), b), root)
    write_partials(batch_partials(events.filter(F.col("period") == 1), 1), root)  # replay: idempotent
    inc = {r.user_session: r.asDict() for r in merge_partials_exact(spark, root, drop=()).collect()}
    exact = {r.user_session: r.asDict() for r in S.sessions_all(events, drop=()).collect()}
    assert inc.keys() == exact.keys()
    for k in exact:
        for c, v in exact[k].items():
            if isinstance(v, float):
                assert abs(float(inc[k][c]) - v) <= 1e-4 * max(1.0, abs(v)), (k, c)
            else:
                assert inc[k][c] == v, (k, c)
    # later period re-labels: category 1 maps to z.k (period 1), so 'a' has x? no: a's rows are cats 1,2,2,2
    assert inc["a"]["main_cat"] == "y"


def test_incremental_spread_and_nan_prices(spark, tmp_path):
    """Large prices that differ little, over two batches, and prices that are no numbers."""
    rows = [ev(i, i, "view", "a", price=16_000_000.0 + i % 2, period=i // 3) for i in range(6)]
    rows += [ev(10, 0, "view", "n", price=float("nan")), ev(11, 1, "view", "n", price=4.0), ev(12, 2, "cart", "n", price=float("nan"), period=1),
             ev(13, 0, "view", "only", price=float("nan"))]
    events = frame(spark, rows)
    for b in (0, 1):
        write_partials(batch_partials(events.filter(F.col("period") == b), b), str(tmp_path / "p"))
    exact = {r.user_session: r for r in S.sessions_all(events).collect()}
    inc = {r.user_session: r for r in merge_partials_exact(spark, str(tmp_path / "p")).collect()}
    assert abs(exact["a"].price_std - 0.5477) < 1e-4 and abs(inc["a"].price_std - exact["a"].price_std) < 1e-6
    for got in (exact, inc):
        assert (got["n"].avg_price, got["n"].max_price, got["n"].min_price, got["n"].price_std) == (4.0, 4.0, 4.0, 0.0)
        assert (got["only"].avg_price, got["only"].max_price, got["only"].n_events) == (0.0, 0.0, 1)


def test_partials_of_poor_batches(spark, tmp_path):
    """Batches without codes, without non-purchase rows and without any row, and no batch at all."""
    root = str(tmp_path / "p")
    assert merge_partials_exact(spark, root).collect() == []
    rows = [ev(1, 0, "purchase", "p", product=3, category=2, price=2.0, user=3), ev(2, 9, "view", "p", product=4, category=1, price=5.0, period=1, user=3),
            ev(3, 4, "view", None, period=1)]
    events = frame(spark, rows)
    steps = [events.limit(0), events.filter("event_type = 'purchase'"), events.filter("period = 1")]
    exact = {r.user_session: r for r in S.sessions_all(events).collect()}
    for b, part in enumerate(steps):
        write_partials(batch_partials(part, b), root)
        got = {r.user_session: r for r in merge_partials_exact(spark, root).collect()}
        assert set(got) == (set() if b == 0 else {"p"})
    assert got["p"] == exact["p"] and (got["p"].n_events, got["p"].unique_products, got["p"].main_cat, got["p"].purchased) == (1, 1, None, 1)


def test_windowed_sessions_match_gaps_and_islands(spark, tmp_path):
    """All sessions whatever the number and order of the files, and without an event that closes
    them; a hot user holds about a third of the events."""
    import random
    from datetime import timedelta

    from pyspark.sql import types as T

    from sessionlab.streaming.incremental import run_windowed
    from tests.helpers import EVENT_SCHEMA

    rnd, gap = random.Random(7), timedelta(hours=12)
    rows, t_user, i = [], {}, 0
    for _ in range(400):
        user = 1 if rnd.random() < 0.34 else rnd.randint(2, 9)
        step = rnd.choice([rnd.randint(1, 600), rnd.randint(13 * 60, 40 * 60)])  # minutes, never exactly 12 h
        t_user[user] = t_user.get(user, 0) + step
        i += 1
        etype = rnd.choice(["view", "view", "cart", "remove_from_cart", "purchase"])
        rows.append(ev(i, t_user[user] * 60, etype, None, price=float(rnd.randint(1, 50)), user=user))
    want, by_user = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        by_user.setdefault(r[8], []).append(r)
    for user, evs in by_user.items():
        groups = [[evs[0]]]
        for a, b in zip(evs, evs[1:]):
            if b[1] - a[1] >= gap:
                groups.append([])
            groups[-1].append(b)
        for g in groups:
            prices = [r[7] for r in g if r[2] != "purchase"]
            want[(user, g[0][1])] = (g[-1][1] + gap, len(prices), sum(prices) / len(prices) if prices else None,
                                     int(any(r[2] == "purchase" for r in g)))
    schema = T.StructType([f for f in EVENT_SCHEMA.fields if f.name != "user_session"])
    for files in (1, 8):
        rnd.shuffle(rows)
        src = str(tmp_path / f"src{files}")
        frame(spark, rows).drop("user_session").repartition(files).write.parquet(src)
        out = run_windowed(spark, src, schema, f"{src}-out", f"{src}-ckpt").collect()
        got = {(r.user_id, r.session_start): r for r in out}
        assert len(out) == len(got) and got.keys() == want.keys()
        for k, (end, n, avg, purchased) in want.items():
            r = got[k]
            assert (r.session_end, r.n_events, r.purchased) == (end, n, purchased), k
            assert (r.avg_price is None) == (avg is None) and (avg is None or abs(r.avg_price - avg) < 1e-9), k
