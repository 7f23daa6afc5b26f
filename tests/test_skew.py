"""A hot user / hot session holding a third of all rows: results stay exact."""

import random
from datetime import timedelta

from sessionlab.operators import sessions as S
from sessionlab.sources.events import sessionize
from tests.helpers import ev, frame


def _brute_sessions(rows):
    """Per-user numbering in (time, id) order: +1 after every gap > 12 h."""
    by_user = {}
    for r in rows:
        by_user.setdefault(r[8], []).append(r)
    out = {}
    for u, rs in by_user.items():
        rs.sort(key=lambda r: (r[1], r[0]))
        n, prev = 0, None
        for r in rs:
            if prev is not None and (r[1] - prev) > timedelta(hours=12):
                n += 1
            out[r[0]] = n
            prev = r[1]
    return out


def test_sessionize_hot_user(spark):
    rnd = random.Random(3)
    rows, i = [], 0
    # hot user 1: a third of all rows, bursts with long and exactly-12h gaps
    t = 0
    for _ in range(1500):
        t += rnd.choice([1, 30, 3600, 43200, 43200, 43201, 90000])
        rows.append(ev(i, t, "view", None, user=1)); i += 1
    for u in range(2, 60):
        t = rnd.randint(0, 10**6)
        for _ in range(50):
            t += rnd.choice([5, 600, 50000])
            rows.append(ev(i, t, "view", None, user=u)); i += 1
    df = frame(spark, rows)
    got = {r.event_id: r.session_no for r in sessionize(df).select("event_id", "session_no").collect()}
    assert got == _brute_sessions(rows)


def test_rollup_hot_session(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        sess = "hot" if i % 3 == 0 else f"s{i % 97}"
        et = rnd.choice(["view", "cart", "remove_from_cart", "purchase"])
        rows.append(ev(i, i, et, sess, product=rnd.randint(0, 400), category=rnd.randint(0, 30),
                       code=rnd.choice([None, "a.x", "b.y"]) if i % 5 == 0 else None,
                       price=float(rnd.randint(-5, 500)), user=7))
    df = frame(spark, rows).repartition(16)
    got = {r.user_session: r for r in S.sessions_all(df, drop=()).collect()}
    hot = [r for r in rows if r[9] == "hot"]
    np_rows = [r for r in hot if r[2] != "purchase"]
    assert got["hot"].n_events == len(np_rows)
    assert got["hot"].unique_products == len({r[3] for r in np_rows})
    assert got["hot"].unique_categories == len({r[4] for r in np_rows})
    assert abs(got["hot"].avg_price - sum(r[7] for r in np_rows) / len(np_rows)) < 1e-3
    assert got["hot"].session_duration_sec == (max(r[1] for r in np_rows) - min(r[1] for r in np_rows)).total_seconds()


def test_wide_side_joins_by_shuffle(spark, monkeypatch):
    """The bound of a broadcast side is its measured bytes: few rows of long texts pass it, many
    rows of numbers may not."""
    from pyspark.sql import functions as F

    from sessionlab import config
    from sessionlab.operators.joins import lookup_join, side_bytes
    big = spark.range(1000).withColumn("k", F.col("id") % 50)
    narrow = spark.range(50).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("t"))
    wide = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("é"), 10_000).alias("t"), F.array(F.lit(1), F.lit(2)).alias("a"))
    assert side_bytes(narrow) == 50 * 8 and side_bytes(narrow.limit(0)) == 0
    assert 50 * 20_008 < side_bytes(wide) < 50 * 20_050
    monkeypatch.setattr(config, "BROADCAST_MAX_BYTES", 100_000)
    for side, kind in ((narrow, "BroadcastHashJoin"), (wide, "SortMergeJoin")):
        out = lookup_join(big, side, "k")
        assert kind in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1000


def test_rollup_of_products_in_many_categories(spark):
    """One product under several categories, and one category under several main categories, count once."""
    rows = [ev(i, i, "purchase" if i % 7 == 6 else "view", "s", product=i % 5, category=i % 3, price=float(i % 4)) for i in range(40)]
    rows += [ev(102, 0, "purchase", "p", product=9, category=9), ev(101, 0, "view", None)]
    from pyspark.sql import functions as F
    df = frame(spark, rows).withColumn("main_cat", F.when(F.col("event_id") % 4 == 0, "x").when(F.col("event_id") % 4 == 1, "y"))
    got = {r.user_session: r for r in S.session_features(df).collect()}
    kept = [r for r in rows[:40] if r[2] != "purchase"]
    assert (got["s"].unique_products, got["s"].unique_categories, got["s"].n_events) == (5, 3, len(kept))
    assert got["s"].main_cat == "x"                      # ten each: the smaller name
    assert (got["p"].unique_products, got["p"].unique_categories, got["p"].main_cat, got["p"].purchased) == (0, 0, None, 1)
