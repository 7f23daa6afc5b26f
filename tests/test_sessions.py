"""Hand-made frames for the session semantics (NULL keys, ties, order, fills)."""

import math

import pytest
from pyspark.sql import functions as F

from sessionlab.operators import sessions as S
from sessionlab.operators.features import add_features
from sessionlab.operators.joins import fill_main_cat
from tests.helpers import ev, frame


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        # s1: views/cart/remove + purchase; two categories; brand on one row
        ev(1, 0, "view", "s1", product=1, category=10, code="appliances.kettle", price=10.0),
        ev(2, 30, "view", "s1", product=2, category=10, price=20.0, brand="b"),
        ev(3, 60, "cart", "s1", product=2, category=11, code="furniture.chair", price=30.0),
        ev(4, 90, "remove_from_cart", "s1", product=2, category=11, price=40.0),
        ev(5, 100, "purchase", "s1", product=3, category=11, price=999.0),
        # s2: purchase only
        ev(6, 0, "purchase", "s2", product=5, category=12, price=5.0, user=8),
        # s3: one non-purchase event -> std 0, duration 0
        ev(7, 0, "view", "s3", product=6, category=13, price=3.0, user=9),
        # NULL session key: dropped
        ev(8, 0, "view", None, product=6, category=13, price=3.0, user=9),
        # s4: mode tie between two classes -> smallest; NULL prices
        ev(9, 0, "view", "s4", product=7, category=10, price=None, user=10),
        ev(10, 5, "view", "s4", product=8, category=11, price=None, user=10),
        # s5: rare class 'sport' only
        ev(11, 0, "view", "s5", product=9, category=14, code="sport.ball", price=2.0, user=11),
        # s6: category never mapped -> NULL main_cat, kept
        ev(12, 0, "cart", "s6", product=10, category=15, price=-4.0, user=12),
    ]
    return frame(spark, rows)


def by_key(df):
    return {r["user_session"]: r for r in df.collect()}


def test_rollup_semantics(events):
    s = by_key(S.sessions_all(events, drop=("sport",)))
    assert set(s) == {"s1", "s2", "s3", "s4", "s6"}  # NULL key and rare class gone, NULL main_cat kept
    s1 = s["s1"]
    assert (s1.n_view, s1.n_cart, s1.n_remove, s1.n_events) == (2, 1, 1, 4)
    assert s1.avg_price == pytest.approx(25.0) and s1.max_price == 40.0 and s1.min_price == 10.0
    assert s1.price_std == pytest.approx(math.sqrt(((15**2) + 5**2 + 5**2 + 15**2) / 3), rel=1e-6)
    assert (s1.unique_products, s1.unique_categories, s1.has_brand) == (2, 2, 1)
    assert s1.session_duration_sec == 90.0 and s1.purchased == 1
    s2 = s["s2"]
    assert (s2.n_events, s2.avg_price, s2.price_std, s2.session_duration_sec, s2.purchased) == (0, 0.0, 0.0, 0.0, 1)
    assert s2.user_id == 8  # fallback to all events
    assert s["s3"].price_std == 0.0 and s["s3"].session_duration_sec == 0.0
    assert s["s4"].avg_price == 0.0 and s["s4"].main_cat == "appliances"  # tie -> smallest
    assert s["s6"].main_cat is None and s["s6"].avg_price == -4.0


def test_main_cat_mode_over_all_events(events):
    s = by_key(S.sessions_all(events, drop=()))
    # s1: categories 10,10,11,11,11 (purchase row counts) -> furniture
    assert s["s1"].main_cat == "furniture"
    assert s["s5"].main_cat == "sport"


def test_category_map_first_in_period_later_period_wins(spark):
    rows = [
        ev(1, 10, "view", "a", category=1, code="x.one", period=0),
        ev(2, 5, "view", "a", category=1, code="y.two", period=0),    # earlier in time -> wins in period 0
        ev(3, 0, "view", "b", category=2, code="z.first", period=0),
        ev(4, 99, "view", "b", category=2, code="w.later", period=1),  # later period overwrites
        ev(5, 1, "view", "b", category=2, code="v.later2", period=1),
    ]
    m = {r.category_id: r.category_code for r in S.category_map(frame(spark, rows)).collect()}
    assert m == {1: "y.two", 2: "v.later2"}


def test_null_type_counts_as_non_purchase(spark):
    rows = [ev(1, 0, None, "a", price=2.0), ev(2, 10, "purchase", "a", price=50.0)]
    s = by_key(S.sessions_all(frame(spark, rows), drop=()))["a"]
    assert (s.n_events, s.n_view, s.avg_price, s.purchased) == (1, 0, 2.0, 1)


def test_monthly_merge_rules(spark):
    rows = [
        ev(1, 0, "view", "m", price=10.0, period=0), ev(2, 10, "view", "m", price=20.0, period=0),
        ev(3, 86400, "purchase", "m", price=7.0, period=1),          # purchase-only part
        ev(4, 0, "view", "solo", price=4.0, period=2, user=3),
    ]
    evs = frame(spark, rows)
    merged = by_key(S.monthly_merge(evs, drop=()))
    exact = by_key(S.sessions_all(evs, drop=()))
    m = merged["m"]
    assert m.n_events == 2 and m.purchased == 1
    assert m.avg_price == pytest.approx((15.0 + 0.0) / 2)      # mean of part means, empty part = 0
    assert m.min_price == 0.0                                # purchase-only part contributes 0
    assert exact["m"].min_price == 10.0 and exact["m"].avg_price == 15.0
    assert merged["solo"].asDict() == exact["solo"].asDict()  # one part: identity


def test_add_features_ratios(spark):
    rows = [ev(1, 0, "cart", "a"), ev(2, 1, "remove_from_cart", "a"), ev(3, 2, "remove_from_cart", "a"),
            ev(4, 0, "view", "b"), ev(5, 1, "cart", "b"), ev(6, 2, "cart", "b")]
    f = by_key(add_features(S.sessions_all(frame(spark, rows), drop=())))
    assert f["a"].cart_to_view_ratio == 0.0 and f["a"].remove_to_cart_ratio == 2.0
    assert f["b"].cart_to_view_ratio == 2.0 and f["b"].remove_to_cart_ratio == 0.0


def test_fill_main_cat_unmatched_is_null(spark, events):
    cm = spark.createDataFrame([(10, "appliances.kettle")], "category_id long, category_code string")
    out = fill_main_cat(events, cm).select("category_id", "main_cat").distinct().collect()
    d = {r.category_id: r.main_cat for r in out}
    assert d[10] == "appliances" and d[11] is None


def test_first_month_and_duplicates(spark):
    rows = [ev(1, 0, "view", "x", period=2), ev(2, 5, "view", "x", period=1), ev(3, 0, "view", "y", period=3)]
    fm = {r.user_session: (r.period, r.month) for r in S.session_first_month(frame(spark, rows)).collect()}
    assert fm == {"x": (1, "p1"), "y": (3, "p3")}
    dup = [r.user_session for r in S.duplicate_sessions(frame(spark, rows)).collect()]
    assert dup == ["x"]


def test_event_view_counts_match_fixture(spark):
    """Step 0: the event view over the driver tables (counts from FIXTURES.md)."""
    from sessionlab.sources.events import shop_events
    e = shop_events(spark, "/root/testdata/sf0.01")
    row = e.agg(F.count(F.lit(1)).alias("n"), F.count("category_code").alias("code"),
                F.count("brand").alias("brand"), F.count("user_session").alias("sess")).first()
    assert (row.n, row.code, row.brand, row.sess) == (10000, 714, 6666, 9989)
    s = S.sessions_all(e, drop=())
    assert s.count() == 3290
    assert S.sessions_all(e, drop=("promo",)).count() == 2974
