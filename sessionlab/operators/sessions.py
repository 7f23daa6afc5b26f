"""Event -> session rollups.

The exact path (``sessions_all``) is one ``groupBy(user_session)`` with
conditional aggregates: features from non-purchase rows, targets from all rows,
so purchase-only sessions survive without a join.  Every aggregate is
partial/final (map-side combine), so a hot session is pre-aggregated on each
mapper and never collected into a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.constants import (CART, COUNT_COLS, DEFAULT_DROP_CATEGORIES, FLOAT_COLS, PURCHASE, REMOVE,
                                  VIEW)
from sessionlab.functions.exprs import duration_seconds, is_type, main_cat_of, micros, non_purchase, price_of
from sessionlab.operators.joins import lookup_join

KEY = "user_session"


# --- P operators ------------------------------------------------------------

def event_flags(events: DataFrame) -> DataFrame:
    """is_view / is_cart / is_remove / is_purchase / has_brand_flag."""
    return events.select(
        "*",
        is_type(VIEW).alias("is_view"),
        is_type(CART).alias("is_cart"),
        is_type(REMOVE).alias("is_remove"),
        is_type(PURCHASE).alias("is_purchase"),
        F.col("brand").isNotNull().cast("int").alias("has_brand_flag"),
    )


def non_purchase_events(events: DataFrame) -> DataFrame:
    """Events that are not purchases (NULL type kept)."""
    return events.filter(non_purchase())


def drop_categories(sessions: DataFrame, categories=DEFAULT_DROP_CATEGORIES) -> DataFrame:
    """Drop sessions of rare classes, keep NULL main_cat."""
    return sessions.filter(F.col("main_cat").isNull() | ~F.col("main_cat").isin(list(categories)))


def categorized_sessions(sessions: DataFrame) -> DataFrame:
    """P5: sessions with a known main category (sessions_cat)."""
    return sessions.filter(F.col("main_cat").isNotNull())


def fill_missing(sessions: DataFrame) -> DataFrame:
    """NULL and NaN -> 0 for counts, flags, prices, std and duration,
    narrowed to the session table types."""
    out = sessions
    cols = set(sessions.columns)
    for c in COUNT_COLS:
        if c in cols:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("int"))
    for c in FLOAT_COLS:
        if c in cols:
            x = F.col(c).cast("double")
            out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x).cast("float"))
    if "has_brand" in cols:
        out = out.withColumn("has_brand", F.coalesce(F.col("has_brand"), F.lit(0)).cast("tinyint"))
    if "purchased" in cols:
        out = out.withColumn("purchased", F.coalesce(F.col("purchased"), F.lit(0)).cast("tinyint"))
    if "user_id" in cols:
        out = out.withColumn("user_id", F.col("user_id").cast("bigint"))
    return out


# --- B1: category map --------------------------------------------------------

def category_map(events: DataFrame, period: str | None = "period", tiebreak: str = "event_id") -> DataFrame:
    """One code per category id.

    Within a period the first code seen wins (time, then ``tiebreak`` order);
    a later period overwrites an earlier one.  Step 1 groups by (category,
    code) and keeps each code's best order key, packed into one decimal (a
    hash aggregate over the events); step 2 picks the best code per category
    on that small table."""
    per = F.col(period).cast("long") if period else F.lit(0).cast("long")
    # larger key = preferred inside a period: earlier time, then smaller id
    key = ((_dec(10**17) - micros("event_time").cast(_D38)) * _dec(10**20)
           + (_dec(2**63) - F.col(tiebreak).cast(_D38)))
    codes = (events.filter(F.col("category_code").isNotNull()).withColumn("_p", per)
             .groupBy("category_id", "_p", "category_code").agg(F.max(key).alias("_k")))
    # later period wins: one row per (category, period, code), a small table
    return codes.groupBy("category_id").agg(
        F.max_by("category_code", F.struct("_p", "_k")).alias("category_code"))


# --- B2/B3: session rollup ---------------------------------------------------

def _when_np(c: Column) -> Column:
    return F.when(non_purchase(), c)


_D38 = "decimal(38,0)"


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast(_D38)


def first_row_key(np_: Column, us: Column, tiebreak: Column) -> Column:
    """Exact order key (non-purchase rows first, then time, then tie-break id)
    packed into one DECIMAL(38,0): purchase flag * 4e37 + (us + 1e17) * 1e20 +
    (id + 2^63).  Unlike a struct it keeps the min-by buffer fixed-width, so
    the aggregate stays a hash aggregate."""
    return (F.when(np_, 0).otherwise(1).cast(_D38) * _dec(4 * 10**37)
            + (us.cast(_D38) + _dec(10**17)) * _dec(10**20)
            + (tiebreak.cast(_D38) + _dec(2**63)))


def main_cat_vocab(cat_map: DataFrame) -> DataFrame:
    """Main categories of a category map with alphabetical dense ids (one row
    per class)."""
    return _numbered(cat_map.select(main_cat_of("category_code").alias("main_cat")))


def _numbered(names: DataFrame) -> DataFrame:
    names = names.filter(F.col("main_cat").isNotNull()).distinct()
    return names.withColumn("_cid", F.dense_rank().over(Window.orderBy("main_cat")).cast("long"))


def category_lookups(cat_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(category_id -> main_cat and its id, id -> main_cat), each written once: the map is derived
    from the events, and both the events and the rolled-up sessions look up in it."""
    named = written(cat_map.select("category_id", main_cat_of("category_code").alias("main_cat")), "category-names")
    vocab = written(_numbered(named.select("main_cat")), "vocabulary")
    return written(lookup_join(named, vocab, "main_cat", "left").select("category_id", "_cid"), "category-ids"), vocab


def _statistics(ev: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, prices, times and flags of each session: one aggregate, which leaves every mapper
    with one fixed-width row per session."""
    np_ = non_purchase()
    price = price_of()
    us = micros("event_time")
    return ev.groupBy(*keys).agg(
        F.min_by("user_id", first_row_key(np_, us, F.col("event_id"))).alias("user_id"),
        F.sum(F.when(np_, is_type(VIEW))).alias("n_view"),
        F.sum(F.when(np_, is_type(CART))).alias("n_cart"),
        F.sum(F.when(np_, is_type(REMOVE))).alias("n_remove"),
        F.count(F.when(np_, F.lit(1))).alias("n_events"),
        F.avg(F.when(np_, price)).alias("avg_price"),
        F.max(F.when(np_, price)).alias("max_price"),
        F.min(F.when(np_, price)).alias("min_price"),
        F.stddev_samp(F.when(np_, price)).alias("price_std"),
        F.max(F.when(np_, F.col("brand").isNotNull().cast("int"))).alias("has_brand"),
        F.min(F.when(np_, F.col("event_time"))).alias("_ts_min"),
        F.max(F.when(np_, F.col("event_time"))).alias("_ts_max"),
        F.max(is_type(PURCHASE)).alias("purchased"),
    )


def _items(ev: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct products and categories (of non-purchase rows) and the most frequent main
    category (of all rows) of each session.

    Step 1 groups by (keys, product, category, _cid): at most one narrow row per event is
    shuffled, fewer where a session comes back to a product.  Step 2 counts what is left by (keys,
    kind, item) with the kinds product, category and main category, step 3 by the keys: distinct
    counts are row counts, the mode is ``min_by(id, (-count, id))``.  A hot session is spread over
    its items in steps 1 and 2 and reaches step 3 pre-aggregated."""
    seen = ev.groupBy(*keys, "product_id", "category_id", "_cid").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(non_purchase()).alias("_n_np"))
    kinds = F.array(
        F.struct(F.lit(1).alias("k"), F.when(F.col("_n_np") > 0, F.col("product_id").cast("long")).alias("item")),
        F.struct(F.lit(2).alias("k"), F.when(F.col("_n_np") > 0, F.col("category_id").cast("long")).alias("item")),
        F.struct(F.lit(3).alias("k"), F.col("_cid").alias("item")))
    items = (seen.select(*keys, "_n", F.inline(kinds)).filter(F.col("item").isNotNull())
             .groupBy(*keys, "k", "item").agg(F.sum("_n").alias("_n")))
    s3 = F.col("k") == 3
    mode_key = F.when(s3, (-F.col("_n")).cast(_D38) * _dec(10**20) + F.col("item").cast(_D38))
    return items.groupBy(*keys).agg(
        F.count_if(F.col("k") == 1).alias("unique_products"),
        F.count_if(F.col("k") == 2).alias("unique_categories"),
        F.min_by(F.when(s3, F.col("item")), mode_key).alias("_cid"),
    )


def _rollup(ev: DataFrame, keys: list[str], vocab: DataFrame) -> DataFrame:
    """Exact session rollup in hash aggregates (no Expand, no object or sort-based aggregate over
    the events): statistics and items, both partitioned by the keys where they meet.

    ``ev`` carries ``_cid``, the id of its main category in ``vocab`` (ids follow the alphabetical
    order of that bounded table).  It is read twice, each time pruned to the columns in use:
    derived events are best written first."""
    items = _items(ev, keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    out = _statistics(ev, keys).join(items, same, "left").drop(*[f"_{k}" for k in keys])
    return lookup_join(out, vocab.select("_cid", "main_cat"), "_cid", "left").drop("_cid")


def _finish(rolled: DataFrame, extra: list[str] | None = None) -> DataFrame:
    out = rolled.withColumn("session_duration_sec", duration_seconds("_ts_min", "_ts_max"))
    out = fill_missing(out.withColumn("purchased", (F.col("purchased") > 0).cast("tinyint")))
    return out.select(*(extra or []), KEY, "user_id", "n_view", "n_cart", "n_remove", "n_events",
                      "avg_price", "max_price", "min_price", "price_std", "unique_products",
                      "unique_categories", "has_brand", "session_duration_sec", "purchased", "main_cat")


def session_features(events_with_cat: DataFrame, by: list[str] | None = None,
                     vocab: DataFrame | None = None) -> DataFrame:
    """B2+B6+B4: one row per session (per ``by`` + session) from events that
    already carry ``main_cat``.  NULL session keys are dropped first."""
    keys = (by or []) + [KEY]
    ev = events_with_cat.filter(F.col(KEY).isNotNull())
    # events of unknown origin: the names they carry
    vocab = written(_numbered(ev.select("main_cat")) if vocab is None else vocab, "vocabulary")
    return _finish(_rollup(lookup_join(ev, vocab, "main_cat", "left"), keys, vocab), extra=by)


def _sessions_by(events: DataFrame, cat_map: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The rollup of raw events, which meet one narrow lookup (category id -> main category id)."""
    ids, vocab = category_lookups(cat_map)
    ev = lookup_join(events.filter(F.col(KEY).isNotNull()), ids, "category_id", "left")
    return _finish(_rollup(ev, (by or []) + [KEY], vocab), extra=by)


def sessions_all(events: DataFrame, drop=DEFAULT_DROP_CATEGORIES, cat_map: DataFrame | None = None) -> DataFrame:
    """Exact event -> session table (default path).

    category map -> size-checked broadcast lookup -> one aggregate by session
    -> rare-class drop (NULL kept).
    """
    cm = category_map(events) if cat_map is None else cat_map
    return drop_categories(_sessions_by(events, cm), drop)


def exact_mode(df: DataFrame, keys: list[str], col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-NULL ``col`` per ``keys`` (ties -> smallest; NULL when
    a group has no value).  Counts per (keys, value) first (partial/final), then
    ``min_by(value, (-count, value))``: two hash aggregates, no per-group map,
    and a hot group is spread over its values."""
    counts = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    has = F.col(col).isNotNull()
    return counts.groupBy(*keys).agg(
        F.min_by(F.when(has, F.col(col)), F.when(has, F.struct(-F.col("_n"), F.col(col)))).alias(out or col))


def session_main_cat(events_with_cat: DataFrame) -> DataFrame:
    """Most frequent main_cat per session over all events, ties -> smallest."""
    return exact_mode(events_with_cat.filter(F.col(KEY).isNotNull()), [KEY], "main_cat")


def purchase_label(events: DataFrame) -> DataFrame:
    """purchased = any purchase event in the session."""
    return (events.filter(F.col(KEY).isNotNull()).groupBy(KEY)
            .agg(F.max(is_type(PURCHASE)).cast("tinyint").alias("purchased")))


# --- B5: per-period partials merged with the original (approximate) rules ----

def monthly_merge(events: DataFrame, drop=DEFAULT_DROP_CATEGORIES, period: str = "period",
                  cat_map: DataFrame | None = None) -> DataFrame:
    """Roll up by (period, session), then merge a session's periods:
    sums for counts, distinct counts and durations; unweighted mean of means
    and of stds; max of max; min of min (a purchase-only part counts as 0);
    first user id by period; mode of the parts' main_cat.  A session seen in
    one period keeps its row unchanged.  Both steps are partial/final
    aggregates; the second runs on the (much smaller) partial table.
    """
    cm = category_map(events, period) if cat_map is None else cat_map
    parts = _sessions_by(events, cm, by=[period])
    return drop_categories(merge_partials(parts, period), drop)


def merge_partials(parts: DataFrame, period: str = "period") -> DataFrame:
    merged = parts.groupBy(KEY).agg(
        F.min_by("user_id", F.col(period)).alias("user_id"),
        *[F.sum(c).alias(c) for c in ["n_view", "n_cart", "n_remove", "n_events"]],
        F.avg(F.col("avg_price").cast("double")).alias("avg_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.avg(F.col("price_std").cast("double")).alias("price_std"),
        F.sum("unique_products").alias("unique_products"),
        F.sum("unique_categories").alias("unique_categories"),
        F.max("has_brand").alias("has_brand"),
        F.max("purchased").alias("purchased"),
        F.sum(F.col("session_duration_sec").cast("double")).alias("session_duration_sec"),
    )
    # parts of one session carry at most one row per period: the mode join is
    # between two tables keyed by session
    merged = merged.join(exact_mode(parts, [KEY], "main_cat"), KEY, "left")
    return fill_missing(merged).select(*[c for c in parts.columns if c != period])


# --- D1/D3: periods of a session --------------------------------------------

def session_first_month(events: DataFrame, period: str = "period") -> DataFrame:
    """Earliest period of each (non-NULL) session; no sort needed."""
    return (events.filter(F.col(KEY).isNotNull()).groupBy(KEY)
            .agg(F.min(period).alias("period"))
            .withColumn("month", period_label("period")))


def period_label(c: str) -> Column:
    return F.format_string("p%d", F.col(c))


def duplicate_sessions(events: DataFrame, period: str = "period") -> DataFrame:
    """D3: sessions present in more than one period, with their period count."""
    return (events.filter(F.col(KEY).isNotNull()).groupBy(KEY)
            .agg(F.count_distinct(period).alias("n_periods"))
            .filter(F.col("n_periods") > 1))
