"""Data-quality and leakage audit (Q1-Q17).

Every check returns rows ``(check, value, passed)``; informational checks have
``passed`` NULL.  Scalar checks over the session table are computed in one
aggregate pass; per-feature checks use the long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.constants import (FEATURE_COLS, MAX_DECILE_PURITY, MAX_UNIVARIATE_AUC, OUTLIER_QUANTILE,
                                  WEIGHT_RATIO_BOUNDS)
from sessionlab.operators.features import to_long
from sessionlab.operators.joins import not_in, with_scalars
from sessionlab.operators.metrics import roc_auc
from sessionlab.operators.stats import class_weights, crosstab_purity, quantile_cut

# --- fixed values: bounds the original audit uses on its own data -----------
ORIGINAL_BOUNDS = {
    "n_sessions": (3_400_000, 3_700_000),
    "purchase_rate": (0.030, 0.036),
    "n_sessions_cat": (125_000, 135_000),
}
ORIGINAL_SHARE_BOUNDS = {"appliances": (0.40, 0.50), "accessories": (0.08, 0.11)}
# ---------------------------------------------------------------------------

# names of the checks, for the operators and their oracles alike
CHECK = {
    "event_sum": "event counts add up",
    "auc": "largest single-feature AUC",
    "cat_le_prod": "categories never exceed products",
    "purity": "pure deciles",
    "n_sessions": "sessions in range",
    "rate": "purchase rate in range",
    "n_cat": "categorised sessions in range",
    "shares": "class shares in range",
    "nulls": "missing feature values",
    "negative": "negative counts",
    "key_all": "repeated keys, all sessions",
    "key_cat": "repeated keys, categorised sessions",
    "subset": "categorised sessions outside the table",
    "spot": "sessions that a second rollup contradicts",
    "pure": "purchase rate without other events",
    "pure_n": "sessions of purchases only",
    "pure_nz": "such sessions with a feature set",
    "single": "single events with a price spread",
    "single_share": "share of single-event sessions",
    "cut": "outlier cut",
    "above": "sessions above the cut",
    "rate_above": "purchase rate above the cut",
    "rate_all": "purchase rate of all",
    "neg_price": "sessions of negative mean price",
    "weights": "class weight ratio",
    "passed": "passed",
    "cv_binary": "spread over folds, binary",
    "cv_multi": "spread over folds, classes",
}

COUNTS4 = ["n_view", "n_cart", "n_remove", "n_events"]


def _row(check: str, value: Column, passed: Column | None) -> Column:
    return F.struct(F.lit(check).alias("check"), value.cast("double").alias("value"),
                    (passed if passed is not None else F.lit(None)).cast("boolean").alias("passed"))


def _stack(one_row: DataFrame, rows: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def inv_event_sum(sessions: DataFrame) -> DataFrame:
    """Q1: n_events = n_view + n_cart + n_remove on every row."""
    bad = F.count_if(F.col("n_events") != F.col("n_view") + F.col("n_cart") + F.col("n_remove"))
    a = sessions.agg(bad.alias("v"))
    return _stack(a, [_row(CHECK["event_sum"], F.col("v"), F.col("v") == 0)])


def univariate_auc(sessions: DataFrame, label: str = "purchased", features: list[str] = FEATURE_COLS) -> DataFrame:
    """Q2 (detail): AUC and |corr| of each feature against the target."""
    lg = to_long(sessions, features, keep=[label]).withColumn("label", F.col(label).cast("int"))
    auc = roc_auc(lg, "label", "x", by=["feature"])
    mom = lg.groupBy("feature").agg(F.stddev_pop("x").alias("_sx"), F.stddev_pop("label").alias("_sy"),
                                    F.covar_pop("x", "label").alias("_c"))
    corr = F.when((F.col("_sx") > 0) & (F.col("_sy") > 0),
                  F.abs(F.try_divide(F.col("_c"), F.col("_sx") * F.col("_sy")))).otherwise(F.lit(0.0))
    return auc.join(mom.select("feature", corr.alias("abs_corr")), "feature")


def univariate_auc_check(sessions: DataFrame, label: str = "purchased") -> DataFrame:
    """Q2: the largest univariate AUC stays under 0.99."""
    a = univariate_auc(sessions, label).agg(F.max("roc_auc").alias("v"))
    return _stack(a, [_row(CHECK["auc"], F.col("v"),
                           F.col("v") < MAX_UNIVARIATE_AUC)])


def inv_cat_le_prod(sessions: DataFrame) -> DataFrame:
    """Q3: unique_categories <= unique_products (+1 when n_events = 0)."""
    bad = F.count_if(F.col("unique_categories") >
                     F.col("unique_products") + (F.col("n_events") == 0).cast("int"))
    a = sessions.agg(bad.alias("v"))
    return _stack(a, [_row(CHECK["cat_le_prod"], F.col("v"), F.col("v") == 0)])


def decile_purity(sessions_cat: DataFrame, label: str = "main_cat") -> DataFrame:
    """Q4: no feature decile is > 95 % one class."""
    a = crosstab_purity(sessions_cat, label).agg(F.count_if(F.col("max_purity") > MAX_DECILE_PURITY).alias("v"))
    return _stack(a, [_row(CHECK["purity"], F.col("v"), F.col("v") == 0)])


def range_checks(sessions_all: DataFrame, bounds: dict = ORIGINAL_BOUNDS,
                 share_bounds: dict = ORIGINAL_SHARE_BOUNDS, label: str = "main_cat") -> DataFrame:
    """Q5: session count, purchase rate, category-table size and class shares
    inside declared bounds (parameters; defaults are the original's)."""
    # sessions_cat is sessions_all where the class is known: one pass measures both
    j = sessions_all.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("purchased").cast("double")).alias("pr"),
                         F.count(label).alias("nc"),
                         *[F.avg((F.col(label) == F.lit(k)).cast("double")).alias(f"sh_{i}")
                           for i, k in enumerate(share_bounds)])
    (lo_n, hi_n), (lo_p, hi_p), (lo_c, hi_c) = bounds["n_sessions"], bounds["purchase_rate"], bounds["n_sessions_cat"]
    share_ok = F.lit(True)
    for i, (k, (lo, hi)) in enumerate(share_bounds.items()):
        v = F.coalesce(F.col(f"sh_{i}"), F.lit(0.0))
        share_ok = share_ok & (v >= lo) & (v <= hi)
    return _stack(j, [
        _row(CHECK["n_sessions"], F.col("n"), F.col("n").between(lo_n, hi_n)),
        _row(CHECK["rate"], F.col("pr"), F.col("pr").between(lo_p, hi_p)),
        _row(CHECK["n_cat"], F.col("nc"), F.col("nc").between(lo_c, hi_c)),
        _row(CHECK["shares"], F.col(f"sh_0") if share_bounds else F.lit(None), share_ok),
    ])


def null_free(sessions_all: DataFrame, features: list[str] = FEATURE_COLS, label: str = "main_cat") -> DataFrame:
    """Q6: no NULL/NaN feature value in either table (one pass measures both)."""
    def nulls(where):
        return sum(F.count_if(where & (F.col(f).isNull() | F.isnan(F.col(f).cast("double")))) for f in features)
    j = sessions_all.agg(nulls(F.lit(True)).alias("v"), nulls(F.col(label).isNotNull()).alias("vc"))
    return _stack(j, [_row(CHECK["nulls"], F.col("v") + F.col("vc"),
                           (F.col("v") == 0) & (F.col("vc") == 0))])


def non_negative(sessions: DataFrame) -> DataFrame:
    """Q7: no negative count."""
    a = sessions.agg(F.count_if(F.greatest(*[F.col(c) < 0 for c in COUNTS4])).alias("v"))
    return _stack(a, [_row(CHECK["negative"], F.col("v"), F.col("v") == 0)])


def unique_keys(sessions_all: DataFrame, sessions_cat: DataFrame, key: str = "user_session") -> DataFrame:
    """Session key unique in both tables (count = distinct count)."""
    def dup(df):
        return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("v"))
    j = with_scalars(dup(sessions_all), dup(sessions_cat).withColumnRenamed("v", "vc"))
    return _stack(j, [_row(CHECK["key_all"], F.col("v"), F.col("v") == 0),
                      _row(CHECK["key_cat"], F.col("vc"), F.col("vc") == 0)])


def subset_check(sessions_all: DataFrame, sessions_cat: DataFrame, key: str = "user_session") -> DataFrame:
    """Every sessions_cat key is in sessions_all (anti join is empty)."""
    a = not_in(sessions_cat.select(key), sessions_all.select(key), key).agg(F.count(F.lit(1)).alias("v"))
    return _stack(a, [_row(CHECK["subset"], F.col("v"), F.col("v") == 0)])


def spot_recompute(sessions: DataFrame, events: DataFrame, key: str = "user_session",
                   abs_tol: float = 1e-3, rel_tol: float = 0.01) -> DataFrame:
    """Q9: re-aggregate every session from raw events with an independent plan
    (filter then group, separate target rollup, outer join) and compare field by
    field: integers exactly, floats within abs_tol or rel_tol.
    Returns one row per session with the number of mismatching fields."""
    ev = events.filter(F.col(key).isNotNull())
    pre = ev.filter(~F.col("event_type").eqNullSafe("purchase"))
    t = F.unix_micros(F.col("event_time").cast("timestamp"))
    price = F.nullif(F.col("price").cast("double"), F.lit(float("nan")))
    f = pre.groupBy(key).agg(
        F.count_if(F.col("event_type") == "view").alias("n_view"),
        F.count_if(F.col("event_type") == "cart").alias("n_cart"),
        F.count_if(F.col("event_type") == "remove_from_cart").alias("n_remove"),
        F.count(F.lit(1)).alias("n_events"),
        F.avg(price).alias("avg_price"), F.max(price).alias("max_price"), F.min(price).alias("min_price"),
        F.stddev_samp(price).alias("price_std"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("category_id").alias("unique_categories"),
        F.max(F.col("brand").isNotNull().cast("int")).alias("has_brand"),
        ((F.max(t) - F.min(t)) / 1e6).alias("session_duration_sec"))
    tg = ev.groupBy(key).agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("purchased"))
    manual = tg.join(f, key, "left")
    ints = ["n_view", "n_cart", "n_remove", "n_events", "unique_products", "unique_categories", "has_brand", "purchased"]
    floats = ["avg_price", "max_price", "min_price", "price_std", "session_duration_sec"]
    s = sessions.select(key, *[F.col(c).alias(f"s_{c}") for c in ints + floats])
    j = s.join(manual, key, "left")
    miss = []
    for c in ints:
        miss.append((F.coalesce(F.col(c), F.lit(0)) != F.coalesce(F.col(f"s_{c}"), F.lit(-1))).cast("int"))
    for c in floats:
        m, p = F.coalesce(F.col(c), F.lit(0.0)), F.coalesce(F.col(f"s_{c}").cast("double"), F.lit(float("nan")))
        ok = (F.abs(m - p) <= abs_tol) | ((F.abs(p) > 0) & (F.abs(m - p) / F.abs(p) <= rel_tol))
        miss.append(F.when(ok, 0).otherwise(1))
    return j.select(key, sum(miss).alias("n_mismatch"))


def spot_check(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Q9 as an audit row: sessions with any mismatching field."""
    a = spot_recompute(sessions, events).agg(F.count_if(F.col("n_mismatch") > 0).alias("v"))
    return _stack(a, [_row(CHECK["spot"], F.col("v"), F.col("v") == 0)])


def pure_purchase(sessions: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Q11: purchase-only sessions: count, purchase rate > 0.5 (or none), all
    features except has_brand zero."""
    pure = F.col("n_events") == 0
    nonzero = F.greatest(*[F.col(f) != 0 for f in features if f != "has_brand" and f in sessions.columns])
    a = sessions.agg(F.count_if(pure).alias("n"),
                     F.avg(F.when(pure, F.col("purchased").cast("double"))).alias("pr"),
                     F.count_if(pure & nonzero).alias("nz"))
    return _stack(a, [
        _row(CHECK["pure"], F.coalesce(F.col("pr"), F.lit(1.0)),
             (F.col("n") == 0) | (F.col("pr") > 0.5)),
        _row(CHECK["pure_n"], F.col("n"), None),
        _row(CHECK["pure_nz"], F.col("nz"), None),
    ])


def single_event(sessions: DataFrame) -> DataFrame:
    """Q12: n_events = 1 implies price_std = 0; share of such sessions."""
    one = F.col("n_events") == 1
    a = sessions.agg(F.count_if(one & (F.col("price_std") != 0)).alias("bad"),
                     (F.count_if(one) / F.count(F.lit(1))).alias("share"))
    return _stack(a, [_row(CHECK["single"], F.col("bad"), F.col("bad") == 0),
                      _row(CHECK["single_share"], F.col("share"), None)])


def outlier_sessions(sessions: DataFrame, p: float = OUTLIER_QUANTILE) -> DataFrame:
    """Q13: sessions above the p-quantile of n_events (informational)."""
    a = quantile_cut(sessions, "n_events", p)
    return _stack(a, [_row(CHECK["cut"], F.col("cut"), None),
                      _row(CHECK["above"], F.col("n_above"), None),
                      _row(CHECK["rate_above"], F.col("rate_above"), None),
                      _row(CHECK["rate_all"], F.col("rate_all"), None)])


def negative_price(sessions: DataFrame) -> DataFrame:
    """Q14: sessions with a negative average price (informational)."""
    a = sessions.agg(F.count_if(F.col("avg_price") < 0).alias("v"))
    return _stack(a, [_row(CHECK["neg_price"], F.col("v"), None)])


def purchases_without_category(sessions_all: DataFrame, sessions_cat: DataFrame, key: str = "user_session") -> DataFrame:
    """Purchased sessions missing from sessions_cat."""
    return not_in(sessions_all.filter(F.col("purchased") == 1), sessions_cat.select(key), key)


def weight_ratio(sessions_cat: DataFrame, label: str = "main_cat") -> DataFrame:
    """Q15: balanced sample-weight max/min within [3, 10]."""
    w = class_weights(sessions_cat, label).agg((F.max("weight") / F.min("weight")).alias("v"))
    lo, hi = WEIGHT_RATIO_BOUNDS
    return _stack(w, [_row(CHECK["weights"], F.col("v"), F.col("v").between(lo, hi))])


def dtype_report(sessions: DataFrame, cols=("purchased", "n_events", "avg_price", "user_session")) -> DataFrame:
    """Q16: declared types of key columns as rows (schema metadata only)."""
    types = dict((f.name, f.dataType.simpleString()) for f in sessions.schema.fields)
    return sessions.sparkSession.createDataFrame([(c, types.get(c)) for c in cols], "column string, dtype string")


def table_checks(sessions_all: DataFrame, sessions_cat: DataFrame, bounds: dict = ORIGINAL_BOUNDS,
                 share_bounds: dict = ORIGINAL_SHARE_BOUNDS, features: list[str] = FEATURE_COLS,
                 label: str = "main_cat", key: str = "user_session") -> DataFrame:
    """Q1, Q3, Q5-Q8 (keys), Q11, Q12, Q14 in one aggregate pass over each
    table; same rows as the separate checks."""
    feats = [f for f in features if f in sessions_all.columns]
    nulls = sum(F.count_if(F.col(f).isNull() | F.isnan(F.col(f).cast("double"))) for f in feats)
    pure = F.col("n_events") == 0
    one = F.col("n_events") == 1
    nonzero = F.greatest(*[F.col(f) != 0 for f in feats if f != "has_brand"])
    a = sessions_all.agg(
        F.count_if(F.col("n_events") != F.col("n_view") + F.col("n_cart") + F.col("n_remove")).alias("q1"),
        F.count_if(F.col("unique_categories") > F.col("unique_products") + pure.cast("int")).alias("q3"),
        F.count(F.lit(1)).alias("n"), F.avg(F.col("purchased").cast("double")).alias("pr"),
        nulls.alias("nul"), F.count_if(F.greatest(*[F.col(c) < 0 for c in COUNTS4])).alias("neg"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("dup"),
        F.count_if(pure).alias("pn"), F.avg(F.when(pure, F.col("purchased").cast("double"))).alias("ppr"),
        F.count_if(pure & nonzero).alias("pnz"),
        F.count_if(one & (F.col("price_std") != 0)).alias("bad1"), (F.count_if(one) / F.count(F.lit(1))).alias("sh1"),
        F.count_if(F.col("avg_price") < 0).alias("negp"))
    cnul = sum(F.count_if(F.col(f).isNull() | F.isnan(F.col(f).cast("double"))) for f in feats)
    c = sessions_cat.agg(F.count(F.lit(1)).alias("nc"), cnul.alias("vc"),
                         (F.count(F.lit(1)) - F.count_distinct(key)).alias("dupc"),
                         *[F.avg((F.col(label) == F.lit(k)).cast("double")).alias(f"sh_{i}")
                           for i, k in enumerate(share_bounds)])
    j = with_scalars(a, c)
    (lo_n, hi_n), (lo_p, hi_p), (lo_c, hi_c) = bounds["n_sessions"], bounds["purchase_rate"], bounds["n_sessions_cat"]
    share_ok = F.lit(True)
    for i, (_, (lo, hi)) in enumerate(share_bounds.items()):
        v = F.coalesce(F.col(f"sh_{i}"), F.lit(0.0))
        share_ok = share_ok & (v >= lo) & (v <= hi)
    q = F.col
    return _stack(j, [
        _row(CHECK["event_sum"], q("q1"), q("q1") == 0),
        _row(CHECK["cat_le_prod"], q("q3"), q("q3") == 0),
        _row(CHECK["n_sessions"], q("n"), q("n").between(lo_n, hi_n)),
        _row(CHECK["rate"], q("pr"), q("pr").between(lo_p, hi_p)),
        _row(CHECK["n_cat"], q("nc"), q("nc").between(lo_c, hi_c)),
        _row(CHECK["shares"], q("sh_0") if share_bounds else F.lit(None), share_ok),
        _row(CHECK["nulls"], q("nul") + q("vc"), (q("nul") == 0) & (q("vc") == 0)),
        _row(CHECK["negative"], q("neg"), q("neg") == 0),
        _row(CHECK["key_all"], q("dup"), q("dup") == 0),
        _row(CHECK["key_cat"], q("dupc"), q("dupc") == 0),
        _row(CHECK["pure"], F.coalesce(q("ppr"), F.lit(1.0)), (q("pn") == 0) | (q("ppr") > 0.5)),
        _row(CHECK["pure_n"], q("pn"), None),
        _row(CHECK["pure_nz"], q("pnz"), None),
        _row(CHECK["single"], q("bad1"), q("bad1") == 0),
        _row(CHECK["single_share"], q("sh1"), None),
        _row(CHECK["neg_price"], q("negp"), None),
    ])


def audit_report(sessions_all: DataFrame, sessions_cat: DataFrame, events: DataFrame | None = None,
                 cv_checks: DataFrame | None = None, bounds: dict = ORIGINAL_BOUNDS,
                 share_bounds: dict = ORIGINAL_SHARE_BOUNDS) -> DataFrame:
    """Q17: union of all checks plus a summary row (passed / graded checks).
    Pass materialised tables: each check re-reads them."""
    parts = [table_checks(sessions_all, sessions_cat, bounds, share_bounds), univariate_auc_check(sessions_all),
             decile_purity(sessions_cat), subset_check(sessions_all, sessions_cat)]
    if events is not None:
        parts.append(spot_check(sessions_all, events))
    if cv_checks is not None:
        parts.append(cv_checks.select("check", F.col("value").cast("double"), F.col("passed").cast("boolean")))
    parts += [outlier_sessions(sessions_all), weight_ratio(sessions_cat)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per check (bounded by code): written once, so the summary row
    # does not run every check a second time
    out = written(out, "audit")
    summary = out.agg(F.count_if(F.col("passed")).alias("np"), F.count(F.col("passed")).alias("nc"))
    return out.unionByName(_stack(summary, [_row(CHECK["passed"], F.col("np"), F.col("np") == F.col("nc"))]))
