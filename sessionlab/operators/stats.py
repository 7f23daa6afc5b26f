"""Session-table statistics.

Exact quantiles never gather a group into one task: values are collapsed to
(value, count), running counts come from the two-level prefix sum, and the
rows that straddle the wanted rank are picked out (linear interpolation, as
pandas/NumPy do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.constants import (DECILES, FEATURE_COLS, HIST_BINS, HIST_FEATURES, MEDIAN_FEATURES,
                                  OUTLIER_QUANTILE)
from sessionlab.functions.exprs import safe_div
from sessionlab.operators.features import to_long
from sessionlab.operators.joins import bounded_join, lookup_join, with_scalars
from sessionlab.operators.prefix import running_sums


def purchase_rate(sessions: DataFrame, label: str = "purchased") -> DataFrame:
    """Sessions, purchased sessions and purchase rate."""
    return sessions.agg(F.count(F.lit(1)).alias("n_sessions"),
                        F.sum(F.col(label).cast("bigint")).alias("n_purchased"),
                        F.avg(F.col(label).cast("double")).alias("purchase_rate"))


def main_cat_distribution(sessions: DataFrame, col: str = "main_cat") -> DataFrame:
    """Count per class incl. NULL, and share among non-NULL rows."""
    counts = sessions.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: a window over the whole (tiny) class table
    nn = F.sum(F.when(F.col(col).isNotNull(), F.col("n"))).over(Window.partitionBy())
    return counts.select(col, "n", F.when(F.col(col).isNotNull(), F.col("n") / nn).alias("share"))


def exact_quantiles(long_df: DataFrame, groups: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per ``groups``
    (NULLs ignored) -> (groups..., p, q)."""
    counted = long_df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    rs = running_sums(counted, value, ["_c"], groups)
    rs = rs.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    pos = F.col("_p") * (F.col("_c_tot") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    lt = F.col("_c_le") - F.col("_c")
    hit_lo = (lt <= lo) & (lo < F.col("_c_le"))
    hit_hi = (lt <= hi) & (hi < F.col("_c_le"))
    picked = rs.filter(hit_lo | hit_hi).select(
        *groups, "_p", F.when(hit_lo, F.col(value)).alias("_vlo"), F.when(hit_hi, F.col(value)).alias("_vhi"),
        (pos - lo).alias("_frac"))
    agg = picked.groupBy(*groups, "_p").agg(F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
                                            F.max("_frac").alias("_frac"))
    q = F.col("_vlo").cast("double") + F.col("_frac") * (F.col("_vhi").cast("double") - F.col("_vlo").cast("double"))
    return agg.select(*groups, F.col("_p").alias("p"), q.alias("q"))


def feature_summary(sessions: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Mean / median / std (sample) / min / max per feature."""
    lg = to_long(sessions, features)
    mom = lg.groupBy("feature").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                    F.min("x").alias("min"), F.max("x").alias("max"))
    med = exact_quantiles(lg, ["feature"], "x", [0.5]).select("feature", F.col("q").alias("median"))
    return mom.join(med, "feature", "left").select("feature", "mean", "median", "std", "min", "max")


def class_means(sessions: DataFrame, label: str = "purchased", features: list[str] = FEATURE_COLS) -> DataFrame:
    """Feature means by binary class and purchase/no-purchase ratio."""
    lg = to_long(sessions, features, keep=[label])
    out = lg.groupBy("feature").agg(F.avg(F.when(F.col(label) == 0, F.col("x"))).alias("no_purchase"),
                                    F.avg(F.when(F.col(label) == 1, F.col("x"))).alias("purchase"))
    return out.withColumn("ratio", safe_div(F.col("purchase"), F.col("no_purchase"), default=None))


def class_medians(sessions: DataFrame, label: str = "purchased", features: list[str] = MEDIAN_FEATURES) -> DataFrame:
    """Exact medians of features by class (long: feature, class, median)."""
    lg = to_long(sessions, features, keep=[label])
    return exact_quantiles(lg, ["feature", label], "x", [0.5]).select("feature", label, F.col("q").alias("median"))


def feature_correlation(sessions: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Pearson matrix in long form (f1, f2, corr); NULL where a column is
    constant (S15).  One aggregate pass computes every pair."""
    aggs = []
    for i, a in enumerate(features):
        aggs.append(F.stddev_samp(F.col(a).cast("double")).alias(f"s__{a}"))
        for b in features[i + 1:]:
            aggs.append(F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c__{a}__{b}"))
    row = sessions.agg(*aggs)
    cells = []
    for a in features:
        for b in features:
            if a == b:
                v = F.when(F.col(f"s__{a}") > 0, F.lit(1.0))
            else:
                x, y = (a, b) if features.index(a) < features.index(b) else (b, a)
                v = F.when((F.col(f"s__{x}") > 0) & (F.col(f"s__{y}") > 0),
                           F.try_divide(F.col(f"c__{x}__{y}"), F.col(f"s__{x}") * F.col(f"s__{y}")))
            cells.append(F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), v.alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def null_audit(sessions: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """NULL (or NaN) count per feature, long form."""
    lg = to_long(sessions, features)
    return lg.groupBy("feature").agg(
        F.count_if(F.col("x").isNull() | F.isnan("x")).cast("bigint").alias("n_null"))


def month_counts(months: DataFrame, col: str = "month") -> DataFrame:
    """Sessions per month."""
    return months.groupBy(col).agg(F.count(F.lit(1)).alias("n_sessions"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()  # one row per class
    n, k = F.sum("n_c").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    """Attach the balanced weight as a column (class table: one row per class)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return lookup_join(df, w, label, "inner", cache=True)  # one row per class, measured


def scale_pos_weight(df: DataFrame, label: str = "purchased") -> DataFrame:
    """n_neg / max(n_pos, 1)."""
    return df.agg(F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")) \
        .withColumn("scale_pos_weight", F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)))


def qcut_bins(sessions: DataFrame, features: list[str], q: int = DECILES, keep: list[str] | None = None) -> DataFrame:
    """Pandas ``qcut(q, duplicates='drop')`` bins in long form.

    Edges are exact linear-interpolated quantiles; duplicate edges dropped;
    bins are right-closed and the lowest edge is included, so
    bin = number of edges < x, at least 1.  The edge table has q+1 rows per
    feature and is broadcast after its size check."""
    lg = to_long(sessions, features, keep=keep)
    qs = exact_quantiles(lg, ["feature"], "x", [i / q for i in range(q + 1)])
    edges = qs.groupBy("feature").agg(F.array_sort(F.collect_set("q")).alias("_edges"))
    j = bounded_join(lg, edges, "feature", "inner")  # one row per feature
    nb = F.size(F.filter("_edges", lambda e: e < F.col("x")))
    return j.withColumn("bin", F.greatest(nb, F.lit(1))).drop("_edges")


def crosstab_purity(sessions: DataFrame, label: str = "main_cat", features: list[str] = FEATURE_COLS,
                    q: int = DECILES) -> DataFrame:
    """Row-normalised (bin x class) table per feature -> max cell."""
    b = qcut_bins(sessions.filter(F.col(label).isNotNull()), features, q, keep=[label])
    cell = b.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("n"))
    tot = cell.groupBy("feature", "bin").agg(F.sum("n").alias("_t"))
    share = cell.join(tot, ["feature", "bin"]).select("feature", (F.col("n") / F.col("_t")).alias("share"))
    return share.groupBy("feature").agg(F.max("share").alias("max_purity"))


def quantile_cut(sessions: DataFrame, col: str = "n_events", p: float = OUTLIER_QUANTILE,
                 label: str = "purchased") -> DataFrame:
    """P-quantile of ``col``, sessions above it and their purchase rate
    next to the global rate."""
    lg = sessions.select(F.lit(col).alias("feature"), F.col(col).cast("double").alias("x"))
    cut = exact_quantiles(lg, ["feature"], "x", [p]).select(F.col("q").alias("cut"))
    j = with_scalars(sessions, cut)
    return j.agg(F.max("cut").alias("cut"),
                 F.count_if(F.col(col) > F.col("cut")).cast("bigint").alias("n_above"),
                 F.avg(F.when(F.col(col) > F.col("cut"), F.col(label).cast("double"))).alias("rate_above"),
                 F.avg(F.col(label).cast("double")).alias("rate_all"))


def log1p_hist(sessions: DataFrame, features: list[str] = HIST_FEATURES, bins: int = HIST_BINS) -> DataFrame:
    """log1p histograms: drop NULL/inf/negative values, 60 equal bins
    between min and max (last edge inclusive), empty ones too -> (feature, bin,
    lo, n)."""
    lg = to_long(sessions, features)
    lg = lg.filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf")) & (F.col("x") >= 0)) \
           .withColumn("x", F.log1p("x"))
    rng = lg.groupBy("feature").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    j = bounded_join(lg, rng, "feature", "inner")  # one row per feature
    width = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("x") - F.col("_lo")) / width)).otherwise(F.lit(0))
    j = j.withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int"))
    counts = j.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))  # bins x features
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("lo"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"))
