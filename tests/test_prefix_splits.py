"""Two-level prefix sums and deterministic splits against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlab.operators.prefix import running_sums
from sessionlab.operators import splits as D
from sessionlab.operators import metrics as E


def test_running_sums_match_brute_force(spark):
    rnd = random.Random(1)
    vals = [rnd.choice([0.0, -1.5, 2.0, 1e-9, 3.25]) if rnd.random() < 0.3 else round(rnd.uniform(-50, 50), 2)
            for _ in range(3000)]
    rows = [(g, v, rnd.randint(0, 3)) for g, v in zip([rnd.choice("ab") for _ in vals], vals)]
    df = spark.createDataFrame(rows, "g string, v double, c int").groupBy("g", "v").agg(F.sum("c").alias("c"))
    out = {(r.g, r.v): (r.c_le, r.c_tot) for r in running_sums(df, "v", ["c"], ["g"]).collect()}
    agg = {}
    for g, v, c in rows:
        agg[(g, v)] = agg.get((g, v), 0) + c
    for (g, v), (le, tot) in out.items():
        assert le == sum(c for (g2, v2), c in agg.items() if g2 == g and v2 <= v)
        assert tot == sum(c for (g2, _), c in agg.items() if g2 == g)


def _auc_brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _ap_brute(pairs):
    P = sum(y for y, _ in pairs)
    ap = 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        sel = [y for y, s in pairs if s >= t]
        new_pos = sum(y for y, s in pairs if s == t)
        ap += new_pos / P * (sum(sel) / len(sel))
    return ap


def test_auc_and_ap_with_ties(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 1), rnd.choice([0.1, 0.2, 0.2, 0.5, 0.9, rnd.random()])) for _ in range(400)]
    df = spark.createDataFrame(pairs, "label int, proba double")
    assert E.roc_auc(df).first().roc_auc == pytest.approx(_auc_brute(pairs), abs=1e-12)
    assert E.average_precision(df).first().average_precision == pytest.approx(_ap_brute(pairs), abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "label int, proba double")
    assert E.roc_auc(df).first().roc_auc is None


def test_confusion_multiclass_has_zero_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "label string, pred string")
    cm = {(r.true_label, r.pred_label): r.n for r in E.confusion_multiclass(df).collect()}
    assert len(cm) == 9 and cm[("a", "a")] == 1 and cm[("b", "b")] == 0
    rep = {r.label: r for r in E.classification_report(E.confusion_multiclass(df)).collect()}
    assert rep["accuracy"].f1 == pytest.approx(2 / 3)
    assert rep["b"].f1 == 0.0 and rep["a"].precision == 0.5


def test_split_deterministic_and_stratified(spark):
    rows = [(f"k{i}", 1 if i % 7 == 0 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "user_session string, y int")
    a = {r.user_session: r.split for r in D.stratified_split(df, "y").collect()}
    b = {r.user_session: r.split for r in D.stratified_split(df.repartition(13), "y").collect()}
    assert a == b
    n_test = sum(1 for v in a.values() if v == "test")
    assert n_test == 400  # ceil(0.2 * 2000)
    pos_test = sum(1 for k, v in a.items() if v == "test" and int(k[1:]) % 7 == 0)
    assert pos_test in (57, 58)  # 286 positives * 0.2
    folds = D.stratified_kfold(df, "y").groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [400] * 5


def test_quotas_largest_remainder(spark):
    rows = [("a",)] * 3 + [("b",)] * 3 + [("c",)] * 4
    df = spark.createDataFrame([(f"k{i}", r[0]) for i, r in enumerate(rows)], "user_session string, y string")
    q = {r.y: r.n_test for r in D.split_quotas(df, "y").collect()}
    assert sum(q.values()) == 2


def test_roc_and_pr_curves_brute_force(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 1), rnd.choice([0.05, 0.3, 0.3, 0.7, 1.0, -2.0])) for _ in range(300)]
    df = spark.createDataFrame(pairs, "label int, proba double")
    P = sum(y for y, _ in pairs)
    N = len(pairs) - P
    roc = {r.threshold: (r.fpr, r.tpr) for r in E.roc_curve(df).collect()}
    pr = {r.threshold: (r.precision, r.recall) for r in E.pr_curve(df).collect()}
    for t in {s for _, s in pairs}:
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y == 0)
        assert roc[t] == pytest.approx((fp / N, tp / P))
        assert pr[t] == pytest.approx((tp / (tp + fp), tp / P))
    assert roc[None] == (0.0, 0.0) and pr[None] == (1.0, 0.0)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from sessionlab.operators.stats import exact_quantiles
    rnd = random.Random(2)
    xs = [float(rnd.choice([1, 2, 2, 3, 10, 10, 10, 55])) + rnd.random() * (i % 3 == 0) for i in range(501)]
    df = spark.createDataFrame([("f", x) for x in xs], "feature string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r.p: r.q for r in exact_quantiles(df, ["feature"], "x", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)


def test_results_do_not_depend_on_partitioning(spark):
    """Ranks, running sums and session numbers are identical for any shuffle
    partition count (order keys are data, not task order)."""
    rnd = random.Random(4)
    rows = [(f"k{i}", rnd.randint(0, 2), rnd.choice([0.1, 0.5, 0.5, rnd.random()])) for i in range(1500)]
    df = spark.createDataFrame(rows, "user_session string, y int, proba double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("3", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            ranks = {r.user_session: r.rank for r in D.class_rank(df.repartition(int(n)), "y").collect()}
            scores = df.withColumn("label", (F.col("y") == 1).cast("int"))
            auc = E.roc_auc(scores).first().roc_auc
            out.append((ranks, auc))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def _roc_dropped_brute(pairs):
    """Distinct thresholds (descending) with the original's point dropping."""
    ts = sorted({s for _, s in pairs}, reverse=True)
    inc = [(sum(1 for y, s in pairs if s == t and y == 1), sum(1 for y, s in pairs if s == t and y == 0)) for t in ts]
    keep = [i for i in range(len(ts)) if i in (0, len(ts) - 1) or inc[i + 1] != inc[i]]
    return {ts[i] for i in keep}


def test_roc_curve_drops_collinear_points(spark):
    rnd = random.Random(21)
    pairs = [(rnd.randint(0, 1), float(rnd.randint(0, 40))) for _ in range(200)]
    pairs += [(1, 100.0 + i) for i in range(5)] + [(0, -1.0 - i) for i in range(5)]  # collinear runs
    df = spark.createDataFrame(pairs, "label int, proba double")
    got = {r.threshold for r in E.roc_curve(df).collect() if r.threshold is not None}
    assert got == _roc_dropped_brute(pairs)
    full = {r.threshold for r in E.roc_curve(df, drop_intermediate=False).collect() if r.threshold is not None}
    assert full == {s for _, s in pairs} and got < full


def test_ranges_follow_the_data(spark):
    """A million distinct scores in [0.9, 1) are dealt out evenly."""
    from sessionlab.operators.prefix import in_ranges
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1_000_000).select((0.9 + F.col("id") * 1e-7).alias("x"))
        n = [r["count"] for r in in_ranges(df, "x", []).groupBy("_b").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(n) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(n) < 3 * sum(n) / len(n)
