"""Evaluation operators (E1-E14) over a score table.

Binary score table: (label 0/1, proba double, pred 0/1).  Multi-class:
(label string, pred string).  Curves, AUC and AP are exact and tie-aware:
rows collapse to one row per distinct score and running counts come from the
two-level prefix sum, never from a single-task global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.constants import THRESHOLD
from sessionlab.functions.exprs import safe_div
from sessionlab.operators.joins import with_scalars
from sessionlab.operators.prefix import running_sums, with_previous


def threshold_predict(scores: DataFrame, proba: str = "proba", threshold: float = THRESHOLD,
                      out: str = "pred") -> DataFrame:
    """pred = 1 where proba >= threshold."""
    return scores.withColumn(out, (F.col(proba) >= F.lit(threshold)).cast("int"))


# --- binary -------------------------------------------------------------------

def confusion_binary(scores: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """Tn / fp / fn / tp, n_test and positives."""
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count(F.lit(1)).alias("n_test"), F.count_if(y == 1).alias("n_test_positive")]
    return scores.groupBy(*(by or [])).agg(*aggs)


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    f1 = safe_div(2 * precision * recall, precision + recall)
    return precision, recall, f1


def binary_metrics(scores: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    """Precision (0 when undefined), recall, F1 from the confusion counts."""
    c = confusion_binary(scores, label, pred, by)
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(*(by or []), p.alias("precision"), r.alias("recall"), f.alias("f1"))


def _score_counts(scores: DataFrame, label: str, proba: str, by: list[str]) -> DataFrame:
    per = scores.groupBy(*by, proba).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                         F.count_if(F.col(label) != 1).alias("neg"))
    return running_sums(per, proba, ["pos", "neg"], by)


def roc_auc(scores: DataFrame, label: str = "label", proba: str = "proba", by: list[str] | None = None) -> DataFrame:
    """Exact AUC with ties counted 1/2 (NULL when a class is absent)."""
    by = by or []
    rs = _score_counts(scores, label, proba, by)
    neg_lt = F.col("neg_le") - F.col("neg")
    agg = rs.groupBy(*by).agg(F.sum(F.col("pos") * (neg_lt + F.col("neg") / 2.0)).alias("_u"),
                              F.max("pos_tot").alias("_p"), F.max("neg_tot").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n")))
    return agg.select(*by, auc.alias("roc_auc"))


def roc_curve(scores: DataFrame, label: str = "label", proba: str = "proba",
              drop_intermediate: bool = True) -> DataFrame:
    """(fpr, tpr) per distinct score (score >= threshold) plus the origin
    with a NULL threshold.  With ``drop_intermediate`` a point is kept only
    where the curve bends: the next point's (positives, negatives) step differs
    from this point's; the highest and lowest thresholds always stay."""
    rs = _score_counts(scores, label, proba, [])
    if drop_intermediate:
        rs = with_previous(rs, proba, ["pos", "neg"])
        rs = with_scalars(rs, rs.agg(F.max(proba).alias("_top_score")))
        keep = (F.col("prev_pos").isNull() | (F.col(proba) == F.col("_top_score"))
                | (F.col("prev_pos") != F.col("pos")) | (F.col("prev_neg") != F.col("neg")))
        rs = rs.filter(keep)
    tps = F.col("pos_tot") - F.col("pos_le") + F.col("pos")
    fps = F.col("neg_tot") - F.col("neg_le") + F.col("neg")
    pts = rs.select(F.col(proba).cast("double").alias("threshold"),
                    safe_div(fps, F.col("neg_tot"), None).alias("fpr"), safe_div(tps, F.col("pos_tot"), None).alias("tpr"))
    origin = scores.agg(F.count_if(F.col(label) == 1).alias("_p")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_curve(scores: DataFrame, label: str = "label", proba: str = "proba") -> DataFrame:
    """E5: (precision, recall) per distinct score plus the (1, 0) end point."""
    rs = _score_counts(scores, label, proba, [])
    tps = F.col("pos_tot") - F.col("pos_le") + F.col("pos")
    fps = F.col("neg_tot") - F.col("neg_le") + F.col("neg")
    pts = rs.select(F.col(proba).cast("double").alias("threshold"), safe_div(tps, tps + fps).alias("precision"),
                    safe_div(tps, F.col("pos_tot"), None).alias("recall"))
    end = scores.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(scores: DataFrame, label: str = "label", proba: str = "proba",
                      by: list[str] | None = None) -> DataFrame:
    """Step-wise AP = sum over thresholds of (R_n - R_{n-1}) * P_n, plus
    the base rate."""
    by = by or []
    rs = _score_counts(scores, label, proba, by)
    tps = F.col("pos_tot") - F.col("pos_le") + F.col("pos")
    fps = F.col("neg_tot") - F.col("neg_le") + F.col("neg")
    agg = rs.groupBy(*by).agg(F.sum(F.col("pos") * safe_div(tps, tps + fps)).alias("_s"),
                              F.max("pos_tot").alias("_p"), F.max("neg_tot").alias("_n"))
    return agg.select(*by, safe_div(F.col("_s"), F.col("_p"), None).alias("average_precision"),
                      (F.col("_p") / (F.col("_p") + F.col("_n"))).alias("base_rate"))


# --- multi-class -------------------------------------------------------------

def confusion_multiclass(scores: DataFrame, label: str = "label", pred: str = "pred",
                         by: list[str] | None = None) -> DataFrame:
    """K x k counts over the sorted union of true and predicted labels,
    zero cells included.  The label set is bounded by the classes; the full
    grid is generated from it with two explodes, then the counts join in."""
    by = by or []
    counts = scores.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.select(*by, F.col(label).alias("_l")).unionByName(counts.select(*by, F.col(pred).alias("_l")))
    grid = labels.groupBy(*by).agg(F.array_sort(F.collect_set("_l")).alias("_ls"))
    grid = grid.select(*by, F.explode("_ls").alias("true_label"), "_ls") \
               .select(*by, "true_label", F.explode("_ls").alias("pred_label"))
    c = counts.select(*by, F.col(label).alias("true_label"), F.col(pred).alias("pred_label"), "n")
    return grid.join(c, [*by, "true_label", "pred_label"], "left") \
               .select(*by, "true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_normalized(confusion: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row-normalised confusion matrix, 0 for empty rows."""
    by = by or []
    row = F.sum("n").over(Window.partitionBy(*by, "true_label"))  # k cells per row
    return confusion.select(*by, "true_label", "pred_label", safe_div(F.col("n"), row).alias("share"))


def per_class_prf(confusion: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision / recall / F1 / support per class from the matrix, in one
    pass: each cell counts toward its true label's support (and tp on the
    diagonal) and toward its predicted label's predicted total."""
    by = by or []
    n, zero = F.col("n").cast("bigint"), F.lit(0).cast("bigint")
    diag = F.when(F.col("true_label") == F.col("pred_label"), n).otherwise(zero)
    cell = F.explode(F.array(
        F.struct(F.col("true_label").alias("label"), n.alias("sup"), zero.alias("prd"), diag.alias("tp")),
        F.struct(F.col("pred_label").alias("label"), zero.alias("sup"), n.alias("prd"), zero.alias("tp"))))
    j = confusion.select(*by, cell.alias("_c")).select(*by, "_c.*").groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("sup").alias("support"), F.sum("prd").alias("predicted"))
    p = safe_div(F.col("tp"), F.col("predicted"))
    r = safe_div(F.col("tp"), F.col("support"))
    return j.select(*by, "label", p.alias("precision"), r.alias("recall"),
                    safe_div(2 * p * r, p + r).alias("f1"), F.col("support").cast("bigint").alias("support"))


def macro_weighted_f1(per_class: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Macro and support-weighted F1 (plus accuracy)."""
    by = by or []
    return per_class.groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def classification_report(confusion: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Long report (label, precision, recall, f1, support) with the
    'accuracy', 'macro avg' and 'weighted avg' rows."""
    by = by or []
    confusion = written(confusion, "confusion")     # classes squared: read by every block below
    pc = per_class_prf(confusion, by)
    acc = confusion.groupBy(*by).agg(F.sum(F.when(F.col("true_label") == F.col("pred_label"), F.col("n"))).alias("_c"),
                                     F.sum("n").alias("_s"))
    macro = pc.groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                                F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = pc.groupBy(*by).agg(*[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m)
                                     for m in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    accuracy = acc.select(*by, (F.col("_c") / F.col("_s")).alias("f1"), F.col("_s").alias("support")) \
                  .select(*by, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                          F.lit(None).cast("double").alias("recall"), "f1", "support")
    return pc.unionByName(accuracy) \
             .unionByName(macro.select(*by, F.lit("macro avg").alias("label"), "precision", "recall", "f1", "support")) \
             .unionByName(weighted.select(*by, F.lit("weighted avg").alias("label"), "precision", "recall", "f1",
                                          "support")) \
             .withColumn("support", F.col("support").cast("bigint"))


# --- comparison tables --------------------------------------------------------

def model_comparison(metrics_long: DataFrame, models: list[str], metrics: list[str], digits: int = 4) -> DataFrame:
    """Long (model, metric, value) -> one row per metric, a column per
    model, rounded."""
    m = metrics_long.filter(F.col("metric").isin(metrics))
    wide = m.groupBy("metric").pivot("model", models).agg(F.first("value"))
    return wide.select("metric", *[F.round(F.col(x), digits).alias(x) for x in models])


def split_comparison(metrics_long: DataFrame, left: str = "random", right: str = "temporal") -> DataFrame:
    """(run, model, metric, label, value) for two runs -> side by side
    with the delta right - left (self-join on model/metric/label)."""
    keys = ["model", "metric", "label"]
    a = metrics_long.filter(F.col("run") == left).select(*[F.col(k).alias(f"a_{k}") for k in keys],
                                                         F.col("value").alias(left))
    b = metrics_long.filter(F.col("run") == right).select(*[F.col(k).alias(f"b_{k}") for k in keys],
                                                          F.col("value").alias(right))
    cond = [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys]
    j = a.join(b, cond, "full_outer")
    return j.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], left, right,
                    (F.col(right) - F.col(left)).alias("delta"))


def cv_summary(fold_metrics: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """Fold metrics (fold, metric, value) -> mean, population std and
    whether std stays under its bound."""
    s = fold_metrics.groupBy("metric").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("value").alias("mean"),
                                           F.stddev_pop("value").alias("std"))
    bound = F.create_map(*[x for kv in bounds.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
    return s.withColumn("bound", bound[F.col("metric")]).withColumn("stable", F.col("std") < F.col("bound"))
