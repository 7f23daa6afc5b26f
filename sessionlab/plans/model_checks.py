"""Checks of the fitted models as registered queries: rows (item, value) that follow from the tables
alone, whatever the model learned, so SQL states them without a model.

The linear models are checked at their optimum (the gradient over the exported coefficients is
zero), the boosted ones and the jobs by what every scoring must keep: row and class counts,
thresholds, probabilities that sum to one, metric identities, equal results after loading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab import jobs as JOBS
from sessionlab.constants import FEATURE_COLS
from sessionlab.functions.exprs import r6
from sessionlab.operators import models as M
from sessionlab.plans import sql as X
from sessionlab.plans.registry import _MONTHS_SQL, _all_trained, _feats, _feats_cat, _split_frames, _split_sql, _temporal, _trained, register
from sessionlab.sources import sinks as SINK

W = X.with_
_BIN = W(*X.BASE_F) + _split_sql("purchased", "feats") + ", test AS (SELECT purchased FROM split WHERE split = 'test')"
_MULTI = W(*X.BASE_F) + _split_sql("main_cat", "feats_cat") + ", test AS (SELECT main_cat FROM split WHERE split = 'test')"


def _zero(c: Column) -> Column:
    """Rounded, without a negative zero."""
    return F.round(c, 2) + F.lit(0.0)


def _items(df: DataFrame, **values: Column) -> DataFrame:
    """One row (item, value) for each aggregate of ``df``."""
    one = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("item"), F.col(k).alias("value")) for k in values])
    return one.select(F.explode(pairs).alias("p")).select("p.item", r6("p.value").alias("value"))


def _sql(base: str, **values: str) -> str:
    """The same rows from SQL: item -> scalar expression, or one over ``test``."""
    return base + " " + " UNION ALL ".join(f"SELECT '{k}' AS item, CAST({v} AS DOUBLE) AS value" for k, v in values.items())


def _count(where: str = "true", src: str = "test") -> str:
    return f"(SELECT count(*) FROM {src} WHERE {where})"


# --- M3, M5: the optimum of a penalised linear model is where its gradient vanishes

@register("logreg_binary_check", "SELECT unnest([" + ", ".join(f"'{f}'" for f in [*FEATURE_COLS, "intercept"]) + "]) AS term, CAST(0 AS DOUBLE) AS gradient",
          fits=True)
def q_logreg_binary(spark: SparkSession, d: str) -> DataFrame:
    rows = M.training_frame(M.prepare_binary(_split_frames(spark, d, "purchased")[0]))
    reg = M.regularisation(rows)
    table = M.linear_table(spark, M.logreg_binary(reg=reg).fit(rows))
    return M.linear_gradient(table, rows, reg).select("term", _zero(F.col("gradient")).alias("gradient"))


@register("logreg_multiclass_check", W(*X.BASE_F) + _split_sql("main_cat", "feats_cat")
          + "SELECT DISTINCT main_cat AS class, t.term, CAST(0 AS DOUBLE) AS gradient FROM split, (SELECT unnest(["
          + ", ".join(f"'{f}'" for f in [*FEATURE_COLS, "intercept"]) + "]) AS term) t WHERE split = 'train'", fits=True)
def q_logreg_multiclass(spark: SparkSession, d: str) -> DataFrame:
    rows = M.training_frame(M.prepare_multiclass(_split_frames(spark, d, "main_cat")[0]), ("main_cat",))
    reg = M.regularisation(rows)
    table = M.linear_table(spark, M.fit_multiclass(M.logreg_multiclass(reg=reg), rows))
    return M.linear_gradient(table, rows, reg).select("class", "term", _zero(F.col("gradient")).alias("gradient"))


# --- M4, M6, M7: scores of the saved models

@register("boosted_binary_check", _sql(_BIN, n=_count(), n_positive=_count("purchased = 1"), outside="0", off_threshold="0"), fits=True)
def q_boosted_binary(spark: SparkSession, d: str) -> DataFrame:
    sc = JOBS.binary_scores(_trained(spark, d, "binary")[0], _feats(spark, d))
    return _items(sc, n=F.count(F.lit(1)), n_positive=F.count_if(F.col("label") == 1),
                  outside=F.count_if(~F.col("proba").between(0, 1)), off_threshold=F.count_if((F.col("proba") >= 0.5) != (F.col("pred") == 1)))


@register("boosted_multiclass_check", _MULTI + " SELECT main_cat AS label, count(*) AS n, count(*) AS n_known_class FROM test GROUP BY main_cat", fits=True)
def q_boosted_multiclass(spark: SparkSession, d: str) -> DataFrame:
    path = _trained(spark, d, "multiclass")[0]
    known = M.class_names(M.load_model(path))
    return (JOBS.multiclass_scores(path, _feats_cat(spark, d)).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pred").isin(known) & F.col("proba").between(1 / (len(known) + 1), 1)).alias("n_known_class")))


@register("score_sessions_check", _sql(W(*X.BASE_F), n=_count(src="feats"), n_positive=_count("purchased = 1", "feats"), off_threshold="0",
                                       n_multi=_count(src="feats"), off_one="0", classes="(SELECT count(DISTINCT main_cat) FROM feats_cat)"), fits=True)
def q_score_sessions(spark: SparkSession, d: str) -> DataFrame:
    f = _feats(spark, d)
    _all_trained(spark, d)
    sc = M.score_binary(M.load_model(_trained(spark, d, "binary")[0]), JOBS._with_label(f))
    many = M.class_probabilities(M.load_model(_trained(spark, d, "multiclass")[0]), f)
    total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
    return _items(sc, n=F.count(F.lit(1)), n_positive=F.count_if(F.col("label") == 1),
                  off_threshold=F.count_if((F.col("proba") >= 0.5) != (F.col("pred") == 1))).unionByName(
        _items(many, n_multi=F.count(F.lit(1)), off_one=F.count_if(F.abs(total - 1) > 1e-9), classes=F.max(F.size("proba"))))


# --- M8, D9, A11: importances and what is saved

@register("feature_importance_check", _sql("", n="14", total="1", negative="0", unknown="0"), fits=True)
def q_feature_importance(spark: SparkSession, d: str) -> DataFrame:
    t = M.importance_table(spark, M.load_model(_trained(spark, d, "binary")[0]))
    return _items(t, n=F.count_distinct("feature"), total=F.sum("importance"), negative=F.count_if(F.col("importance") < 0),
                  unknown=F.count_if(~F.col("feature").isin(FEATURE_COLS)))


@register("top_importance_check", _sql("", n="5", left_out_above="0"), fits=True)
def q_top_importance(spark: SparkSession, d: str) -> DataFrame:
    model = M.load_model(_trained(spark, d, "binary")[0])
    top, whole = M.importance_table(spark, model, top=5), M.importance_table(spark, model)
    least = top.agg(F.min("importance").alias("m")).scalar()
    rest = whole.join(top.select("feature"), "feature", "left_anti")
    return _items(top, n=F.count(F.lit(1))).unionByName(_items(rest.filter(F.col("importance") > least), left_out_above=F.count(F.lit(1))))


@register("model_save_check", W(*X.BASE_F) + "SELECT string_agg(main_cat, ',' ORDER BY main_cat) AS classes, CAST(0 AS BIGINT) AS n_changed FROM (SELECT DISTINCT main_cat FROM feats_cat)",
          fits=True)
def q_model_save(spark: SparkSession, d: str) -> DataFrame:
    """Class names a loaded model carries, and scores that saving it once more changes."""
    from sessionlab.config import fresh_path

    model, copy = M.load_model(_trained(spark, d, "multiclass")[0]), fresh_path(spark, "model-copy")
    M.save_model(model, copy)
    f = _feats_cat(spark, d)
    a, b = M.score_multiclass(model, f), M.score_multiclass(M.load_model(copy), f)
    changed = a.join(b.select("user_session", F.col("pred").alias("p2"), F.col("proba").alias("q2")), "user_session", "full_outer") \
        .filter(~(F.col("pred").eqNullSafe(F.col("p2")) & F.col("proba").eqNullSafe(F.col("q2"))))
    return changed.agg(F.lit(",".join(M.class_names(model))).alias("classes"), F.count(F.lit(1)).alias("n_changed"))


# --- M9, M10, E15-E17: metrics of the jobs

def _by_metric(df: DataFrame, column: str = "value") -> dict[str, Column]:
    return {m: F.sum(F.when(F.col("metric") == m, F.col(column))) for m in ("tn", "fp", "fn", "tp", "f1", "precision", "recall", "n_test", "n_test_positive")}


@register("train_binary_job_check", _BIN + """ SELECT model, item, value FROM (SELECT unnest(['baseline_logreg', 'primary_boosted']) AS model),
  (SELECT 'negatives' AS item, CAST(count(*) FILTER (WHERE purchased = 0) AS DOUBLE) AS value FROM test UNION ALL
   SELECT 'positives', CAST(count(*) FILTER (WHERE purchased = 1) AS DOUBLE) FROM test UNION ALL SELECT 'f1_off', 0.0)""", fits=True)
def q_train_binary_job(spark: SparkSession, d: str) -> DataFrame:
    m = SINK.read_metrics(spark, _trained(spark, d, "binary")[1])
    v = m.groupBy("model").agg(*[c.alias(k) for k, c in _by_metric(m).items()])
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    pairs = F.array(*[F.struct(F.lit(n).alias("item"), c.alias("value")) for n, c in (
        ("negatives", F.col("tn") + F.col("fp")), ("positives", F.col("fn") + F.col("tp")), ("f1_off", r6(F.abs(f1 - F.col("f1")))))])
    return v.select("model", F.explode(pairs).alias("p")).select("model", "p.item", "p.value")


_SUPPORT = """ SELECT m.model, main_cat AS label, CAST(count(*) AS DOUBLE) AS support FROM test,
  (SELECT unnest(['baseline_logreg', 'primary_boosted']) AS model) m GROUP BY m.model, main_cat"""


@register("train_multiclass_job_check", _MULTI + _SUPPORT, fits=True)
def q_train_multiclass_job(spark: SparkSession, d: str) -> DataFrame:
    m = SINK.read_metrics(spark, _trained(spark, d, "multiclass")[1])
    known = [*M.class_names(M.load_model(_trained(spark, d, "multiclass")[0]))]
    return m.filter((F.col("metric") == "support") & F.col("label").isin(known)).select("model", "label", F.col("value").alias("support"))


@register("evaluate_binary_job_check", _sql(_BIN, n=_count(), first_tpr="0", last_tpr="1", auc_off="0"), fits=True)
def q_evaluate_binary_job(spark: SparkSession, d: str) -> DataFrame:
    """The curve runs from 0 to 1 and its area is the AUC the training job recorded."""
    path, metrics = _trained(spark, d, "binary")
    t = JOBS.evaluate_binary_job(path, _feats(spark, d))
    told = (SINK.read_metrics(spark, metrics).filter((F.col("metric") == "roc_auc") & (F.col("model") == JOBS.PRIMARY))
            .agg(F.first("value").alias("v")).scalar())
    return (_items(t["confusion"], n=F.sum(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")))
            .unionByName(_items(t["roc_curve"], first_tpr=F.min("tpr"), last_tpr=F.max("tpr")))
            .unionByName(_items(t["roc_auc"], auc_off=F.max(F.abs(F.col("roc_auc") - told)))))


@register("evaluate_multiclass_job_check", _MULTI + " SELECT main_cat AS true_label, CAST(count(*) AS BIGINT) AS n, 1.0::DOUBLE AS row_total FROM test GROUP BY main_cat",
          fits=True)
def q_evaluate_multiclass_job(spark: SparkSession, d: str) -> DataFrame:
    from sessionlab.operators import metrics as E

    cm = JOBS.evaluate_multiclass_job(_trained(spark, d, "multiclass")[0], _feats_cat(spark, d))["confusion"]
    share = E.confusion_normalized(cm).groupBy("true_label").agg(r6(F.sum("share")).alias("row_total"))
    return cm.groupBy("true_label").agg(F.sum("n").cast("long").alias("n")).filter("n > 0").join(share, "true_label")


@register("temporal_validation_job_check", W(*X.BASE_F) + _MONTHS_SQL + _split_sql("purchased", "feats") + """
SELECT 'n_test' AS metric, (SELECT CAST(count(*) AS DOUBLE) FROM split WHERE split = 'test') AS random, CAST(count(*) AS DOUBLE) AS temporal
FROM feats JOIN months USING (user_session) WHERE period = 3 UNION ALL
SELECT 'n_test_positive', (SELECT CAST(count(*) AS DOUBLE) FROM split WHERE split = 'test' AND purchased = 1), CAST(count(*) FILTER (WHERE purchased = 1) AS DOUBLE)
FROM feats JOIN months USING (user_session) WHERE period = 3""", fits=True)
def q_temporal_validation_job(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(_temporal(spark, d))
    return t.filter(F.col("metric").isin("n_test", "n_test_positive")).select("metric", "random", "temporal")
