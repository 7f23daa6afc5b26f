"""End-to-end jobs composed from the operators.

Every job reads a session table (materialised: written or checkpointed), so
model fits iterate over files, not over the event pipeline.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.constants import CV_MAX_STD_AUC, CV_MAX_STD_F1, CV_MAX_STD_MACRO, CV_MAX_STD_WEIGHTED, N_FOLDS
from sessionlab.operators import metrics as E
from sessionlab.operators import models as M
from sessionlab.operators import splits as D
from sessionlab.operators.joins import attach_month, with_scalars
from sessionlab.operators.quality import CHECK, _row, _stack
from sessionlab.sources.sinks import metrics_upsert

BASELINE, PRIMARY = "baseline_logreg", "primary_boosted"
CV_BOUNDS = {"f1": CV_MAX_STD_F1, "roc_auc": CV_MAX_STD_AUC, "macro_f1": CV_MAX_STD_MACRO, "weighted_f1": CV_MAX_STD_WEIGHTED}


def _long_binary(scores: DataFrame, run: str, model: str) -> DataFrame:
    """Binary metrics of a score table as long rows."""
    bm = E.binary_metrics(scores)
    auc = E.roc_auc(scores)
    ap = E.average_precision(scores)
    cm = E.confusion_binary(scores)
    wide = with_scalars(with_scalars(with_scalars(bm, auc), ap), cm)
    names = ["f1", "roc_auc", "precision", "recall", "average_precision", "tn", "fp", "fn", "tp", "n_test",
             "n_test_positive"]
    kv = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]))
    return wide.select(kv.alias("_kv")).select(F.lit(run).alias("run"), F.lit("binary").alias("task"),
                                               F.lit(model).alias("model"), "_kv.metric",
                                               F.lit(None).cast("string").alias("label"), "_kv.value")


def _long_multiclass(scores: DataFrame, run: str, model: str) -> DataFrame:
    """Classification report as long rows (label = class or summary row)."""
    rep = E.classification_report(E.confusion_multiclass(scores))
    kv = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
                             for n in ("precision", "recall", "f1", "support")]))
    return rep.select("label", kv.alias("_kv")).filter(F.col("_kv.value").isNotNull()).select(
        F.lit(run).alias("run"), F.lit("multiclass").alias("task"), F.lit(model).alias("model"), "_kv.metric",
        "label", "_kv.value")


def _split(sessions: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    s = written(D.stratified_split(sessions, label), "split")
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def _with_label(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("label", F.col("purchased").cast("double"))


#: fits that run at the same time; each is a chain of small jobs, so a few keep the executors busy
FITS_AT_ONCE = 8


def in_parallel(jobs: list, at_once: int = FITS_AT_ONCE) -> list:
    """Run independent fits, ``at_once`` of them at a time; their jobs share the executors."""
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        return list(pool.map(lambda f: f(), [inheritable_thread_target(SparkSession.active())(j) for j in jobs]))


def fit_binary(train: DataFrame, max_iter_lr: int = 1000, max_iter_gbt: int = 400) -> dict[str, PipelineModel]:
    linear = M.training_frame(M.prepare_binary(train))
    boosted = M.training_frame(M.prepare_binary(train, positive_weight=True))
    fits = in_parallel([lambda: M.logreg_binary(max_iter_lr, reg=M.regularisation(linear)).fit(linear),
                        lambda: M.boosted_binary(max_iter_gbt).fit(boosted)])
    return dict(zip((BASELINE, PRIMARY), fits))


def fit_multiclass(train: DataFrame, max_iter_lr: int = 2000, max_iter_gbt: int = 400,
                   parallelism: int = 8) -> dict[str, PipelineModel]:
    rows = M.training_frame(M.prepare_multiclass(train), ("main_cat",), fits=None)
    fits = in_parallel([lambda: M.fit_multiclass(M.logreg_multiclass(max_iter_lr, reg=M.regularisation(rows)), rows),
                        lambda: M.fit_multiclass(M.boosted_multiclass(max_iter_gbt, parallelism=parallelism), rows)])
    return dict(zip((BASELINE, PRIMARY), fits))


def _finish(metrics: DataFrame, models: dict[str, PipelineModel], model_path: str | None, metrics_path: str | None) -> DataFrame:
    """Keep the primary model and merge the metrics where paths are given."""
    metrics = written(metrics, "metrics-rows")
    if model_path:
        M.save_model(models[PRIMARY], model_path)
    if metrics_path:
        metrics_upsert(metrics, metrics_path)
    return metrics


def train_binary_job(sessions: DataFrame, max_iter_lr: int = 1000, max_iter_gbt: int = 400, run: str = "random",
                     model_path: str | None = None, metrics_path: str | None = None) -> DataFrame:
    """M9: stratified 80/20 split -> LR baseline + boosted trees -> metrics, merged into the metrics
    table (A10) -> primary model saved (A11)."""
    train, test = _split(sessions, "purchased")
    models, out = fit_binary(train, max_iter_lr, max_iter_gbt), None
    for name, m in models.items():
        part = _long_binary(written(M.score_binary(m, _with_label(test)), "scores"), run, name)
        out = part if out is None else out.unionByName(part)
    return _finish(out, models, model_path, metrics_path)


def train_multiclass_job(sessions_cat: DataFrame, max_iter_lr: int = 2000, max_iter_gbt: int = 400, run: str = "random",
                         model_path: str | None = None, metrics_path: str | None = None) -> DataFrame:
    """Stratified split on main_cat -> multinomial LR + one-vs-rest boosted trees ->
    classification reports, merged (A10) -> primary model with its class names saved (A11)."""
    train, test = _split(sessions_cat, "main_cat")
    models, out = fit_multiclass(train, max_iter_lr, max_iter_gbt), None
    for name, m in models.items():
        part = _long_multiclass(written(M.score_multiclass(m, test), "scores"), run, name)
        out = part if out is None else out.unionByName(part)
    return _finish(out, models, model_path, metrics_path)


def binary_scores(model_path: str, sessions: DataFrame) -> DataFrame:
    """Scores of a saved model on the test part of the seeded split, written once."""
    test = D.stratified_split(sessions, "purchased").filter(F.col("split") == "test")
    return written(M.score_binary(M.load_model(model_path), _with_label(test)), "scores")


def evaluate_binary_job(model_path: str, sessions: DataFrame) -> dict[str, DataFrame]:
    """Reload the saved model, repeat the seeded split, and return the curve, confusion and
    importance tables."""
    sc = binary_scores(model_path, sessions)
    return {"confusion": E.confusion_binary(sc), "roc_curve": E.roc_curve(sc), "pr_curve": E.pr_curve(sc),
            "roc_auc": E.roc_auc(sc), "average_precision": E.average_precision(sc),
            "importance": M.importance_table(sessions.sparkSession, M.load_model(model_path))}


def multiclass_scores(model_path: str, sessions_cat: DataFrame) -> DataFrame:
    test = D.stratified_split(sessions_cat, "main_cat").filter(F.col("split") == "test")
    return written(M.score_multiclass(M.load_model(model_path), test), "scores")


def evaluate_multiclass_job(model_path: str, sessions_cat: DataFrame) -> dict[str, DataFrame]:
    """Reload the saved model; confusion matrix (counts and row-normalised) and importances.
    Class names come from the model, whatever classes the table has."""
    cm = written(E.confusion_multiclass(multiclass_scores(model_path, sessions_cat)), "confusion")
    return {"confusion": cm, "confusion_normalized": E.confusion_normalized(cm),
            "importance": M.importance_table(sessions_cat.sparkSession, M.load_model(model_path))}


def as_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables of a job as one: (table, row as JSON)."""
    out = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("table"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def temporal_validation_job(sessions: DataFrame, months: DataFrame, max_iter_gbt: int = 400, test_periods=(3,),
                            random_metrics: DataFrame | None = None, metrics_path: str | None = None) -> DataFrame:
    """Attach first month (J4) -> train on earlier periods, test on the last (D6) -> boosted
    models for both tasks -> metrics merged (A10) and, given those of the random split, set
    beside them (E13)."""
    tm = written(D.temporal_split(attach_month(sessions, months.select("user_session", "period")), test_periods=test_periods), "temporal")
    train, test = tm.filter(F.col("split") == "train"), tm.filter(F.col("split") == "test")
    tc, ec = train.filter(F.col("main_cat").isNotNull()), test.filter(F.col("main_cat").isNotNull())
    # Keep test rows whose class occurs in training
    ec = ec.join(tc.select("main_cat").distinct(), "main_cat", "left_semi")
    binary = M.training_frame(M.prepare_binary(train, positive_weight=True))
    classes = M.training_frame(M.prepare_multiclass(tc), ("main_cat",), fits=None)
    gbt, ovr = in_parallel([lambda: M.boosted_binary(max_iter_gbt).fit(binary),
                            lambda: M.fit_multiclass(M.boosted_multiclass(max_iter_gbt, parallelism=8), classes)])
    out = _long_binary(written(M.score_binary(gbt, _with_label(test)), "scores"), "temporal", PRIMARY)
    many = _long_multiclass(written(M.score_multiclass(ovr, ec), "scores"), "temporal", PRIMARY)
    out = _finish(out.unionByName(many), {}, None, metrics_path)
    return out if random_metrics is None else beside_random(out, random_metrics)


def beside_random(out: DataFrame, random_metrics: DataFrame) -> DataFrame:
    """The metrics of a temporal validation beside those of the random split."""
    both = out.unionByName(random_metrics.filter(F.col("model") == PRIMARY).select(*out.columns))
    # two tasks may share a metric's name
    named = both.withColumn("model", F.concat_ws(":", "task", "model"))
    return E.split_comparison(named)


def cv_job(sessions: DataFrame, label: str = "purchased", k: int = N_FOLDS, max_iter_gbt: int = 400,
           stop_gain: float | None = None) -> DataFrame:
    """K-fold CV of the boosted model -> per-fold metrics -> mean, population std and the
    stability checks, with the boosting rounds used (mean over all fits) as a metric without bound.

    Every fold's training rows are assembled and written once.  All fits, one a fold for the
    binary and one a (fold, class) for the multi-class model, wait in one queue of which
    ``FITS_AT_ONCE`` run.  With ``stop_gain`` each fit watches a tenth of its training rows and
    ends when their loss stops improving; ``max_iter_gbt`` is then the most rounds."""
    folded = written(M.with_holdout(D.stratified_kfold(sessions.filter(F.col(label).isNotNull()), label, k=k)), "folds")
    binary = label == "purchased"

    def rows(f: int) -> DataFrame:
        train = folded.filter(F.col("fold") != f)
        if binary:
            return M.training_frame(M.prepare_binary(train, positive_weight=True), (M.HOLDOUT,), fits=k)
        return M.training_frame(M.prepare_multiclass(train, label), (label, M.HOLDOUT), fits=FITS_AT_ONCE)
    frames = in_parallel([lambda f=f: rows(f) for f in range(k)])
    if binary:
        fits = in_parallel([lambda t=t: M.boosted_binary(max_iter_gbt, stop_gain=stop_gain).fit(t) for t in frames])
    else:
        named = [M.class_fits(t, max_iter_gbt, stop_gain, label) for t in frames]
        done = iter(in_parallel([job for _, jobs in named for job in jobs]))
        fits = [M.one_vs_rest(names, [next(done) for _ in names]) for names, _ in named]

    def judged(f: int) -> DataFrame:
        test = folded.filter(F.col("fold") == f)
        if binary:
            sc = written(M.score_binary(fits[f], _with_label(test)), "scores")
            wide, names = with_scalars(E.binary_metrics(sc), E.roc_auc(sc)), ("f1", "roc_auc")
        else:
            wide = E.macro_weighted_f1(E.per_class_prf(E.confusion_multiclass(M.score_multiclass(fits[f], test, label=label))))
            names = ("macro_f1", "weighted_f1")
        used = M.rounds_used(fits[f])
        wide = wide.withColumn("rounds", F.lit(sum(used) / len(used)))
        kv = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in (*names, "rounds")]))
        return written(wide.select(kv.alias("kv")).select(F.lit(f).alias("fold"), "kv.metric", "kv.value"), "fold-metrics")
    by_fold = in_parallel([lambda f=f: judged(f) for f in range(k)])
    allf = by_fold[0]
    for r in by_fold[1:]:
        allf = allf.unionByName(r)
    return E.cv_summary(allf, CV_BOUNDS)


def cv_checks(summary: DataFrame, task: str) -> DataFrame:
    """Q10 audit rows from a CV summary."""
    ok = summary.filter(F.col("bound").isNotNull()).agg(F.bool_and("stable").alias("ok"), F.max("std").alias("v"))
    name = CHECK["cv_binary"] if task == "binary" else CHECK["cv_multi"]
    return _stack(ok, [_row(name, F.col("v"), F.col("ok"))])
