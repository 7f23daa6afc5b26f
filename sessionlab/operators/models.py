"""MLlib models (M1-M10): scaling, label indexing, class-weighted linear
baselines and boosted trees, scoring and importances.

Everything is a Pipeline over the 14 features; the class weight is a column
(``w``) computed by an aggregate and joined back, so training never leaves
Spark.  Sampling uses the hash-based split, never ``rand()``.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import IndexToString, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.config import written
from sessionlab.constants import FEATURE_COLS, RANDOM_STATE, THRESHOLD
from sessionlab.operators.boosting import BoostedTrees
from sessionlab.operators.joins import lookup_join, with_scalars
from sessionlab.operators.stats import with_class_weight

#: most training rows for a task of a fit, and the rows below which a task is not worth cutting
#: while cores are free
ROWS_PER_TASK = 250_000
ROWS_WORTH_A_TASK = 25_000
#: share of the training rows that a fit with early stopping holds out to watch, and the relative
#: gain of their loss below which a boosting round is the last
HOLDOUT_PERCENT = 10
STOP_GAIN = 0.001
HOLDOUT = "holdout"


def scale_features(df: DataFrame, features: list[str] = FEATURE_COLS, keep: list[str] | None = None) -> DataFrame:
    """M1: z-score with population std (the original scaler), as SQL so the
    result is exact; a constant column scales to 0."""
    keep = keep or []
    stats = df.agg(*[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features],
                   *[F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}") for f in features])
    j = with_scalars(df, stats)
    return j.select(*keep, *[F.coalesce(F.try_divide(F.col(f).cast("double") - F.col(f"m_{f}"),
                                                     F.nullif(F.col(f"s_{f}"), F.lit(0.0))), F.lit(0.0)).alias(f)
                             for f in features])


def label_index(df: DataFrame, label: str = "main_cat", out: str = "label_idx") -> DataFrame:
    """M2: alphabetical label codes 0..k-1 (dense rank over the class table)."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    classes = classes.withColumn(out, (F.dense_rank().over(Window.orderBy(label)) - 1).cast("int"))  # k rows
    return lookup_join(df, classes, label, "inner", cache=True)  # one row per class, measured


def _assembler():
    return VectorAssembler(inputCols=FEATURE_COLS, outputCol="features_raw", handleInvalid="keep")


def logreg_binary(max_iter: int = 1000, reg: float | None = None) -> Pipeline:
    """M3: scaled, class-weighted logistic regression (weight column ``w``)."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", maxIter=max_iter,
                            regParam=reg if reg is not None else 0.0, elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[_assembler(), StandardScaler(inputCol="features_raw", outputCol="features",
                                                         withMean=True, withStd=True), lr])


def boosted_binary(max_iter: int = 400, max_depth: int = 6, step: float = 0.1, subsample: float = 0.9,
                   feature_fraction: str = "0.9", max_bins: int = 256, stop_gain: float | None = None) -> Pipeline:
    """M4: gradient-boosted trees with positive-class weight (column ``w``).  With ``stop_gain``
    the rows marked in ``holdout`` are not fitted: ``max_iter`` is the most rounds, and boosting
    ends with the round whose loss on them gains less than that (see ``rounds_used``)."""
    gbt = BoostedTrees(featuresCol="features_raw", labelCol="label", weightCol="w", maxIter=max_iter,
                       maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                       featureSubsetStrategy=feature_fraction, maxBins=max_bins, seed=RANDOM_STATE)
    if stop_gain is not None:
        gbt.setValidationIndicatorCol(HOLDOUT)._set(validationTol=stop_gain)
    return Pipeline(stages=[_assembler(), gbt])


def logreg_multiclass(max_iter: int = 2000, reg: float | None = None) -> Pipeline:
    """M5: multinomial, class-balanced logistic regression."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", family="multinomial",
                            maxIter=max_iter, regParam=reg if reg is not None else 0.0, standardization=False)
    return Pipeline(stages=[_assembler(), StandardScaler(inputCol="features_raw", outputCol="features",
                                                         withMean=True, withStd=True), lr])


def boosted_multiclass(max_iter: int = 400, max_depth: int = 6, parallelism: int = 4) -> Pipeline:
    """M6: one-vs-rest boosted trees with balanced sample weights."""
    gbt = BoostedTrees(featuresCol="features_raw", labelCol="label", weightCol="w", maxIter=max_iter,
                       maxDepth=max_depth, stepSize=0.1, subsamplingRate=0.9, featureSubsetStrategy="0.9",
                       maxBins=256, seed=RANDOM_STATE)
    ovr = OneVsRest(classifier=gbt, featuresCol="features_raw", labelCol="label", weightCol="w",
                    parallelism=parallelism)
    return Pipeline(stages=[_assembler(), ovr])


def fit_multiclass(pipeline: Pipeline, train: DataFrame, label: str = "main_cat") -> PipelineModel:
    """Fit on ``prepare_multiclass`` rows.  The class names of the training rows become the
    model's last stage, so they are saved, loaded and applied with it."""
    fitted = pipeline.fit(train)
    names = [r[0] for r in train.select(label, "label").distinct().orderBy("label").collect()]  # one row per class
    return PipelineModel([*fitted.stages, IndexToString(inputCol="prediction", outputCol="pred", labels=names)])


def with_holdout(df: DataFrame, key: str = "user_session", percent: int = HOLDOUT_PERCENT) -> DataFrame:
    """Mark the rows a fit with early stopping watches; by key, so the same for any partitioning."""
    return df.withColumn(HOLDOUT, F.pmod(F.xxhash64(F.lit(RANDOM_STATE), F.col(key)), F.lit(100)) < percent)


def class_fits(train: DataFrame, max_iter: int = 400, stop_gain: float | None = STOP_GAIN, label: str = "main_cat") -> tuple[list[str], list]:
    """The fits of a one-vs-rest model as independent jobs, one a class, with the class names.

    ``train`` is a ``training_frame`` with ``holdout``.  MLlib's own one-vs-rest drops that column,
    so the two-class rows are made here; the estimator is that of M6."""
    names = [r[0] for r in train.select(label, "label").distinct().orderBy("label").collect()]  # one row per class
    stages = boosted_binary(max_iter, stop_gain=stop_gain)

    def job(c: int):
        rows = train.withColumn("label", (F.col("label") == float(c)).cast("double"))
        return lambda: stages.fit(rows).stages[-1]
    return names, [job(c) for c in range(len(names))]


def one_vs_rest(names: list[str], models: list) -> PipelineModel:
    """The model M6 makes, from its fitted two-class models in the order of ``names``."""
    ovr = OneVsRest(classifier=GBTClassifier(featuresCol="features_raw"), featuresCol="features_raw", labelCol="label", weightCol="w")
    return PipelineModel([_assembler(), ovr.copy()._copyValues(OneVsRestModel(models=models)),
                          IndexToString(inputCol="prediction", outputCol="pred", labels=names)])


def rounds_used(model: PipelineModel) -> list[int]:
    """Boosting rounds of a fitted boosted model, one number for each two-class model."""
    last = [m for m in model.stages if hasattr(m, "models") or hasattr(m, "getNumTrees")][-1]
    return [m.getNumTrees for m in (last.models if hasattr(last, "models") else [last])]


def class_names(model: PipelineModel) -> list[str]:
    return model.stages[-1].getLabels()


def prepare_binary(sessions: DataFrame, label: str = "purchased", positive_weight: bool = False) -> DataFrame:
    """Label + weight column.  Balanced weights for the linear model; for the
    boosted model the positive class gets n_neg / max(n_pos, 1)."""
    d = sessions.withColumn("label", F.col(label).cast("double"))
    if positive_weight:
        c = d.agg(F.count_if(F.col("label") == 0).alias("_neg"), F.count_if(F.col("label") == 1).alias("_pos"))
        d = with_scalars(d, c)
        return d.withColumn("w", F.when(F.col("label") == 1, F.col("_neg") / F.greatest(F.col("_pos"), F.lit(1)))
                            .otherwise(F.lit(1.0))).drop("_neg", "_pos")
    return with_class_weight(d, "label")


def prepare_multiclass(sessions: DataFrame, label: str = "main_cat") -> DataFrame:
    """Alphabetical label codes and the balanced weight column."""
    d = label_index(sessions.filter(F.col(label).isNotNull()), label, "label_idx")
    return with_class_weight(d.withColumn("label", F.col("label_idx").cast("double")), label)


def fit_tasks(n_rows: int, cores: int, fits: int = 1) -> int:
    """Tasks of one of ``fits`` fits that run at the same time: as many as there are cores for it, of
    ``ROWS_WORTH_A_TASK`` to ``ROWS_PER_TASK`` rows, and more where that is not enough."""
    worth = min(cores // max(1, fits), math.ceil(n_rows / ROWS_WORTH_A_TASK))
    return max(1, worth, math.ceil(n_rows / ROWS_PER_TASK))


def training_frame(prepared: DataFrame, extra: tuple[str, ...] = (), fits: int | None = 1) -> DataFrame:
    """The columns a fit reads, written once to the shared folder and dealt out by row count:
    every boosting round passes over these files, not over the event pipeline, and a small
    table does not pay for empty tasks.  ``fits``: how many run at the same time on frames like
    this, None for one a class."""
    cols = [*FEATURE_COLS, "label", "w", *extra]
    d = written(prepared.select(*cols), "training")
    n, last = d.agg(F.count(F.lit(1)), F.max("label")).first()
    tasks = fit_tasks(n, d.sparkSession.sparkContext.defaultParallelism, int(last or 0) + 1 if fits is None else fits)
    return d.coalesce(tasks) if d.rdd.getNumPartitions() >= tasks else d.repartition(tasks)


def regularisation(train: DataFrame) -> float:
    """C=1 on the summed loss equals regParam = 1/sum(w) on MLlib's mean loss."""
    return 1.0 / float(train.agg(F.sum("w")).first()[0] or 1.0)


def score_binary(model: PipelineModel, df: DataFrame, key: str = "user_session",
                 threshold: float = THRESHOLD) -> DataFrame:
    """M7 (binary): (key, label, proba, pred) with an explicit proba >= 0.5."""
    s = model.transform(df)
    p = vector_to_array("probability")[1]
    return s.select(key, F.col("label").cast("int").alias("label"), p.alias("proba"),
                    (p >= threshold).cast("int").alias("pred"))


def class_probabilities(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with pred (class name) and proba (array in the order of ``class_names``).

    The linear model gives probabilities itself.  One-vs-rest gives a margin F for each class;
    its own model's probability is 1 / (1 + exp(-2 F)), and these are scaled to sum to one.
    """
    s = model.transform(df)
    if "probability" in s.columns:
        return s.withColumn("proba", vector_to_array("probability"))
    odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    total = F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x)
    return s.withColumn("_odds", odds).withColumn("_total", total) \
            .withColumn("proba", F.transform("_odds", lambda x: x / F.col("_total"))).drop("_odds", "_total")


def score_multiclass(model: PipelineModel, df: DataFrame, key: str = "user_session",
                     label: str = "main_cat") -> DataFrame:
    """M7 (multi-class): (key, label, pred, proba of pred); every row of ``df`` is kept, whatever
    classes it has."""
    s = class_probabilities(model, df)
    known = F.col(label) if label in df.columns else F.lit(None).cast("string")
    return s.select(key, known.alias("label"), "pred", F.array_max("proba").alias("proba"))


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """M8: importance per feature (mean over one-vs-rest sub-models)."""
    last = [m for m in model.stages if hasattr(m, "models") or hasattr(m, "featureImportances")][-1]
    if hasattr(last, "models"):
        vecs = [m.featureImportances.toArray() for m in last.models]
        imp = [sum(v[i] for v in vecs) / len(vecs) for i in range(len(FEATURE_COLS))]
    else:
        imp = list(last.featureImportances.toArray())
    return list(zip(FEATURE_COLS, [float(x) for x in imp]))


def importance_table(spark, model: PipelineModel, top: int | None = None) -> DataFrame:
    """Importances ordered, optional top-N (14 rows at most)."""
    df = spark.createDataFrame(feature_importance(model), "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), "feature")
    return df.limit(top) if top else df


def save_model(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline, class names included."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- fitted models as tables ---------------------------------------------------

def linear_table(spark, model: PipelineModel) -> DataFrame:
    """A fitted linear model as rows (class, term, coefficient, mean, std): 14 features and the
    intercept for each class (the binary model: one class, null).  With the scaler's mean and std
    the rows give its probabilities without MLlib, see ``linear_margins``."""
    scaler = next(m for m in model.stages if hasattr(m, "std"))
    lr = next(m for m in model.stages if hasattr(m, "coefficientMatrix"))
    names = [None] if lr.numClasses == 2 and lr.coefficientMatrix.numRows == 1 else class_names(model)
    rows = []
    for name, beta, intercept in zip(names, lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()):
        rows += [(name, f, float(b), float(m), float(v)) for f, b, m, v in zip(FEATURE_COLS, beta, scaler.mean, scaler.std)]
        rows.append((name, "intercept", float(intercept), 0.0, 1.0))
    return spark.createDataFrame(rows, "class string, term string, coefficient double, mean double, std double")


def _scaled(row) -> Column:
    x = F.col(row["term"]).cast("double")
    return (x - row["mean"]) / row["std"] if row["std"] else F.lit(0.0)


def linear_margins(table: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` with ``margins`` (one a class of a ``linear_table``) in plain column arithmetic."""
    by_class: dict = {}
    for r in table.collect():     # 15 rows a class
        by_class.setdefault(r["class"], []).append(r)
    margins = []
    for name in sorted(by_class, key=lambda c: c or ""):
        total = F.lit(0.0)
        for r in by_class[name]:
            total = total + F.lit(r["coefficient"]) * (F.lit(1.0) if r["term"] == "intercept" else _scaled(r))
        margins.append(total)
    return df.withColumn("margins", F.array(*margins))


def linear_gradient(table: DataFrame, train: DataFrame, reg: float) -> DataFrame:
    """(class, term, gradient) of the penalised, weighted mean loss of a ``linear_table`` over its
    training rows: zero everywhere at the optimum, of which there is one."""
    rows = table.collect()
    d = linear_margins(table, train)
    classes = sorted({r["class"] for r in rows}, key=lambda c: c or "")
    if classes == [None]:
        d = d.withColumn("off", F.array(1 / (1 + F.exp(-F.col("margins")[0])) - F.col("label")))
    else:
        odds = F.transform("margins", lambda m: F.exp(m - F.array_max("margins")))
        share = F.transform(odds, lambda o: o / F.aggregate(odds, F.lit(0.0), lambda a, x: a + x))
        d = d.withColumn("off", F.transform(share, lambda p, i: p - (F.col("label") == i).cast("double")))
    sums = [F.sum(F.col("w") * F.col("off")[classes.index(r["class"])] * (F.lit(1.0) if r["term"] == "intercept" else _scaled(r)))
            / F.sum("w") + (0.0 if r["term"] == "intercept" else reg * r["coefficient"]) for r in rows]
    one = d.agg(F.array(*sums).alias("g")).select(F.posexplode("g").alias("at", "gradient"))
    named = table.sparkSession.createDataFrame([(i, r["class"], r["term"]) for i, r in enumerate(rows)], "at int, class string, term string")
    return named.join(one, "at").select("class", "term", "gradient")
