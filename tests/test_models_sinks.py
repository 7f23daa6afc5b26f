"""Models on a planted signal, sinks, sources and plan properties."""

import re

import pytest
from pyspark.sql import functions as F

from sessionlab.constants import FEATURE_COLS
from sessionlab.operators import metrics as E
from sessionlab.operators import models as M
from sessionlab.operators.features import require_columns
from sessionlab.sources import sinks


@pytest.fixture(scope="module")
def planted(spark):
    """Sessions whose label depends on n_cart (a planted signal)."""
    rows = []
    for i in range(600):
        n_cart = i % 7
        y = 1 if (n_cart >= 4) != (i % 23 == 0) else 0
        vals = {c: float((i * (k + 3)) % 11) for k, c in enumerate(FEATURE_COLS)}
        vals["n_cart"] = float(n_cart)
        rows.append((f"s{i}", y, "a" if n_cart < 2 else "b" if n_cart < 5 else "c", *[vals[c] for c in FEATURE_COLS]))
    schema = "user_session string, purchased int, main_cat string, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(rows, schema)


def test_boosted_and_linear_learn_signal(planted):
    gbt = M.boosted_binary(max_iter=10).fit(M.prepare_binary(planted, positive_weight=True))
    sc = M.score_binary(gbt, planted.withColumn("label", F.col("purchased").cast("double")))
    assert sc.filter((F.col("proba") < 0) | (F.col("proba") > 1)).count() == 0
    assert E.roc_auc(sc).first().roc_auc > 0.85
    tr = M.prepare_binary(planted)
    lr = M.logreg_binary(max_iter=100, reg=M.regularisation(tr)).fit(tr)
    sc2 = M.score_binary(lr, planted.withColumn("label", F.col("purchased").cast("double")))
    assert E.roc_auc(sc2).first().roc_auc > 0.8
    imp = dict(M.feature_importance(gbt))
    assert max(imp, key=imp.get) == "n_cart"


def test_multiclass_one_vs_rest(planted, spark, tmp_path):
    """Saved, loaded and applied to rows that lack a class, or have a new one, the model keeps its
    class names and loses no row."""
    rows = M.training_frame(M.prepare_multiclass(planted), ("main_cat",))
    M.save_model(M.fit_multiclass(M.boosted_multiclass(max_iter=5, parallelism=2), rows), str(tmp_path / "m"))
    m = M.load_model(str(tmp_path / "m"))
    assert M.class_names(m) == ["a", "b", "c"]
    mw = E.macro_weighted_f1(E.per_class_prf(E.confusion_multiclass(M.score_multiclass(m, planted)))).first()
    assert mw.macro_f1 > 0.9
    part = planted.filter("main_cat <> 'a'").withColumn("main_cat", F.expr("if(user_session = 's2', 'new', main_cat)"))
    got = M.score_multiclass(m, part)
    assert got.count() == part.count()
    assert got.filter("label IN ('b', 'c') AND label <> pred").count() < 0.1 * part.count()
    p = M.class_probabilities(m, part).select(F.size("proba").alias("n"), F.aggregate("proba", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert p.filter("n <> 3 OR abs(s - 1) > 1e-9").count() == 0


def test_jobs_end_in_saved_model_and_metrics(planted, spark, tmp_path):
    from sessionlab import jobs
    model, metrics = str(tmp_path / "model"), str(tmp_path / "metrics")
    out = jobs.train_multiclass_job(planted, max_iter_lr=20, max_iter_gbt=3, model_path=model, metrics_path=metrics)
    assert sinks.read_metrics(spark, metrics).count() == out.count() > 0
    tables = jobs.evaluate_multiclass_job(model, planted)
    assert {r.true_label for r in tables["confusion"].collect()} == {"a", "b", "c"}
    assert {r.table for r in jobs.as_rows(tables).collect()} == set(tables)


def test_early_stopping_keeps_the_score(planted, spark, tmp_path):
    """Fits that stop by their held-out loss use fewer rounds and score within 0.03 of full ones."""
    from sessionlab import jobs
    got = {}
    for gain in (None, M.STOP_GAIN):
        got[gain] = {r.metric: r for r in jobs.cv_job(planted, "main_cat", k=2, max_iter_gbt=25, stop_gain=gain).collect()}
    assert got[None]["rounds"].mean == 25 and 1 < got[M.STOP_GAIN]["rounds"].mean <= 25
    assert got[M.STOP_GAIN]["rounds"].bound is None
    for m in ("macro_f1", "weighted_f1"):
        assert got[None][m].n_folds == 2 and abs(got[None][m].mean - got[M.STOP_GAIN][m].mean) < 0.03


def test_class_fits_make_the_one_vs_rest_model(planted, tmp_path):
    """Without early stopping the separate fits are those of M6, before and after saving."""
    rows = M.training_frame(M.prepare_multiclass(M.with_holdout(planted)), ("main_cat", M.HOLDOUT))
    names, jobs = M.class_fits(rows, max_iter=4, stop_gain=None)
    M.save_model(M.one_vs_rest(names, [j() for j in jobs]), str(tmp_path / "m"))
    ours = M.load_model(str(tmp_path / "m"))
    theirs = M.fit_multiclass(M.boosted_multiclass(max_iter=4, parallelism=1), rows)
    assert M.rounds_used(ours) == [4, 4, 4] and M.class_names(ours) == names == ["a", "b", "c"]
    a, b = (sorted(map(tuple, M.score_multiclass(m, planted).collect())) for m in (ours, theirs))
    assert [x[:3] for x in a] == [x[:3] for x in b]


def test_linear_table_gives_the_scores_and_a_flat_gradient(planted, spark):
    rows = M.training_frame(M.prepare_binary(planted))
    reg = M.regularisation(rows)
    model = M.logreg_binary(reg=reg).fit(rows)
    table = M.linear_table(spark, model)
    assert table.count() == len(FEATURE_COLS) + 1
    labelled = planted.withColumn("label", F.col("purchased").cast("double"))
    ours = M.linear_margins(table, labelled).select("user_session", (1 / (1 + F.exp(-F.col("margins")[0]))).alias("p"))
    off = ours.join(M.score_binary(model, labelled), "user_session").agg(F.max(F.abs(F.col("p") - F.col("proba"))).alias("off")).first().off
    assert off < 1e-9
    assert max(abs(r.gradient) for r in M.linear_gradient(table, rows, reg).collect()) < 5e-3
    # a model that is not at its optimum shows: the gradient sees the planted feature
    wrong = table.withColumn("coefficient", F.when(F.col("term") == "n_cart", 0.0).otherwise(F.col("coefficient")))
    assert max(abs(r.gradient) for r in M.linear_gradient(wrong, rows, reg).collect()) > 0.05


def test_training_frames_use_the_cores_of_a_fit(planted, spark, monkeypatch):
    """A fit is cut into as many tasks as it has cores (it was one task up to 250,000 rows), a small
    table is not cut, and no row is lost."""
    assert M.fit_tasks(24_000, 12) == 1 and M.fit_tasks(144_000, 12) == 6 and M.fit_tasks(1_440_000, 12) == 12
    assert M.fit_tasks(144_000, 12, fits=5) == 2 and M.fit_tasks(9_000_000, 12, fits=5) == 36 and M.fit_tasks(0, 12) == 1
    assert M.training_frame(M.prepare_binary(planted)).rdd.getNumPartitions() == 1
    monkeypatch.setattr(M, "ROWS_WORTH_A_TASK", 200)
    whole = M.prepare_multiclass(planted).select(*FEATURE_COLS, "label", "w", "main_cat")
    for fits, tasks in ((1, 3), (2, 2), (None, 1)):     # 600 rows, 4 cores, 3 classes
        got = M.training_frame(M.prepare_multiclass(planted), ("main_cat",), fits=fits)
        assert got.rdd.getNumPartitions() == tasks
        assert got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0


def test_both_trainings_run_at_the_same_time(spark, monkeypatch):
    """Each waits for all others to begin, so trained one after another they would never end."""
    from threading import Barrier

    from sessionlab.plans import registry
    meet = Barrier(3)
    monkeypatch.setattr(registry, "_trained", lambda spark, d, task: meet.wait(30))
    assert registry._all_trained(spark, "", lambda: meet.wait(30) >= 0) == [True]


def test_label_index_alphabetical(planted):
    got = {r.main_cat: r.label_idx for r in M.label_index(planted).select("main_cat", "label_idx").distinct().collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_require_columns(planted):
    require_columns(planted, FEATURE_COLS)
    with pytest.raises(KeyError):
        require_columns(planted.drop("n_cart"), FEATURE_COLS)


def test_metrics_upsert_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "metrics")
    a = spark.createDataFrame([("random", "binary", "m", "f1", None, 0.5)], sinks.METRICS_SCHEMA)
    b = spark.createDataFrame([("temporal", "binary", "m", "f1", None, 0.4)], sinks.METRICS_SCHEMA)
    a2 = spark.createDataFrame([("random", "binary", "m", "f1", None, 0.6)], sinks.METRICS_SCHEMA)
    sinks.metrics_upsert(a, path)
    sinks.metrics_upsert(b, path)
    sinks.metrics_upsert(a2, path)
    got = {(r.run, r.value) for r in sinks.read_metrics(spark, path).collect()}
    assert got == {("random", 0.6), ("temporal", 0.4)}
    assert sinks.read_metrics(spark, str(tmp_path / "missing")).count() == 0


HEADER = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session"]


def _csv(path, rows=1, header=HEADER, extra="", **values):
    path.parent.mkdir(parents=True, exist_ok=True)
    row = {"event_time": "2020-01-01 00:00:05 UTC", "event_type": "view", "product_id": "1", "category_id": "2", "price": "3.5",
           "user_id": "7", "user_session": "s", **values}
    path.write_text("\n".join([",".join(header), *[",".join(row.get(c, "") for c in header) + extra] * rows]) + "\n")
    return str(path)


def test_csv_scan_missing_file_fails_early(spark, tmp_path):
    from sessionlab.sources.events import scan_periods_csv
    with pytest.raises(FileNotFoundError):
        scan_periods_csv(spark, [str(tmp_path / "nope.csv")])


def test_csv_by_name(spark, tmp_path):
    from sessionlab.sources.events import read_events_csv
    r = read_events_csv(spark, _csv(tmp_path / "a.csv", header=HEADER[::-1])).first()
    assert (r.user_id, r.event_type, r.price, r.category_code, str(r.event_time)) == (7, "view", 3.5, None, "2020-01-01 00:00:05")
    with pytest.raises(KeyError):
        read_events_csv(spark, _csv(tmp_path / "b.csv", header=HEADER[1:]))
    assert read_events_csv(spark, _csv(tmp_path / "c.csv", header=HEADER[1:]), columns=["user_id"]).first() == (7,)
    for bad in (_csv(tmp_path / "d.csv", extra=",9,9"), _csv(tmp_path / "e.csv", user_id="x")):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|CAST_INVALID"):
            read_events_csv(spark, bad).collect()


def test_csv_periods_by_path(spark, tmp_path):
    from sessionlab.sources.events import scan_periods_csv
    paths = [_csv(tmp_path / d / "x.csv", n, h) for d, n, h in (("m-1", 2, HEADER), ("m-10", 3, HEADER[::-1]), ("with space", 4, HEADER))]
    got = scan_periods_csv(spark, [p.rsplit("/", 1)[0] for p in paths]).groupBy("period").count().collect()
    assert sorted(map(tuple, got)) == [(0, 2), (1, 3), (2, 4)]


def test_category_scan_is_pruned(spark):
    import __spark_entry__ as ent
    df = ent.queries()["scan_category_cols"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    events_scan = [s for s in schemas if "props" in s]
    assert events_scan and all("value" not in s and "user_id" not in s for s in events_scan)


def test_session_rollup_shuffles_pre_aggregated_rows(spark):
    """What the rollup shuffles by session is aggregated on the mappers first: one statistics row per
    session, one row per (session, product, category), and what follows from those.  No event
    row goes through a join by session."""
    import __spark_entry__ as ent
    df = ent.queries()["sessions_all"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    lines = plan.splitlines()
    shuffles = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(user_session" in x]
    assert len(shuffles) == 4 and all("HashAggregate" in lines[i + 1] for i in shuffles)
    assert sum("product_id" in lines[i] for i in shuffles) == 1
    assert plan.count("SortMergeJoin") <= 1 and "SortAggregate" not in plan and "Expand" not in plan
