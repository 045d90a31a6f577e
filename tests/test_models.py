import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeflow.operators import metrics as M
from surgeflow.operators import models as ML
from surgeflow.session import ensure_checkpoint_dir, write_observed


def _train(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        x = rng.normal(size=3)
        a, b = (None if rng.random() < 0.2 else float(v) for v in x[:2])
        rows.append(("s", dt.date(2024, 1, 6) + dt.timedelta(days=7 * i), a, b, 5.0, int(x[0] + x[1] > 0.4)))
    return spark.createDataFrame(rows, f"state_territory string, week_end date, a double, b double, c double, "
                                       f"{ML.LABEL} int")


def test_stored_pipelines_score_raw_rows_in_a_new_session(spark):
    train = _train(spark)
    fm = ML.fit_all(train, ["a", "b", "c"], rf_trees=5, gbt_iter=4)
    direct = ML.score_batch(fm, train)
    root = os.path.join(ensure_checkpoint_dir(spark), "test-model-store")
    ML.save_models(fm, root, M.report(ML.long_predictions(direct)))
    other = spark.newSession()
    raw = other.createDataFrame(train.collect(), train.schema).withColumn("extra", F.lit("kept"))
    expected = {r["week_end"]: r for r in direct.collect()}
    for key in ML.MODEL_NAMES:
        scored = ML.score_stored(root, key, raw)
        assert scored.columns == [*raw.columns, "prediction", "score"]
        for r in scored.collect():
            e = expected[r["week_end"]]
            assert r["prediction"] == e[f"{key}_pred"] and abs(r["score"] - e[f"{key}_proba"]) < 1e-9
    stored = other.read.parquet(os.path.join(root, "metrics"))
    assert {r["model"] for r in stored.collect()} >= set(ML.MODEL_NAMES.values())


def test_cross_validation_equals_fold_by_fold(spark):
    rows = _train(spark)
    cut = [F.lit(d).cast("date") for d in ("2026-01-03", "2027-01-02", "2027-10-02")]
    folds = [(k, rows.where(F.col("week_end") < a), rows.where((F.col("week_end") >= a) & (F.col("week_end") < b)))
             for k, (a, b) in enumerate(zip(cut, cut[1:]), 1)]
    got = ML.cross_validate(folds, ["a", "b", "c"], rf_trees=5, gbt_iter=4)
    for k, train, test in folds:
        alone = ML.long_predictions(ML.score_batch(ML.fit_all(train, ["a", "b", "c"], rf_trees=5, gbt_iter=4), test))
        fields = ["model", "week_end", "label", "prediction"]
        assert sorted(map(tuple, got.where(F.col("fold") == k).select(fields).collect())) == \
            sorted(map(tuple, alone.select(fields).collect()))
    assert got.count() == 4 * sum(test.count() for _, _, test in folds)


def test_concurrent_tasks_keep_order_group_and_errors(spark):
    sc = spark.sparkContext
    sc.setJobGroup("outer", "group of the caller")
    try:
        got = ML.concurrently(spark, [lambda k=k: (spark.range(k).count(), sc.getLocalProperty("spark.jobGroup.id"),
                                                   sc.getLocalProperty("spark.scheduler.pool")) for k in range(4)])
        assert got == [(k, "outer", f"surgeflow-{k}") for k in range(4)]
        assert sc.getLocalProperty("spark.scheduler.pool") is None
        with pytest.raises(ZeroDivisionError):
            ML.concurrently(spark, [lambda: 1 / 0, lambda: spark.range(3).count()])
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_models_score_in_a_session_that_has_observed_a_table(spark):
    _, seen = write_observed(spark.range(3), "rows", F.count(F.lit(1)).alias("n"))
    assert seen["n"] == 3
    train = _train(spark)
    fm = ML.fit_all(train, ["a", "b"], rf_trees=3, gbt_iter=2)
    scored = ML.score_batch(fm, train)
    assert scored.where("lr_proba between 0 and 1 and rf_proba between 0 and 1").count() == train.count()
    assert len(ML.long_predictions(scored).collect()) == 4 * train.count()


def _tasks_by_job(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup(group)
              for s in sc.statusTracker().getJobInfo(j).stageIds]
    return [s.numTasks for s in stages if s]


def test_a_fitted_forest_is_not_stored(spark, monkeypatch):
    stored, load = [], ML.PipelineModel.load
    monkeypatch.setattr(ML.PipelineModel, "load", lambda path: stored.append(load(path)) or stored[-1])
    fm = ML.fit_all(_train(spark), ["a", "b"], rf_trees=3, gbt_iter=2)
    assert [type(m.stages[-1]).__name__ for m in stored] == ["LogisticRegressionModel"]
    assert not fm.rf.stages[-1].hasSummary and not fm.lr.stages[-1].hasSummary
    assert fm.rf.stages[-1].getNumTrees == 3


def test_stored_forests_leave_the_driver_in_small_tasks(spark, monkeypatch):
    name = "spark.sql.leafNodeDefaultParallelism"
    fm = ML.fit_all(_train(spark), ["a", "b", "c"], rf_trees=60, gbt_iter=2)
    forest = fm.rf.stages[-1]
    monkeypatch.setattr(ML, "NODES_PER_TASK", 20)
    wanted = -(-forest.totalNumNodes // 20)
    assert wanted > spark.sparkContext.defaultParallelism
    fm.lr = fm.gbt = None
    root = os.path.join(ensure_checkpoint_dir(spark), "test-forest-store")
    before = spark.conf.get(name, None)
    assert wanted in _tasks_by_job(spark, "store-forest", lambda: ML.save_models(fm, root))
    assert spark.conf.get(name, None) == before
    again = ML.load_model(root, "rf").stages[-1]
    assert again.totalNumNodes == forest.totalNumNodes and again.toDebugString == forest.toDebugString
