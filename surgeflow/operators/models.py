"""Spark ML models: majority baseline, balanced logistic regression, balanced random
forest and boosted trees, with train-fitted median imputation / standardisation.

Fitting statistics (medians, means, stds, class counts) are one-row aggregates
cross-joined back (broadcast scalars); per-feature medians are one grouped
quantile over the unpivoted features, not one job per column.
"""
from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Callable, Iterator, Sequence, TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import io as IO
from .quantiles import group_quantiles

LABEL = "y_surge_next_week"
SENTINEL = -1.0e9
#: Training rows per task.
ROWS_PER_TASK = 50_000
#: Tree nodes per task that stores them.
NODES_PER_TASK = 5_000
T = TypeVar("T")


def join_features_targets(features: DataFrame, targets: DataFrame, how: str = "inner",
                          keys=("state_territory", "week_end")) -> DataFrame:
    return features.join(targets, list(keys), how)


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """``class_weight='balanced'``: n / (2 n_c) per class, as a small frame."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = c.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    return c.crossJoin(tot).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias("w"))


def impute_median(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of train medians per column (``SimpleImputer(strategy='median')``)."""
    long = train.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], list(cols), "__f", "__v")
    med = group_quantiles(long, ["__f"], "__v", [0.5], ["__m"])
    return med.groupBy().pivot("__f", list(cols)).agg(F.first("__m"))


def standardize_stats(train_imputed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std per column (``StandardScaler``); std 0 -> 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__mu_{c}"), F.stddev_pop(c).alias(f"__sd_{c}")]
    return train_imputed.agg(*aggs)


def apply_impute(df: DataFrame, med: DataFrame, cols) -> DataFrame:
    m = med.select(*[F.col(c).alias(f"__med_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(m))
    j = j.withColumns({f"i_{c}": F.coalesce(F.col(c).cast("double"), F.col(f"__med_{c}"), F.lit(0.0))
                       for c in cols})
    return j.drop(*[f"__med_{c}" for c in cols])


def apply_scale(df: DataFrame, stats: DataFrame, cols) -> DataFrame:
    j = df.crossJoin(F.broadcast(stats))
    sd = {c: F.when(F.coalesce(F.col(f"__sd_{c}"), F.lit(0.0)) == 0, F.lit(1.0))
          .otherwise(F.col(f"__sd_{c}")) for c in cols}
    j = j.withColumns({f"s_{c}": (F.col(f"i_{c}") - F.col(f"__mu_{c}")) / sd[c] for c in cols})
    return j.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])


def sentinel_columns(df: DataFrame, cols) -> DataFrame:
    """Boosted trees reject NaN: sentinel below every value + an is-missing indicator."""
    return df.withColumns({
        **{f"g_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(SENTINEL))
           for c in cols},
        **{f"m_{c}": F.col(c).isNull().cast("double") for c in cols},
    })


@dataclass
class FittedModels:
    features: list
    med: DataFrame
    scale: DataFrame
    weights: DataFrame
    majority: int
    lr: PipelineModel
    rf: PipelineModel
    gbt: PipelineModel


def gbt_inputs(cols) -> list:
    return [f"g_{c}" for c in cols] + [f"m_{c}" for c in cols]


@dataclass
class Preprocessing:
    med: DataFrame       # one row: train medians
    scale: DataFrame     # one row: mean / population std of the imputed train columns
    weights: DataFrame   # balanced class weights (<= 2 rows)
    majority: int
    n: int


def fit_preprocessing(train: DataFrame, cols: Sequence[str]) -> Preprocessing:
    """Train-fitted imputation, standardisation and class weights (small aggregates)."""
    cols = list(cols)
    med = impute_median(train, cols)
    imp = apply_impute(train, med, cols)
    stats = standardize_stats(imp, [f"i_{c}" for c in cols]).select(
        *[F.col(f"__mu_i_{c}").alias(f"__mu_{c}") for c in cols],
        *[F.col(f"__sd_i_{c}").alias(f"__sd_{c}") for c in cols])
    w = class_weights(train, "label")
    rows = w.collect()                                             # at most two rows
    counts = {r["label"]: r["w"] for r in rows}
    majority = int(min(counts, key=lambda k: (counts[k], k))) if counts else 0
    n = max(int(train.agg(F.count(F.lit(1)).alias("n")).first()["n"]), 1)   # scalar
    return Preprocessing(med, stats, w, majority, n)


def labelled(train: DataFrame) -> DataFrame:
    return train.where(F.col(LABEL).isNotNull()).withColumn("label", F.col(LABEL).cast("double"))


def fit_all(train: DataFrame, cols: Sequence[str], rf_trees: int = 200, rf_depth: int = 30,
            gbt_iter: int = 200, seed: int = 42) -> FittedModels:
    cols = list(cols)
    train = labelled(train)
    pp = fit_preprocessing(train, cols)
    med, stats, w, majority, n = pp.med, pp.scale, pp.weights, pp.majority, pp.n
    imp = apply_impute(train, med, cols)
    prepared = apply_scale(sentinel_columns(imp, cols), stats, cols).join(F.broadcast(w), "label")
    # iterative learners re-read their input in every job: cut the lineage once, in tasks of a
    # size that is worth a job
    prepared = cut_lineage(prepared.coalesce(max(1, -(-n // ROWS_PER_TASK))))
    lr = Pipeline(stages=[
        VectorAssembler(inputCols=[f"s_{c}" for c in cols], outputCol="v_lr"),
        LogisticRegression(featuresCol="v_lr", labelCol="label", weightCol="w", maxIter=1000,
                           regParam=1.0 / n, elasticNetParam=0.0, standardization=False,
                           predictionCol="lr_pred", probabilityCol="lr_prob",
                           rawPredictionCol="lr_raw")])
    rf = Pipeline(stages=[
        VectorAssembler(inputCols=[f"i_{c}" for c in cols], outputCol="v_rf"),
        RandomForestClassifier(featuresCol="v_rf", labelCol="label", weightCol="w",
                               numTrees=rf_trees, maxDepth=rf_depth, seed=seed,
                               featureSubsetStrategy="sqrt", predictionCol="rf_pred",
                               probabilityCol="rf_prob", rawPredictionCol="rf_raw")])
    gbt = Pipeline(stages=[
        VectorAssembler(inputCols=gbt_inputs(cols), outputCol="v_gbt"),
        GBTClassifier(featuresCol="v_gbt", labelCol="label", maxIter=gbt_iter, stepSize=0.05,
                      maxDepth=4, seed=seed, predictionCol="gbt_pred")
        .setProbabilityCol("gbt_prob").setRawPredictionCol("gbt_raw")])
    # the learners read the same written rows and do not wait for each other
    fitted = concurrently(train.sparkSession, [lambda p=p: without_summary(p.fit(prepared)) for p in (lr, rf, gbt)])
    return FittedModels(cols, med, stats, w, majority, *fitted)


def without_summary(model: PipelineModel) -> PipelineModel:
    """``model`` without its learner's training summary.

    A summary holds the session.  Its scoring functions take the whole model to the tasks, and a
    session that has observed a table cannot be serialised (Spark 4.1).  A copy of a forest has no
    summary; storing it instead would put all its nodes into the driver's memory several times.  A
    linear model keeps it in a copy, so that small model is stored and loaded again."""
    if not getattr(model.stages[-1], "hasSummary", False):
        return model
    model = model.copy()
    if not model.stages[-1].hasSummary:
        return model
    path = os.path.join(ensure_checkpoint_dir(SparkSession.active()), f"fitted-{uuid.uuid4().hex}")
    model.write().save(path)
    return PipelineModel.load(path)


@contextmanager
def driver_rows_in_tasks(rows: int, per_task: int) -> Iterator[None]:
    """Within, a table made of ``rows`` of the driver goes out in tasks of about ``per_task`` rows.

    Spark serialises the rows of every running task in the driver; by default they are dealt over
    no more tasks than there are cores."""
    spark, name = SparkSession.active(), "spark.sql.leafNodeDefaultParallelism"
    before = spark.conf.get(name, None)
    tasks = -(-rows // per_task)
    if tasks <= int(before or spark.sparkContext.defaultParallelism):
        yield
        return
    spark.conf.set(name, str(tasks))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def concurrently(spark: SparkSession, tasks: Sequence[Callable[[], T]]) -> list[T]:
    """Results of ``tasks``, run at the same time as Spark jobs of one session.

    The threads inherit the caller's job group and properties, so cancelling the caller's group
    ends them all; each has a scheduler pool of its own, which a FAIR scheduler deals evenly.
    """
    def pooled(number: int, task: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"surgeflow-{number}")
            return task()
        return inheritable_thread_target(spark)(run)

    targets = [pooled(k, t) for k, t in enumerate(tasks)]
    with ThreadPoolExecutor(max(1, len(targets))) as threads:
        return [f.result() for f in [threads.submit(t) for t in targets]]


def cross_validate(folds: Sequence[tuple[int, DataFrame, DataFrame]], cols: Sequence[str], **fit) -> DataFrame:
    """``long_predictions`` of every model of every (fold, train, test), with ``fold``.

    The folds are fitted at the same time; each one's predictions are written, so the metrics
    of all folds are one pass over rows that no model is asked for twice."""
    def one(fold: int, train: DataFrame, test: DataFrame) -> DataFrame:
        scored = long_predictions(score_batch(fit_all(train, cols, **fit), test))
        return cut_lineage(scored.withColumn("fold", F.lit(fold)))

    parts = concurrently(folds[0][1].sparkSession, [lambda f=f: one(*f) for f in folds])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


MODEL_NAMES = {"lr": "Logistic Regression", "rf": "Random Forest", "gbt": "Gradient-boosted trees"}


def score_batch(fm: FittedModels, df: DataFrame) -> DataFrame:
    """All fitted models chained on one DataFrame: class + probability per model, wide."""
    cols = fm.features
    x = apply_scale(sentinel_columns(apply_impute(df, fm.med, cols), cols), fm.scale, cols)
    keys = [k for k in MODEL_NAMES if getattr(fm, k) is not None]
    for k in keys:
        x = getattr(fm, k).transform(x)
    margin = [vector_to_array(F.col("gbt_raw"))[1].alias("gbt_margin")] if fm.gbt is not None else []
    out = x.select("state_territory", "week_end",
                   F.col(LABEL).cast("int").alias("actual"),
                   *[F.col(f"{k}_pred").cast("int").alias(f"{k}_pred") for k in keys],
                   *[vector_to_array(F.col(f"{k}_prob"))[1].alias(f"{k}_proba") for k in keys],
                   *margin)
    return out.withColumns({"majority_pred": F.lit(fm.majority).cast("int"),
                            "majority_proba": F.lit(float(fm.majority))})


def long_predictions(wide: DataFrame) -> DataFrame:
    """(model, state, week, label, prediction, score) for the metric report."""
    parts = []
    for k, name in list(MODEL_NAMES.items()) + [("majority", "Majority-class baseline")]:
        if f"{k}_pred" not in wide.columns:
            continue
        parts.append(wide.select(F.lit(name).alias("model"), "state_territory", "week_end",
                                 F.col("actual").alias("label"), F.col(f"{k}_pred").alias("prediction"),
                                 F.col(f"{k}_proba").alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preprocessing_stage(fm: FittedModels) -> SQLTransformer:
    """Imputation, scaling and sentinels as one persistable stage with literal statistics.

    The statistics are one row per table (a value per feature)."""
    med, scale = fm.med.first().asDict(), fm.scale.first().asDict()
    parts = []
    for c in fm.features:
        x = f"CAST(`{c}` AS DOUBLE)"
        middle = med[c] if med[c] is not None else 0.0
        mean, sd = scale[f"__mu_{c}"] or 0.0, scale[f"__sd_{c}"] or 1.0
        filled = f"coalesce({x}, {middle!r}D)"
        parts += [f"{filled} AS i_{c}", f"({filled} - {mean!r}D) / {sd!r}D AS s_{c}",
                  f"coalesce(nanvl({x}, NULL), {SENTINEL!r}D) AS g_{c}",
                  f"CAST(`{c}` IS NULL AS DOUBLE) AS m_{c}"]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def save_models(fm: FittedModels, root: str, metrics: DataFrame | None = None) -> None:
    """Each learner with its preprocessing as one pipeline, the feature list and the metrics.

    A loaded pipeline selects its features by name, so it scores raw rows with any other
    columns beside them."""
    spark = fm.med.sparkSession
    for k in MODEL_NAMES:
        if getattr(fm, k) is not None:
            stages = [preprocessing_stage(fm), *getattr(fm, k).stages]
            with driver_rows_in_tasks(getattr(stages[-1], "totalNumNodes", 0), NODES_PER_TASK):
                PipelineModel(stages).write().overwrite().save(os.path.join(root, k))
    IO.save_feature_list(spark, fm.features, os.path.join(root, "features"))
    if metrics is not None:
        metrics.write.mode("overwrite").parquet(os.path.join(root, "metrics"))


def load_model(root: str, key: str) -> PipelineModel:
    return PipelineModel.load(os.path.join(root, key))


def score_stored(root: str, key: str, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and ``score`` of a stored pipeline."""
    IO.require_columns(df, IO.load_feature_list(df.sparkSession, os.path.join(root, "features")))
    return load_model(root, key).transform(df).select(
        *[df[c] for c in df.columns], F.col(f"{key}_pred").cast("int").alias("prediction"),
        vector_to_array(F.col(f"{key}_prob"))[1].alias("score"))


def strength(prob_col: str = "confidence"):
    """High >= .75, Moderate >= .50, else Low, on the predicted class's probability."""
    p = F.col(prob_col)
    return F.when(p >= 0.75, "High").when(p >= 0.5, "Moderate").otherwise("Low")
