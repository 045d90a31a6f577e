"""Registered model, scoring and attribution queries.

Model fits are not SQL-expressible (no oracle; pytest checks them); the fitting
statistics (medians, standardisation) and the latest-row features have DuckDB twins.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import MODEL_FEATURES, TOP4_DEPENDENCE
from ..operators import attribution as XP
from ..operators import metrics as M
from ..operators import models as ML
from ..operators.quantiles import group_quantiles
from ..operators.score import latest_features, score_latest
from . import oracle_sql as O
from .catalog import R, register
from ..session import cut_lineage, ensure_checkpoint_dir
from .stages import _CACHE, LABEL_TABLES, SAMPLE_TABLES, _key, era_matrix, finish, panel

FEATS = list(MODEL_FEATURES)


def train_test(spark, sf_dir):
    k = _key(spark, "tt", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        feats, targets = era_matrix(spark, sf_dir)
        df = cut_lineage(ML.join_features_targets(feats, targets, "inner"))
        _CACHE[k] = (df.where(F.col("split_era") == "train"), df.where(F.col("split_era") == "test"))
    return _CACHE[k]


def fitted(spark, sf_dir) -> ML.FittedModels:
    k = _key(spark, "models", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        tr, _ = train_test(spark, sf_dir)
        _CACHE[k] = ML.fit_all(tr, FEATS)
    return _CACHE[k]


def predictions(spark, sf_dir):
    k = _key(spark, "pred", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        _, te = train_test(spark, sf_dir)
        _CACHE[k] = cut_lineage(ML.score_batch(fitted(spark, sf_dir), te))
    return _CACHE[k]


# ------------------------------------------------------------------ fitting statistics

_FSQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS).replace(
    "CAST(month AS DOUBLE)", "CAST(month(week_end) AS DOUBLE)").replace(
    "CAST(epiweek_of_year AS DOUBLE)", "CAST(weekofyear(week_end) AS DOUBLE)")
O.CTE["t_long"] = (f"SELECT state_territory, week_end, feature, v FROM "
                   f"(SELECT state_territory, week_end, {_FSQL} FROM p_era WHERE split_era = 'train') "
                   f"UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(FEATS)}))")
O.CTE["t_med"] = "SELECT feature, quantile_cont(v, 0.5) AS med FROM t_long GROUP BY feature"


@register("ml_impute_median", O.sql("SELECT feature, " + R("med", "median") + " FROM t_med"))
def q_impute(spark, sf_dir):
    tr, _ = train_test(spark, sf_dir)
    long = tr.select(*[F.col(c).cast("double").alias(c) for c in FEATS]) \
        .unpivot([], FEATS, "feature", "v")
    return finish(group_quantiles(long, ["feature"], "v", [0.5], ["median"]))


@register("ml_standardize", O.sql(
    "SELECT l.feature, " + R("avg(COALESCE(l.v, m.med, 0.0))", "mean") + ", "
    + R("stddev_pop(COALESCE(l.v, m.med, 0.0))", "std")
    + " FROM t_long l LEFT JOIN t_med m ON l.feature = m.feature GROUP BY l.feature"))
def q_standardize(spark, sf_dir):
    tr, _ = train_test(spark, sf_dir)
    s = ML.fit_preprocessing(ML.labelled(tr), FEATS).scale
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"__mu_{c}").alias("mean"),
                     F.col(f"__sd_{c}").alias("std")) for c in FEATS]
    return finish(s.select(F.inline(F.array(*rows))))


# ------------------------------------------------------------------ models (rows-only)

def _one(spark, sf_dir, k):
    p = predictions(spark, sf_dir)
    return finish(p.select("state_territory", "week_end", "actual", f"{k}_pred", f"{k}_proba"))


@register("ml_logreg_balanced")
def q_lr(spark, sf_dir):
    return _one(spark, sf_dir, "lr")


@register("ml_rf_balanced")
def q_rf(spark, sf_dir):
    return _one(spark, sf_dir, "rf")


@register("ml_gbt")
def q_gbt(spark, sf_dir):
    return _one(spark, sf_dir, "gbt")


@register("ml_score_batch")
def q_score_batch(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return finish(p.select("state_territory", "week_end", "actual",
                           *[c for c in p.columns if c.endswith("_pred") or c.endswith("_proba")]))


@register("ml_model_report")
def q_model_report(spark, sf_dir):
    return finish(M.model_order(M.report(ML.long_predictions(predictions(spark, sf_dir)))))


def stored_models(spark, sf_dir) -> str:
    """Folder of the stored pipelines, their feature list and their metrics on the test rows."""
    k = _key(spark, "store", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        root = os.path.join(ensure_checkpoint_dir(spark), f"model-store-{uuid.uuid4().hex}")
        ML.save_models(fitted(spark, sf_dir), root, M.report(ML.long_predictions(predictions(spark, sf_dir))))
        _CACHE[k] = root
    return _CACHE[k]


@register("ml_pipeline_select")
def q_pipeline(spark, sf_dir):
    """A stored pipeline scores raw test rows with extra columns, feature list included."""
    _, te = train_test(spark, sf_dir)
    scored = ML.score_stored(stored_models(spark, sf_dir), "gbt", te.withColumn("extra", F.lit("x")))
    return finish(scored.select("state_territory", "week_end", "extra", "prediction", "score"))


@register("mt_reproduce_check")
def q_reproduce(spark, sf_dir):
    """Every metric of every stored pipeline against the stored record."""
    root = stored_models(spark, sf_dir)
    _, te = train_test(spark, sf_dir)
    again = None
    for k, name in ML.MODEL_NAMES.items():
        part = ML.score_stored(root, k, te).select(F.lit(name).alias("model"), F.col(ML.LABEL).cast("int").alias("label"),
                                                   "prediction", "score")
        again = part if again is None else again.unionByName(part)
    names = ["accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "roc_auc", "pr_auc"]
    stored = spark.read.parquet(os.path.join(root, "metrics"))
    both = M.metric_long(stored, names, baseline=None).withColumnRenamed("value", "stored").join(
        M.metric_long(M.report(again), names, baseline=None).withColumnRenamed("value", "reproduced"), ["model", "metric"])
    same = F.coalesce(F.abs(F.col("stored") - F.col("reproduced")) < 1e-9, F.col("stored").eqNullSafe(F.col("reproduced")))
    return finish(both.withColumn("same", same))


@register("sp_cross_val_scores")
def q_cv(spark, sf_dir):
    """Rolling-origin evaluation of every model and the majority baseline: mean and sd of
    AUC / F1 over the folds with a test slice and two classes in training; the number of
    folds without is in ``folds_skipped``."""
    from ..config import PanelConfig
    from ..operators.matrix import add_temporal_geo
    base = add_temporal_geo(panel(spark, sf_dir).ready)
    wk, y, known, counts = F.col("week_end"), F.col(ML.LABEL), [], []
    for i, (start, train_end, test_end) in enumerate(PanelConfig().folds, 1):
        a, b, c = (F.lit(d).cast("date") for d in (start, train_end, test_end))
        train, test = (wk >= a) & (wk < b), (wk >= b) & (wk < c)
        known.append((i, train, test))
        counts += [F.count_if(test).alias(f"test_{i}"), F.count_if(train & (y == 0)).alias(f"no_{i}"),
                   F.count_if(train & (y == 1)).alias(f"yes_{i}")]
    seen = base.agg(*counts).first()                               # one row
    folds = [(i, base.where(train), base.where(test)) for i, train, test in known
             if seen[f"test_{i}"] and seen[f"no_{i}"] and seen[f"yes_{i}"]]
    if not folds:
        return spark.createDataFrame([], "model string, folds long, roc_auc_mean double, "
                                     "roc_auc_sd double, f1_mean double, f1_sd double, "
                                     "folds_skipped int")
    found = ML.cross_validate(folds, FEATS)
    # one report over (fold, model)
    both = M.report(found.withColumn("model", F.concat_ws("|", "fold", "model")))
    return finish(both.groupBy(F.substring_index("model", "|", -1).alias("model")).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("roc_auc").alias("roc_auc_mean"),
        F.stddev_samp("roc_auc").alias("roc_auc_sd"), F.avg("f1").alias("f1_mean"),
        F.stddev_samp("f1").alias("f1_sd")).withColumn("folds_skipped", F.lit(len(known) - len(folds))))


# ------------------------------------------------------------------ latest-row scoring

O.CTE["l_feat"] = """
SELECT state_territory, week_end, log10_conc_mean,
  lag(log10_conc_mean, 1) OVER w AS log10_conc_lag1, lag(log10_conc_mean, 2) OVER w AS log10_conc_lag2,
  lag(log10_conc_mean, 3) OVER w AS log10_conc_lag3,
  avg(log10_conc_mean) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS conc_roll3,
  row_number() OVER (PARTITION BY state_territory ORDER BY week_end DESC) AS rn
FROM s_weekly WINDOW w AS (PARTITION BY state_territory ORDER BY week_end)"""
O.CTE["l_hosp"] = """
SELECT state_territory, week_end AS hosp_week_end, admits, coverage FROM (
  SELECT *, row_number() OVER (PARTITION BY state_territory ORDER BY week_end DESC) AS rn FROM h_labels)
WHERE rn = 1"""


@register("wn_latest_row", O.sql(
    "SELECT f.state_territory, f.week_end, " + R("f.log10_conc_mean", "log10_conc_mean")
    + ", h.hosp_week_end, " + R("h.admits", "admits") + ", " + R("h.coverage", "coverage")
    + ", CAST(date_diff('day', h.hosp_week_end, f.week_end) AS INTEGER) AS week_gap_days "
    "FROM l_feat f LEFT JOIN l_hosp h ON f.state_territory = h.state_territory WHERE f.rn = 1"))
def q_latest_row(spark, sf_dir):
    p = panel(spark, sf_dir)
    lf = latest_features(p.samples.weekly, p.labels)
    return finish(lf.select("state_territory", "week_end", "log10_conc_mean", "hosp_week_end",
                            "admits", "coverage", "week_gap_days"))


@register("wn_latest_lags", O.sql(
    "SELECT state_territory, week_end, " + ", ".join(R(c, c) for c in (
        "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3", "conc_roll3"))
    + ", " + R("log10_conc_mean - log10_conc_lag1", "conc_delta_1w")
    + ", CAST(month(week_end) AS INTEGER) AS month, CAST(weekofyear(week_end) AS INTEGER) AS epiweek_of_year "
    "FROM l_feat WHERE rn = 1"))
def q_latest_lags(spark, sf_dir):
    p = panel(spark, sf_dir)
    lf = latest_features(p.samples.weekly, p.labels)
    return finish(lf.select("state_territory", "week_end", "log10_conc_lag1", "log10_conc_lag2",
                            "log10_conc_lag3", "conc_roll3", "conc_delta_1w", "month",
                            "epiweek_of_year"))


@register("ml_score_latest")
def q_score_latest(spark, sf_dir):
    p = panel(spark, sf_dir)
    return finish(score_latest(fitted(spark, sf_dir), latest_features(p.samples.weekly, p.labels)))


@register("ml_strength_latest")
def q_strength(spark, sf_dir):
    p = panel(spark, sf_dir)
    s = score_latest(fitted(spark, sf_dir), latest_features(p.samples.weekly, p.labels))
    return s.groupBy("strength").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ attribution (rows-only)

def contributions(spark, sf_dir):
    k = _key(spark, "xp", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        fm = fitted(spark, sf_dir)
        _, te = train_test(spark, sf_dir)
        x = ML.sentinel_columns(te, fm.features)
        gbt = fm.gbt.stages[-1]
        inputs = ML.gbt_inputs(fm.features)
        group_of = {c: c[2:] for c in inputs}
        _CACHE[k] = cut_lineage(XP.tree_contributions(x, gbt, inputs, group_of=group_of))
    return _CACHE[k]


@register("xp_tree_contrib")
def q_tree_contrib(spark, sf_dir):
    w = contributions(spark, sf_dir)
    phis = [c for c in w.columns if c.startswith("phi_")]
    total = sum((F.col(c) for c in phis), F.lit(0.0)) + F.col("base")
    p = predictions(spark, sf_dir).select("state_territory", "week_end", "gbt_margin")
    j = w.join(p, ["state_territory", "week_end"])
    return finish(j.withColumn("additive", F.abs(total - F.col("margin")) < 1e-6)
                  .withColumn("matches_model", F.abs(F.col("margin") - 2 * F.col("gbt_margin")) < 1e-6))


@register("xp_tree_mean_abs_rank")
def q_mean_abs(spark, sf_dir):
    return finish(XP.mean_abs_rank(XP.to_long(contributions(spark, sf_dir))))


@register("xp_tree_dependence")
def q_dependence(spark, sf_dir):
    long = XP.to_long(contributions(spark, sf_dir)).where(F.col("feature").isin(*TOP4_DEPENDENCE))
    _, te = train_test(spark, sf_dir)
    vals = te.select("state_territory", "week_end", *[F.col(c).cast("double").alias(c)
                                                       for c in TOP4_DEPENDENCE]) \
        .unpivot(["state_territory", "week_end"], list(TOP4_DEPENDENCE), "feature", "value")
    return finish(long.join(vals, ["state_territory", "week_end", "feature"]))


@register("xp_local_waterfall")
def q_waterfall(spark, sf_dir):
    """First TP and first FN (by state, week) with their 12 largest contributions + the rest."""
    p = predictions(spark, sf_dir)
    outcome = F.when((F.col("actual") == 1) & (F.col("gbt_pred") == 1), "true_positive") \
        .when((F.col("actual") == 1) & (F.col("gbt_pred") == 0), "false_negative")
    first = p.withColumn("outcome", outcome).where(F.col("outcome").isNotNull()) \
        .groupBy("outcome").agg(F.min_by(F.struct("state_territory", "week_end", "gbt_proba"),
                                         F.struct("state_territory", "week_end")).alias("r")) \
        .select("outcome", "r.*")
    long = XP.to_long(contributions(spark, sf_dir))
    j = long.join(first, ["state_territory", "week_end"])
    w = Window.partitionBy("outcome").orderBy(F.abs("contribution").desc(), "feature")
    j = j.withColumn("rank", F.row_number().over(w))   # <= 17 rows per example
    top = j.where(F.col("rank") <= 12)
    rest = j.where(F.col("rank") > 12).groupBy("outcome", "state_territory", "week_end", "gbt_proba") \
        .agg(F.sum("contribution").alias("contribution")) \
        .withColumns({"feature": F.lit("other features"), "rank": F.lit(13)})
    return finish(top.unionByName(rest))


@register("xp_linear_contrib")
def q_linear(spark, sf_dir):
    fm = fitted(spark, sf_dir)
    lr = fm.lr.stages[-1]
    _, te = train_test(spark, sf_dir)
    x = ML.apply_scale(ML.apply_impute(te, fm.med, fm.features), fm.scale, fm.features)
    coef = list(lr.coefficients.toArray())
    out = XP.linear_contributions(x, coef, [f"s_{c}" for c in fm.features], {})
    return finish(out.select("state_territory", "week_end",
                             *[F.col(f"phi_s_{c}").alias(f"phi_{c}") for c in fm.features]))


@register("so_first_match_model")
def q_first_match(spark, sf_dir):
    p = predictions(spark, sf_dir)
    outcome = F.when((F.col("actual") == 1) & (F.col("gbt_pred") == 1), "true_positive") \
        .when((F.col("actual") == 1) & (F.col("gbt_pred") == 0), "false_negative")
    return finish(p.withColumn("outcome", outcome).where(F.col("outcome").isNotNull())
                  .groupBy("outcome").agg(F.min_by(F.struct("state_territory", "week_end"),
                                                   F.struct("state_territory", "week_end")).alias("r"))
                  .select("outcome", "r.*"))
