"""Registered evaluation-metric queries (labels.quality vs a documents.n_chars score)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import fixtures as fx
from . import oracle_sql as O
from .catalog import R, register
from .stages import finish

BASELINE = "Majority-class baseline"

O.CTE["e_sc"] = """
SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 5000.0) AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

O.CTE["e_major"] = """
SELECT label AS major FROM (SELECT label, count(*) AS c FROM e_sc GROUP BY label)
ORDER BY c DESC, label ASC LIMIT 1"""

O.CTE["e_long"] = """
SELECT 'chars' AS model, label, CAST(score >= 0.5 AS INTEGER) AS prediction, score FROM e_sc
UNION ALL
SELECT '""" + BASELINE + """', label, m.major, CAST(m.major AS DOUBLE) FROM e_sc CROSS JOIN e_major m"""

O.CTE["e_cnt"] = """
SELECT model, score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
FROM e_long GROUP BY model, score"""

O.CTE["e_cum"] = """
SELECT model, score, pos, neg,
  COALESCE(sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_above,
  COALESCE(sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above
FROM e_cnt"""

O.CTE["e_rank"] = """
SELECT model,
  CASE WHEN count(*) >= 2 AND sum(pos) > 0 AND sum(neg) > 0
       THEN sum(neg * (pos_above + pos / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc,
  CASE WHEN count(*) >= 2 AND sum(pos) > 0 AND sum(neg) > 0
       THEN sum(CASE WHEN pos > 0 THEN pos * (pos_above + pos) / (pos_above + pos + neg_above + neg) END)
            / sum(pos) END AS pr_auc,
  CAST(sum(pos) + sum(neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives
FROM e_cum GROUP BY model"""

O.CTE["e_cm"] = """
SELECT model,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn
FROM e_long GROUP BY model"""


def _z(a, b):
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF({b}, 0), 0.0)"


O.CTE["e_rates"] = f"""
SELECT model, tp, fp, fn, tn,
  {_z('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_z('tp', 'tp + fp')} AS precision,
  {_z('tp', 'tp + fn')} AS recall, {_z('tn', 'tn + fp')} AS specificity,
  ({_z('tp', 'tp + fn')} + {_z('tn', 'tn + fp')}) / 2.0 AS balanced_accuracy,
  {_z('2 * tp', '2 * tp + fp + fn')} AS f1
FROM e_cm"""

O.CTE["e_report"] = """
SELECT r.model, r.accuracy, r.balanced_accuracy, r.precision, r.recall, r.specificity, r.f1,
       k.roc_auc, k.pr_auc, r.tp, r.fp, r.fn, r.tn
FROM e_rates r LEFT JOIN e_rank k ON r.model = k.model"""

RATE_COLS = ("accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1")


def scores(spark, sf_dir):
    s = fx.scores(spark, sf_dir)
    return s.select("doc_id", "label", (F.col("score") / (F.col("score") + 5000.0)).alias("score"))


def majority(df, label="label"):
    """Most frequent class, ties to the smaller label (one-row frame)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    return c.agg(F.min_by(label, F.struct((-F.col("c")).alias("nc"), F.col(label))).alias("major"))


def long_scores(spark, sf_dir):
    s = scores(spark, sf_dir)
    a = s.select(F.lit("chars").alias("model"), "label",
                 (F.col("score") >= 0.5).cast("int").alias("prediction"), "score")
    b = s.crossJoin(F.broadcast(majority(s))).select(
        F.lit(BASELINE).alias("model"), "label", F.col("major").alias("prediction"),
        F.col("major").cast("double").alias("score"))
    return a.unionByName(b)


@register("mt_roc_auc", O.sql("SELECT " + R("roc_auc", "roc_auc") + ", " + R("pr_auc", "pr_auc")
                              + ", n, positives FROM e_rank WHERE model = 'chars'"))
def q_auc(spark, sf_dir):
    return finish(M.auc_ap(scores(spark, sf_dir)))


@register("mt_avg_precision", O.sql("SELECT model, " + R("pr_auc", "pr_auc") + " FROM e_rank"))
def q_ap(spark, sf_dir):
    return finish(M.auc_ap(long_scores(spark, sf_dir), group=("model",)).select("model", "pr_auc"))


@register("mt_roc_curve", O.sql(
    "SELECT " + R("score", "threshold") + ", " + R("(neg_above + neg) / (SELECT sum(neg) FROM e_cum WHERE model = 'chars')", "fpr")
    + ", " + R("(pos_above + pos) / (SELECT sum(pos) FROM e_cum WHERE model = 'chars')", "tpr")
    + " FROM e_cum WHERE model = 'chars' UNION ALL SELECT NULL, 0.0, 0.0"))
def q_roc(spark, sf_dir):
    return finish(M.roc_curve(scores(spark, sf_dir)))


@register("mt_pr_curve", O.sql(
    "SELECT " + R("score", "threshold") + ", "
    + R("(pos_above + pos) / (pos_above + pos + neg_above + neg)", "precision") + ", "
    + R("(pos_above + pos) / (SELECT sum(pos) FROM e_cum WHERE model = 'chars')", "recall")
    + " FROM e_cum WHERE model = 'chars' UNION ALL SELECT NULL, 1.0, 0.0"))
def q_pr(spark, sf_dir):
    return finish(M.pr_curve(scores(spark, sf_dir)))


@register("mt_confusion", O.sql("SELECT model, tp, fp, fn, tn FROM e_cm"))
def q_cm(spark, sf_dir):
    return M.confusion(long_scores(spark, sf_dir), group=("model",))


@register("mt_rates", O.sql("SELECT model, tp, fp, fn, tn, "
                            + ", ".join(R(c, c) for c in RATE_COLS) + " FROM e_rates"))
def q_rates(spark, sf_dir):
    return finish(M.rates(M.confusion(long_scores(spark, sf_dir), group=("model",))))


REPORT_SQL_COLS = ", ".join(["model"] + [R(c, c) for c in RATE_COLS + ("roc_auc", "pr_auc")]
                            + ["tp", "fp", "fn", "tn"])


@register("mt_report_table", O.sql(f"SELECT {REPORT_SQL_COLS} FROM e_report"))
def q_report(spark, sf_dir):
    return finish(M.report(long_scores(spark, sf_dir)))


@register("so_model_order", O.sql(
    "SELECT model, " + R("f1", "f1") + ", CAST(row_number() OVER (ORDER BY CASE WHEN model = '"
    + BASELINE + "' THEN 0 ELSE 1 END, f1 DESC, model) AS INTEGER) AS position FROM e_report"))
def q_model_order(spark, sf_dir):
    from pyspark.sql import Window
    m = M.report(long_scores(spark, sf_dir))
    w = Window.orderBy(F.when(F.col("model") == BASELINE, 0).otherwise(1), F.col("f1").desc(),
                       F.col("model"))
    # the metric table has one row per model: a global window over it is bounded
    return finish(m.select("model", "f1", F.row_number().over(w).cast("int").alias("position")))


@register("mt_metric_long", O.sql(
    "SELECT model, metric, " + R("value", "value") + " FROM (SELECT * FROM e_report WHERE model <> '" + BASELINE + "') UNPIVOT INCLUDE NULLS (value FOR metric IN "
    "(accuracy, balanced_accuracy, precision, recall, f1, roc_auc))"))
def q_metric_long(spark, sf_dir):
    return finish(M.metric_long(M.report(long_scores(spark, sf_dir))))


@register("mt_confusion_report", O.sql(
    "SELECT model, printf('### %s | n=%d base rate=%.3f | TN=%d FP=%d FN=%d TP=%d | recall=%.3f specificity=%.3f "
    "precision=%.3f F1=%.3f | accuracy=%.3f balanced_acc=%.3f | ROC-AUC=%s PR-AUC=%s', model, tp + fp + fn + tn, "
    "CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn), tn, fp, fn, tp, recall, specificity, precision, f1, accuracy, "
    "balanced_accuracy, coalesce(printf('%.3f', roc_auc), 'n/a'), coalesce(printf('%.3f', pr_auc), 'n/a')) AS line "
    "FROM e_report"))
def q_cm_report(spark, sf_dir):
    return M.confusion_lines(M.report(long_scores(spark, sf_dir)))


@register("ag_prevalence", O.sql("SELECT " + R("avg(CAST(label AS DOUBLE))", "prevalence") + " FROM e_sc"))
def q_prev(spark, sf_dir):
    return finish(M.prevalence(scores(spark, sf_dir)))


@register("ml_dummy_majority", O.sql("SELECT major FROM e_major"))
def q_major(spark, sf_dir):
    return majority(scores(spark, sf_dir))
