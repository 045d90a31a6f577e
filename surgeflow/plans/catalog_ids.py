"""

Most scalar, filter and window operators are columns or predicates of a stage
query; these ids point at the query whose output exercises them (same builder,
same DuckDB twin).  A few get a dedicated projection of their own.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.semantics import coerce_double, dtype_of, text_norm
from ..operators import models as ML
from ..sources import fixtures as fx
from . import oracle_sql as O
from .catalog import ORACLE, QUERIES, R, register
from .stages import era_matrix, finish, samples

# id -> query that computes it
ALIASES = {
    "sc_nondetect_flag": "fl_dedupe_first", "sc_lod_half": "fl_dedupe_first",
    "sc_log10_clip": "wn_site_scores", "wn_robust_z": "wn_site_scores",
    "wn_outlier_flag": "wn_site_scores", "wn_site_z": "wn_site_scores",
    "wn_site_median": "wn_site_stats", "wn_site_mad": "wn_site_stats",
    "sc_regime_case": "clean_labels", "sc_pct_to_fraction": "clean_labels",
    
    "fl_drop_window": "au_label_log",
    "fl_unit_equals": "au_step_log", "fl_in_list": "au_step_log",
    "sc_per_capita": "wn_panel_features", "wn_lead_next": "wn_panel_features",
    "wn_gap_guard": "wn_panel_features", "wn_group_median": "wn_panel_features",
    "wn_lags": "wn_panel_features", "wn_delta1": "wn_panel_features", "wn_roll3": "wn_panel_features",
    "sc_pct_change": "lb_model_ready", "sc_safe_ratio": "lb_model_ready",
    "lb_reg_next": "lb_model_ready", "lb_surge": "lb_model_ready", "fl_require_label_lag": "lb_model_ready",
    "fl_date_range": "sp_flag_column",
    "sc_month": "sc_onehot", "sc_iso_week": "sc_onehot", "sc_season_bins": "sc_onehot",
    
    "sc_minmax_scale": "ed_trend_scaled", "fl_complete_pairs": "ed_z_vs_next",
    "ed_scatter_fits": "ag_linear_fit",
    "sc_pad_code": "ed_explode_codes", "ed_county_diff": "st_difference_both",
    "st_concat_values": "ag_hist_fd", "ed_distributions": "ag_hist_fd",
    "ag_relabel_other": "wn_share_of_group", "ed_method_mix": "ag_pivot_share",
    "ed_method_popularity": "ag_tail_to_other", "ed_method_effect": "ag_box_stats",
    
}

for _id, _target in ALIASES.items():
    QUERIES[_id] = QUERIES[_target]
    if _target in ORACLE:
        ORACLE[_id] = ORACLE[_target]


@register("sc_week_end_sat", O.sql(
    "SELECT DISTINCT sample_collect_date, week_end FROM s_scored"))
def q_week_end(spark, sf_dir):
    from ..functions.calendar import week_end_saturday
    s = samples(spark, sf_dir).scored
    return s.select("sample_collect_date",
                    week_end_saturday("sample_collect_date").alias("week_end")).distinct()


@register("sc_text_norm", O.sql(
    "SELECT lower(trim(units)) AS units_norm, CAST(count(*) AS BIGINT) AS n FROM s_raw GROUP BY 1"))
def q_text_norm(spark, sf_dir):
    r = fx.samples_raw(spark, sf_dir, dealt=False)
    return r.groupBy(text_norm("pcr_target_units").alias("units_norm")).agg(
        F.count(F.lit(1)).alias("n"))


@register("sc_unlog10", O.sql(
    "SELECT gene AS pcr_gene_target_agg, CAST(count(*) FILTER (WHERE is_log) AS BIGINT) AS log_rows, "
    + R("sum(conc)", "linear_conc_sum", 2) + " FROM s_typed GROUP BY gene"))
def q_unlog(spark, sf_dir):
    from ..config import LOG_UNIT_PREFIX
    from ..functions.semantics import prefix_test, unlog10
    r = fx.samples_raw(spark, sf_dir, dealt=False)
    is_log = prefix_test(text_norm("pcr_target_units"), LOG_UNIT_PREFIX)
    # a large-magnitude sum: 2 decimals keep the cross-engine comparison stable
    return finish(r.groupBy("pcr_gene_target_agg").agg(
        F.count_if(is_log).alias("log_rows"),
        F.sum(unlog10("pcr_target_avg_conc", is_log)).alias("linear_conc_sum")), digits=2)


@register("jn_features_targets_inner", O.sql(
    "SELECT state_territory, week_end, split_era, y_surge_next_week, " + R("log10_conc_mean", "log10_conc_mean")
    + " FROM p_era"))
def q_ft(spark, sf_dir):
    feats, targets = era_matrix(spark, sf_dir)
    j = ML.join_features_targets(feats, targets, "inner")
    return finish(j.select("state_territory", "week_end", "split_era", "y_surge_next_week",
                           "log10_conc_mean"))


@register("jn_features_targets_left", O.sql(
    "SELECT state_territory, week_end, y_surge_next_week FROM p_era WHERE split_era = 'test'"))
def q_ft_left(spark, sf_dir):
    feats, targets = era_matrix(spark, sf_dir)
    j = ML.join_features_targets(feats, targets, "left")
    return j.where(F.col("split_era") == "test").select("state_territory", "week_end",
                                                       "y_surge_next_week")


@register("ag_corr_target_rank", O.sql(
    "SELECT col_a AS feature, " + R("r", "r") + ", CAST(row_number() OVER (ORDER BY r DESC NULLS LAST, col_a) "
    "AS INTEGER) AS rank FROM (" + "\nUNION ALL ".join(
        [f"SELECT '{a}' AS col_a, p{i} AS r FROM c_agg" for i, (a, b) in
         enumerate(__import__('surgeflow.plans.catalog_stats', fromlist=['_PAIRS'])._PAIRS)
         if b == "y_reg_next_admits" and a != b]) + ")"))
def q_corr_target(spark, sf_dir):
    from pyspark.sql import Window
    from ..config import CORR_COLUMNS
    from ..operators.stats import corr_matrix
    from .stages import panel
    m = corr_matrix(panel(spark, sf_dir).ready, CORR_COLUMNS).where(
        (F.col("col_b") == "y_reg_next_admits") & (F.col("col_a") != "y_reg_next_admits"))
    w = Window.orderBy(F.col("r").desc_nulls_last(), "col_a")     # <= 10 rows
    return finish(m.select(F.col("col_a").alias("feature"), "r",
                           F.row_number().over(w).cast("int").alias("rank")))


# ------------------------------------------------------------------ edge I/O round trips
# Each writes a table derived from the given data to the shared checkpoint folder and
# reads it back through the edge reader under test.

def _export_dir(spark, name: str) -> str:
    import os
    import uuid
    from ..session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), "exports", f"{name}-{uuid.uuid4().hex}")


QUERIES["sc_prefix_test"] = QUERIES["fl_drop_rollups"]
ORACLE["sc_prefix_test"] = ORACLE["fl_drop_rollups"]


@register("io_write_table", O.sql(
    "SELECT state_territory, week_end, " + R("admits", "admits") + ", " + R("coverage", "coverage")
    + ", regime FROM h_labels"))
def q_write(spark, sf_dir):
    from ..sources import io as IO
    from .stages import labels
    path = _export_dir(spark, "labels")
    IO.write_table(labels(spark, sf_dir)[0], path, partition_by=("regime",))
    return finish(spark.read.parquet(path).select("state_territory", "week_end", "admits",
                                                  "coverage", "regime"))


@register("io_read_csv_dates", O.sql(
    "SELECT state_territory, week_end, n_samples, n_sites FROM s_weekly"))
def q_csv_dates(spark, sf_dir):
    from ..sources import io as IO
    path = _export_dir(spark, "weekly")
    IO.write_table(samples(spark, sf_dir).weekly.select("state_territory", "week_end", "n_samples",
                                                       "n_sites"), path, fmt="csv")
    return IO.read_csv_dates(spark, path, "state_territory string, week_end date, n_samples long, n_sites long")


@register("io_read_csv_corrupt", O.sql(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END "
    "AS o_orderdate, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey, "
    "o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS is_corrupt FROM orders"))
def q_csv_corrupt(spark, sf_dir):
    """Short and long lines, impossible dates and text in a number column, read with their records kept."""
    from ..sources import io as IO
    path = _export_dir(spark, "orders")
    key = F.col("o_orderkey")
    date = F.when(key % 7 == 0, F.lit("1995-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    customer = F.when(key % 11 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    extra = F.when((key % 13 == 0) & (key % 5 != 0), F.lit("more"))
    line = F.when(key % 5 == 0, key.cast("string")).otherwise(F.concat_ws(",", key.cast("string"), date, customer, extra))
    fx.read(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    back = IO.read_csv_declared(spark, path, "o_orderkey long, o_orderdate date, o_custkey long",
                                ["o_orderkey", "o_orderdate", "o_custkey"], header=False)
    return back.select("o_orderkey", "o_orderdate", "o_custkey", F.col(IO.CORRUPT).isNotNull().alias("is_corrupt"))


@register("io_read_csv_projected", O.sql(
    "SELECT jurisdiction, CAST(strftime(wk, '%Y-%m-%d') AS VARCHAR) AS weekendingdate, "
    + R("admits", "totalconfc19newadm") + " FROM h_raw"))
def q_csv_projected(spark, sf_dir):
    from ..sources import io as IO
    path = _export_dir(spark, "hospital")
    IO.write_table(fx.hospital_raw(spark, sf_dir), path, fmt="csv")
    cols = ["jurisdiction", "weekendingdate", "totalconfc19newadm"]
    back = IO.read_csv_projected(spark, path, cols, schema=", ".join(
        f"{c} string" for c in cols + ["totalconfc19newadmperchosprep"]))
    return finish(back.select("jurisdiction", "weekendingdate",
                              coerce_double("totalconfc19newadm", dtype_of(back, "totalconfc19newadm"))
                              .alias("totalconfc19newadm")))
