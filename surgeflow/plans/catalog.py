"""

Every builder takes ``(spark, sf_dir)``, reads the driver's tables through the
adapters and returns a DataFrame whose columns are named exactly like the
DuckDB twin in ``ORACLE``.  Doubles are rounded by ``finish``.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PanelConfig
from ..operators import clean_labels as CL
from ..operators import clean_samples as CS
from ..operators import panel as P
from ..session import cut_lineage
from ..sources import fixtures as fx
from . import oracle_sql as O
from .stages import era_matrix, finish, labels, panel, samples

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


R = O.R

# ---------------------------------------------------------------- samples side

WEEKLY_SQL_COLS = ", ".join([
    "state_territory", "week_end", R("log10_conc_mean", "log10_conc_mean"),
    R("log10_conc_median", "log10_conc_median"), R("conc_site_z_mean", "conc_site_z_mean"),
    "n_samples", "n_sites", R("pct_nondetect", "pct_nondetect"), "pop_served", "pop_served_distinct"])


@register("ag_weekly_state", O.sql(f"SELECT {WEEKLY_SQL_COLS} FROM s_weekly"))
def q_weekly(spark, sf_dir):
    return finish(samples(spark, sf_dir).weekly)


@register("fl_min_support", O.sql(
    "SELECT CAST(count(*) AS BIGINT) AS state_weeks, "
    "CAST(count(*) FILTER (WHERE n_sites >= 2) AS BIGINT) AS supported FROM s_weekly_all"))
def q_min_support(spark, sf_dir):
    w = samples(spark, sf_dir).weekly_all
    return w.agg(F.count(F.lit(1)).alias("state_weeks"),
                 F.count_if(F.col("n_sites") >= 2).alias("supported"))


@register("ag_global_median", O.sql(f"SELECT {R('med_lod', 'med_lod')} FROM s_medlod"))
def q_global_median(spark, sf_dir):
    return finish(samples(spark, sf_dir).med_lod)


@register("fl_dedupe_first", O.sql(
    "SELECT site, sample_collect_date, gene AS pcr_gene_target_agg, sample_matrix, "
    "l_orderkey AS first_orderkey, l_linenumber AS first_linenumber, "
    + R("conc2", "conc") + ", nondetect_flag FROM s_dedup"))
def q_dedupe(spark, sf_dir):
    d = samples(spark, sf_dir).deduped
    return finish(d.select("site", "sample_collect_date", "pcr_gene_target_agg", "sample_matrix",
                           F.col("__ord.l_orderkey").alias("first_orderkey"),
                           F.col("__ord.l_linenumber").alias("first_linenumber"),
                           "conc", "nondetect_flag"))


SCORED_SQL = O.sql(
    "SELECT site, sample_collect_date, gene AS pcr_gene_target_agg, sample_matrix, "
    + ", ".join([R("log10_conc", "log10_conc"), R("robust_z", "robust_z"), "outlier_flag",
                 R("conc_site_z", "conc_site_z"), "week_end"]) + " FROM s_scored")


@register("wn_site_scores", SCORED_SQL)
def q_scored(spark, sf_dir):
    s = samples(spark, sf_dir).scored
    from ..functions.calendar import week_end_saturday
    return finish(s.select("site", "sample_collect_date", "pcr_gene_target_agg", "sample_matrix",
                           "log10_conc", "robust_z", "outlier_flag", "conc_site_z",
                           week_end_saturday("sample_collect_date").alias("week_end")))


@register("wn_site_stats", O.sql(
    "SELECT m.site, " + R("m.med", "site_median") + ", " + R("d.mad", "site_mad") + ", "
    + R("m.sd", "site_std") + " FROM s_site_med m JOIN s_site_mad d ON m.site = d.site"))
def q_site_stats(spark, sf_dir):
    from ..operators.quantiles import group_quantiles
    s = samples(spark, sf_dir).scored
    med = cut_lineage(group_quantiles(s, ["site"], "log10_conc", [0.5], ["site_median"], stored=True))
    dev = s.join(med, "site").select("site", F.abs(F.col("log10_conc") - F.col("site_median")).alias("d"))
    mad = group_quantiles(dev, ["site"], "d", [0.5], ["site_mad"], stored=True)
    sd = s.groupBy("site").agg(F.stddev_samp("log10_conc").alias("site_std"))
    return finish(med.join(mad, "site").join(sd, "site"))


STEP_SQL = O.sql("""
SELECT step, rows_remaining, reason FROM (
  SELECT 0 AS o, '00_raw_load' AS step, CAST(count(*) AS BIGINT) AS rows_remaining, 'as delivered' AS reason FROM s_raw
  UNION ALL SELECT 1, '01_valid_dates', CAST(count(*) AS BIGINT), 'drop unparseable sample_collect_date' FROM s_raw WHERE sample_collect_date IS NOT NULL
  UNION ALL SELECT 2, '02_conc_not_null', CAST(count(*) AS BIGINT), 'drop rows with no target concentration' FROM s_raw WHERE sample_collect_date IS NOT NULL AND conc0 IS NOT NULL AND NOT isnan(conc0)
  UNION ALL SELECT 3, '03_units_copies_per_L', CAST(count(*) AS BIGINT), 'drop units that cannot be converted to copies/L' FROM s_typed WHERE units_h = 'copies/l wastewater'
  UNION ALL SELECT 4, '04_matrix_filter', CAST(count(*) AS BIGINT), 'keep the comparable liquid sample matrices' FROM s_kept
  UNION ALL SELECT 5, '05_nondetect_LOD_half', CAST(count(*) AS BIGINT), 'zeros replaced by LOD/2, flagged in nondetect_flag' FROM s_kept
  UNION ALL SELECT 6, '06_dedupe', CAST(count(*) AS BIGINT), 'keep the first row per site/date/gene/matrix' FROM s_dedup
  UNION ALL SELECT 7, '08_outlier_flagged', CAST(count(*) AS BIGINT), 'site-relative outliers flagged, not dropped' FROM s_dedup
  UNION ALL SELECT 8, '10_weekly_state_agg', CAST(count(*) AS BIGINT), 'aggregate site-days to state-weeks' FROM s_weekly_all
  UNION ALL SELECT 9, '11_min_sites', CAST(count(*) AS BIGINT), 'drop state-weeks backed by too few sites' FROM s_weekly
)""")


@register("au_step_log", STEP_SQL)
def q_step_log(spark, sf_dir):
    return CS.sample_step_log(samples(spark, sf_dir))


@register("au_side_counts", O.sql("""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM s_typed WHERE is_log) AS log_unit_rows,
       (SELECT CAST(sum(nondetect_flag) AS BIGINT) FROM s_subst) AS nondetects,
       (SELECT CAST(count(*) AS BIGINT) FROM s_subst) - (SELECT CAST(count(*) AS BIGINT) FROM s_dedup)
           AS duplicates_removed,
       (SELECT CAST(sum(outlier_flag) AS BIGINT) FROM s_scored) AS outliers_flagged,
       (SELECT CAST(count(*) AS BIGINT) FROM p_feat WHERE NOT gap_ok) AS gap_rows_voided"""))
def q_side_counts(spark, sf_dir):
    voided = panel(spark, sf_dir).counts["gap_voided"]
    return CS.sample_side_counts(samples(spark, sf_dir)).withColumn("gap_rows_voided", F.lit(voided).cast("long"))


# ---------------------------------------------------------------- label side

@register("clean_labels", O.sql(
    "SELECT state_territory, week_end, " + R("admits", "admits") + ", "
    + R("coverage", "coverage") + ", regime FROM h_labels"))
def q_labels(spark, sf_dir):
    return finish(labels(spark, sf_dir)[0])


@register("fl_drop_rollups", O.sql(
    "SELECT CAST(count(*) AS BIGINT) AS rows_in, "
    "CAST(count(*) FILTER (WHERE fail IS NULL OR fail <> '22_drop_rollups') AS BIGINT) AS rows_kept "
    "FROM h_tagged"))
def q_drop_rollups(spark, sf_dir):
    t = CL.tag_labels(fx.hospital_raw(spark, sf_dir))
    return t.agg(F.count(F.lit(1)).alias("rows_in"),
                 F.count_if(~F.coalesce(F.col("__fail") == "22_drop_rollups", F.lit(False)))
                 .alias("rows_kept"))


@register("au_label_log", O.sql("""
SELECT step, rows_remaining, reason FROM (
  SELECT '20_raw_load' AS step, CAST(count(*) AS BIGINT) AS rows_remaining, 'as delivered' AS reason FROM h_tagged
  UNION ALL SELECT '21_valid_date_and_admits', CAST(count(*) FILTER (WHERE fail IS NULL OR fail > '21_valid_date_and_admits') AS BIGINT), 'drop unparseable dates / null admissions' FROM h_tagged
  UNION ALL SELECT '22_drop_rollups', CAST(count(*) FILTER (WHERE fail IS NULL OR fail > '22_drop_rollups') AS BIGINT), 'drop national and regional roll-up rows' FROM h_tagged
  UNION ALL SELECT '23_drop_voluntary_window', CAST(count(*) FILTER (WHERE fail IS NULL) AS BIGINT), 'drop the voluntary-reporting window' FROM h_tagged
)"""))
def q_label_log(spark, sf_dir):
    return CL.label_step_log(fx.hospital_raw(spark, sf_dir))


@register("ag_value_counts", O.sql(
    "SELECT regime, CAST(count(*) AS BIGINT) AS n FROM h_tagged "
    "WHERE (fail IS NULL OR fail = '23_drop_voluntary_window') AND regime IS NOT NULL GROUP BY regime"))
def q_value_counts(spark, sf_dir):
    return CL.regime_counts(fx.hospital_raw(spark, sf_dir))


@register("ag_low_coverage", O.sql(
    "SELECT CAST(count(*) FILTER (WHERE coverage < 0.8) AS BIGINT) AS low_coverage_weeks, "
    + R("avg(CASE WHEN coverage < 0.8 THEN 1.0 ELSE 0.0 END)", "low_coverage_share")
    + ", min(week_end) AS first_week, max(week_end) AS last_week, "
    "CAST(count(DISTINCT state_territory) AS BIGINT) AS n_states, CAST(count(*) AS BIGINT) AS n_rows "
    "FROM h_labels"))
def q_low_coverage(spark, sf_dir):
    return finish(CL.low_coverage(labels(spark, sf_dir)[0]))


# ---------------------------------------------------------------- panel

PANEL_DOUBLES = ("log10_conc_mean", "log10_conc_median", "conc_site_z_mean", "pct_nondetect",
                 "admits", "coverage", "admits_per100k", "admits_next_week", "admits_this_week",
                 "y_reg_next_admits", "pct_change_next", "log10_conc_lag1", "log10_conc_lag2",
                 "log10_conc_lag3", "conc_delta_1w", "conc_roll3")


def _panel_sql_cols(extra=()):
    out = []
    for c in P.PANEL_COLUMNS + tuple(extra):
        out.append(R(c, c) if c in PANEL_DOUBLES else c)
    return ", ".join(out)


@register("jn_state_week", O.sql(
    "SELECT state_territory, week_end, " + R("log10_conc_mean", "log10_conc_mean") + ", "
    + R("admits", "admits") + ", " + R("coverage", "coverage") + ", regime FROM p_joined"))
def q_join(spark, sf_dir):
    j = panel(spark, sf_dir).joined
    return finish(j.select("state_territory", "week_end", "log10_conc_mean", "admits",
                           "coverage", "regime"))


@register("jn_zero_match_guard", O.sql("""
SELECT CAST(count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS BIGINT) AS matched_keys,
       CAST(count(*) FILTER (WHERE b.k IS NULL) AS BIGINT) AS left_only_keys,
       CAST(count(*) FILTER (WHERE a.k IS NULL) AS BIGINT) AS right_only_keys
FROM (SELECT DISTINCT state_territory, week_end, 1 AS k FROM s_weekly) a
FULL OUTER JOIN (SELECT DISTINCT state_territory, week_end, 1 AS k FROM h_labels) b
  ON a.state_territory = b.state_territory AND a.week_end = b.week_end"""))
def q_zero_match(spark, sf_dir):
    p = panel(spark, sf_dir)
    return P.zero_match_guard(p.samples.weekly, p.labels)


@register("lb_model_ready", O.sql(f"SELECT {_panel_sql_cols()} FROM p_ready"))
def q_model_ready(spark, sf_dir):
    return finish(panel(spark, sf_dir).ready)


@register("wn_panel_features", O.sql(
    f"SELECT {_panel_sql_cols()} FROM p_feat"))
def q_features(spark, sf_dir):
    return finish(panel(spark, sf_dir).features.select(*P.PANEL_COLUMNS))


@register("wn_group_median_as_of", O.sql(
    "SELECT state_territory, week_end, " + R("so_far", "state_median") + ", CASE WHEN next_admits IS NULL OR next_week IS "
    "NULL OR next_week - week_end <> 7 THEN NULL ELSE CAST(coalesce((next_admits - admits) / nullif(admits, 0) > "
    f"{PanelConfig().surge_threshold} AND next_admits > so_far, false) AS INTEGER) END AS y_surge_next_week FROM ("
    "SELECT state_territory, week_end, admits, lead(admits) OVER w AS next_admits, lead(week_end) OVER w AS next_week, "
    "quantile_cont(admits, 0.5) OVER (PARTITION BY state_territory ORDER BY week_end ROWS UNBOUNDED PRECEDING) AS so_far "
    "FROM p_joined WINDOW w AS (PARTITION BY state_territory ORDER BY week_end))"))
def q_median_as_of(spark, sf_dir):
    """The state median of the weeks so far, and the label that it gives, without look-ahead."""
    cfg = PanelConfig(median_as_of="current")
    joined = panel(spark, sf_dir).joined
    labelled = P.build_features(P.state_median(joined, "state_median", cfg), cfg)
    return finish(labelled.select("state_territory", "week_end", "state_median", "y_surge_next_week"))


@register("sp_flag_column", O.sql(f"SELECT {_panel_sql_cols(('split_era',))} FROM p_era"))
def q_era(spark, sf_dir):
    return finish(panel(spark, sf_dir).era.select(*P.PANEL_COLUMNS, "split_era"))


@register("sp_quantile_cut", O.sql(
    "SELECT CAST(DATE '1970-01-01' + CAST(floor(cut_days) AS INTEGER) AS DATE) AS cut_date, "
    + R("cut_days - floor(cut_days)", "cut_day_fraction") + " FROM p_cut"))
def q_cut(spark, sf_dir):
    return finish(P.cut_date(panel(spark, sf_dir).ready))


FOLDS_SQL = """
SELECT * FROM (VALUES (1, DATE '1997-01-01', DATE '1998-01-01', DATE '1998-07-01'),
                      (2, DATE '1997-01-01', DATE '1998-07-01', DATE '1999-01-01'),
                      (3, DATE '1997-01-01', DATE '1999-01-01', DATE '1999-07-01'),
                      (4, DATE '1997-01-01', DATE '2000-01-01', DATE '2000-07-01'))
  AS t(fold, start, train_end, test_end)"""


@register("sp_rolling_origin", O.sql("""
SELECT fold, train_n, test_n, """ + R("round(tr, 3)", "train_rate") + ", "
                                    + R("round(te, 3)", "test_rate") + """, train_end, test_end FROM (
  SELECT f.fold, f.train_end, f.test_end,
         CAST(count(*) FILTER (WHERE r.week_end < f.train_end) AS BIGINT) AS train_n,
         CAST(count(*) FILTER (WHERE r.week_end >= f.train_end) AS BIGINT) AS test_n,
         avg(CASE WHEN r.week_end < f.train_end THEN CAST(r.y_surge_next_week AS DOUBLE) END) AS tr,
         avg(CASE WHEN r.week_end >= f.train_end THEN CAST(r.y_surge_next_week AS DOUBLE) END) AS te
  FROM p_ready r JOIN folds f ON r.week_end >= f.start AND r.week_end < f.test_end
  GROUP BY f.fold, f.train_end, f.test_end) WHERE test_n > 0""", extra={"folds": FOLDS_SQL}))
def q_folds(spark, sf_dir):
    return finish(P.rolling_origin(panel(spark, sf_dir).ready))


@register("ag_fold_rates", O.sql(
    "SELECT split_era, CAST(count(*) AS BIGINT) AS n, "
    + R("avg(CAST(y_surge_next_week AS DOUBLE))", "base_rate")
    + ", min(week_end) AS first_week, max(week_end) AS last_week FROM p_era GROUP BY split_era"))
def q_fold_rates(spark, sf_dir):
    return finish(P.fold_rates(panel(spark, sf_dir).era))


@register("au_panel_log", O.sql("""
SELECT step, rows_remaining, reason FROM (
  SELECT '30_wastewater_weekly' AS step, CAST(count(*) AS BIGINT) AS rows_remaining, 'weekly signal table' AS reason FROM s_weekly
  UNION ALL SELECT '30b_hospital_weekly', CAST(count(*) AS BIGINT), 'weekly label table' FROM h_labels
  UNION ALL SELECT '31_joined_weekly', CAST(count(*) AS BIGINT), 'join on state + week' FROM p_feat
  UNION ALL SELECT '32_model_ready', CAST(count(*) AS BIGINT), 'require label + >= 1 lag' FROM p_ready)"""))
def q_panel_log(spark, sf_dir):
    p = panel(spark, sf_dir)
    return P.panel_step_log(spark, p.samples.weekly_counts["n_support"], p.label_rows, p.counts)


@register("ag_null_report", O.sql("""
SELECT 'log10_conc_lag1' AS "column", CAST(count(*) FILTER (WHERE log10_conc_lag1 IS NULL) AS BIGINT) AS n_null FROM p_era
UNION ALL SELECT 'log10_conc_lag2', CAST(count(*) FILTER (WHERE log10_conc_lag2 IS NULL) AS BIGINT) FROM p_era
UNION ALL SELECT 'log10_conc_lag3', CAST(count(*) FILTER (WHERE log10_conc_lag3 IS NULL) AS BIGINT) FROM p_era"""))
def q_null_report(spark, sf_dir):
    return P.null_report(panel(spark, sf_dir).era)


MATRIX_SQL_FEATURES = ", ".join([
    "state_territory", "week_end", R("log10_conc_mean", "log10_conc_mean"),
    R("log10_conc_median", "log10_conc_median"), R("conc_site_z_mean", "conc_site_z_mean"),
    "n_samples", "n_sites", R("pct_nondetect", "pct_nondetect"), "pop_served",
    R("admits", "admits"), R("coverage", "coverage"), R("admits_per100k", "admits_per100k"),
    R("log10_conc_lag1", "log10_conc_lag1"), R("log10_conc_lag2", "log10_conc_lag2"),
    R("log10_conc_lag3", "log10_conc_lag3"), R("conc_delta_1w", "conc_delta_1w"),
    R("conc_roll3", "conc_roll3"), "split_era",
    "CAST(month(week_end) AS INTEGER) AS month",
    "CAST(weekofyear(week_end) AS INTEGER) AS epiweek_of_year",
    "CAST(COALESCE(regime = 'mandatory_post', false) AS INTEGER) AS regime_mandatory_post",
    "CAST(COALESCE(regime = 'mandatory_pre', false) AS INTEGER) AS regime_mandatory_pre",
    "CAST(COALESCE(regime = 'voluntary', false) AS INTEGER) AS regime_voluntary",
    "CAST(month(week_end) >= 9 AND month(week_end) <= 11 AS INTEGER) AS season_fall",
    "CAST(month(week_end) >= 3 AND month(week_end) <= 5 AS INTEGER) AS season_spring",
    "CAST(month(week_end) >= 6 AND month(week_end) <= 8 AS INTEGER) AS season_summer",
    "CAST(month(week_end) IN (12, 1, 2) AS INTEGER) AS season_winter",
    "0 AS region_midwest", "0 AS region_northeast", "0 AS region_south",
    "1 AS region_territory", "0 AS region_west"])


@register("sc_onehot", O.sql(f"SELECT {MATRIX_SQL_FEATURES} FROM p_era"))
def q_matrix(spark, sf_dir):
    feats, _ = era_matrix(spark, sf_dir)
    return finish(feats)


@register("lb_leakage_split", O.sql(
    "SELECT state_territory, week_end, " + R("admits_next_week", "admits_next_week") + ", "
    + R("y_reg_next_admits", "y_reg_next_admits") + ", " + R("pct_change_next", "pct_change_next")
    + ", y_surge_next_week, next_week_end FROM p_era"))
def q_targets(spark, sf_dir):
    _, tg = era_matrix(spark, sf_dir)
    return finish(tg)


# further registrations (imported for their side effect on QUERIES / ORACLE)
from . import catalog_eval  # noqa: E402,F401
from . import catalog_stats  # noqa: E402,F401
from . import catalog_models  # noqa: E402,F401
from . import catalog_ids  # noqa: E402,F401
from . import catalog_checks  # noqa: E402,F401
