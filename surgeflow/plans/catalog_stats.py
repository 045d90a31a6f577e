"""Registered statistics / EDA / coverage queries and their DuckDB twins."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import CORR_COLUMNS, HIST_COLUMNS, SCATTER_PREDICTORS
from ..functions.semantics import coerce_double, dtype_of, numeric_columns, text_norm
from ..operators import coverage as C
from ..operators import guards as G
from ..operators import stats as ST
from ..sources import fixtures as fx
from ..sources.io import profile_shape
from . import oracle_sql as O
from .catalog import R, register
from .stages import finish, panel

TARGET = "y_reg_next_admits"
LAGS = ("log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3")
TREND_YEAR = 1998
ONE_STATE = "nation_3"


def _pad(x: str) -> str:
    return f"CASE WHEN length({x}) < 5 THEN lpad({x}, 5, '0') ELSE {x} END"


# ------------------------------------------------------------------ correlation

def _corr(a: str, b: str) -> str:
    return (f"CASE WHEN regr_count({b}, {a}) >= 2 THEN regr_sxy({b}, {a}) / "
            f"NULLIF(sqrt(regr_sxx({b}, {a}) * regr_syy({b}, {a})), 0) END")


_PAIRS = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i:]]
O.CTE["c_agg"] = "SELECT " + ", ".join(f"{_corr(a, b)} AS p{i}" for i, (a, b) in enumerate(_PAIRS)) \
    + " FROM p_ready"
_CORR_ROWS = []
for _i, (_a, _b) in enumerate(_PAIRS):
    _CORR_ROWS.append(f"SELECT '{_a}' AS col_a, '{_b}' AS col_b, {R(f'p{_i}', 'r')} FROM c_agg")
    if _a != _b:
        _CORR_ROWS.append(f"SELECT '{_b}', '{_a}', {R(f'p{_i}', 'r')} FROM c_agg")


@register("ag_corr_matrix", O.sql("\nUNION ALL ".join(_CORR_ROWS)))
def q_corr_matrix(spark, sf_dir):
    return finish(ST.corr_matrix(panel(spark, sf_dir).ready, CORR_COLUMNS))


def _fit_sql(preds) -> str:
    rows = []
    for p in preds:
        y, x = TARGET, p
        rows.append(
            f"SELECT '{p}' AS predictor, CAST(regr_count({y}, {x}) AS BIGINT) AS n, "
            f"CASE WHEN regr_count({y}, {x}) >= 2 THEN regr_sxy({y}, {x}) / NULLIF(sqrt(regr_sxx({y}, {x}) * regr_syy({y}, {x})), 0) END AS r, "
            f"CASE WHEN regr_count({y}, {x}) >= 2 THEN regr_sxy({y}, {x}) / NULLIF(regr_sxx({y}, {x}), 0) END AS slope, "
            f"CASE WHEN regr_count({y}, {x}) >= 2 THEN regr_avgy({y}, {x}) - regr_sxy({y}, {x}) / NULLIF(regr_sxx({y}, {x}), 0) * regr_avgx({y}, {x}) END AS intercept "
            f"FROM p_ready")
    return "\nUNION ALL ".join(rows)


O.CTE["c_fits"] = _fit_sql(SCATTER_PREDICTORS)
O.CTE["c_lagfits"] = _fit_sql(LAGS)


@register("ag_linear_fit", O.sql(
    "SELECT predictor, n, " + R("r", "r") + ", " + R("slope", "slope") + ", "
    + R("intercept", "intercept") + ", " + R("r * r", "r2") + " FROM c_fits"))
def q_fits(spark, sf_dir):
    return finish(ST.linear_fits(panel(spark, sf_dir).ready, SCATTER_PREDICTORS, TARGET))


@register("ag_corr_pair", O.sql("SELECT predictor, n, " + R("r", "r") + " FROM c_fits"))
def q_corr_pair(spark, sf_dir):
    return finish(ST.linear_fits(panel(spark, sf_dir).ready, SCATTER_PREDICTORS, TARGET)
                  .select("predictor", "n", "r"))


@register("ag_corr_rank", O.sql(
    "SELECT predictor, " + R("r", "r") + ", CAST(row_number() OVER "
    "(ORDER BY abs(r) DESC NULLS LAST, predictor) AS INTEGER) AS rank FROM c_lagfits"))
def q_corr_rank(spark, sf_dir):
    return finish(ST.corr_rank(ST.linear_fits(panel(spark, sf_dir).ready, LAGS, TARGET)))


# ------------------------------------------------------------------ histograms

_INT_HIST = ("n_samples", "n_sites", "pop_served")
_UNP = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in HIST_COLUMNS)
O.CTE["hg_long"] = (
    f"SELECT 'rolling' AS dataset, \"column\", x FROM (UNPIVOT (SELECT {_UNP} FROM p_ready) "
    f"ON {', '.join(HIST_COLUMNS)} INTO NAME \"column\" VALUE x) WHERE x IS NOT NULL AND NOT isnan(x) "
    f"UNION ALL "
    f"SELECT 'era', \"column\", x FROM (UNPIVOT (SELECT {_UNP} FROM p_era) "
    f"ON {', '.join(HIST_COLUMNS)} INTO NAME \"column\" VALUE x) WHERE x IS NOT NULL AND NOT isnan(x)")
_W = "2.0 * (q3 - q1) * pow(CAST(n AS DOUBLE), -1.0 / 3.0)"
_WI = (f"CASE WHEN \"column\" IN ({', '.join(repr(c) for c in _INT_HIST)}) AND {_W} < 1.0 "
       f"THEN 1.0 ELSE {_W} END")
O.CTE["hg_edges"] = f"""
SELECT "column",
  CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
  CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
  CAST(greatest(CASE WHEN {_WI} > 0 THEN ceil((hi0 - lo0) / ({_WI})) ELSE 1 END, 1) AS BIGINT) AS n_bins
FROM (SELECT "column", min(x) AS lo0, max(x) AS hi0, count(*) AS n,
             quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
      FROM hg_long GROUP BY "column")"""
O.CTE["hg_bins"] = """
SELECT l."column", l.dataset, e.lo, e.hi, e.n_bins,
  CAST(least(floor((l.x - e.lo) / ((e.hi - e.lo) / e.n_bins)), e.n_bins - 1) AS BIGINT) AS bin
FROM hg_long l JOIN hg_edges e ON l."column" = e."column\""""


@register("ag_hist_fd", O.sql(
    "SELECT \"column\", dataset, bin, " + R("lo + bin * ((hi - lo) / n_bins)", "bin_lo") + ", "
    + R("lo + (bin + 1) * ((hi - lo) / n_bins)", "bin_hi") + ", n_bins, CAST(count(*) AS BIGINT) AS count "
    "FROM hg_bins GROUP BY \"column\", dataset, bin, lo, hi, n_bins"))
def q_hist(spark, sf_dir):
    p = panel(spark, sf_dir)
    return finish(ST.fd_histogram({"rolling": p.ready, "era": p.era}, HIST_COLUMNS))


# ------------------------------------------------------------------ group summaries (raw samples)

O.CTE["r_samples"] = "SELECT * FROM s_raw"
_NUM = ("pcr_target_avg_conc", "lod_sewage", "population_served", "flow_rate")


def raw_samples(spark, sf_dir):
    return fx.samples_raw(spark, sf_dir, dealt=False)


O.CTE["v_means"] = """
SELECT feature, state_raw, avg(v) AS m FROM (
  UNPIVOT (SELECT state_raw, CAST(conc0 AS DOUBLE) AS pcr_target_avg_conc, CAST(lod AS DOUBLE) AS lod_sewage,
                  CAST(population AS DOUBLE) AS population_served, CAST(flow_rate AS DOUBLE) AS flow_rate
           FROM s_raw)
  ON pcr_target_avg_conc, lod_sewage, population_served, flow_rate INTO NAME feature VALUE v)
GROUP BY feature, state_raw HAVING avg(v) IS NOT NULL"""


@register("ag_variation_rank", O.sql(
    "SELECT feature, " + R("sd", "territory_mean_std") + ", " + R("rg", "territory_mean_range")
    + ", rank FROM (SELECT feature, sd, rg, CAST(row_number() OVER (ORDER BY sd DESC, feature) AS INTEGER) AS rank "
    "FROM (SELECT feature, stddev_samp(m) AS sd, max(m) - min(m) AS rg, count(*) AS k FROM v_means GROUP BY feature) "
    "WHERE k >= 2) WHERE rank <= 10"))
def q_variation(spark, sf_dir):
    raw = raw_samples(spark, sf_dir)
    columns = numeric_columns(raw, exclude=("site", "record_id"))   # identifiers are no measurements
    return finish(ST.variation_rank(raw, "state_territory", columns, 10))


@register("ag_size_by_group", O.sql(
    "SELECT state_territory, CAST(count(*) AS BIGINT) AS sample_count FROM p_era GROUP BY state_territory"))
def q_size(spark, sf_dir):
    return panel(spark, sf_dir).era.groupBy("state_territory").agg(
        F.count(F.lit(1)).alias("sample_count"))


@register("ag_nunique_by_group", O.sql(
    "SELECT state_raw AS state_territory, CAST(count(DISTINCT site) AS BIGINT) AS site_count "
    "FROM s_raw GROUP BY state_raw"))
def q_nunique(spark, sf_dir):
    return raw_samples(spark, sf_dir).groupBy("state_territory").agg(
        F.countDistinct("site").alias("site_count"))


@register("ag_mean_by_group", O.sql(
    "SELECT state_raw AS state_territory, " + R("avg(conc0)", "pcr_target_avg_conc") + ", "
    + R("avg(flow_rate)", "flow_rate") + " FROM s_raw GROUP BY state_raw"))
def q_means(spark, sf_dir):
    r = raw_samples(spark, sf_dir)
    return finish(r.groupBy("state_territory").agg(
        F.avg(coerce_double("pcr_target_avg_conc", dtype_of(r, "pcr_target_avg_conc")))
        .alias("pcr_target_avg_conc"),
        F.avg(coerce_double("flow_rate", dtype_of(r, "flow_rate"))).alias("flow_rate")))


O.CTE["b_q"] = """
SELECT concentration_method AS method, count(*) AS n, quantile_cont(conc0, 0.25) AS q1,
       quantile_cont(conc0, 0.5) AS med, quantile_cont(conc0, 0.75) AS q3
FROM s_raw WHERE concentration_method IS NOT NULL AND conc0 IS NOT NULL GROUP BY concentration_method"""


def _methods(spark, sf_dir):
    r = raw_samples(spark, sf_dir)
    return r.select(text_norm("concentration_method").alias("concentration_method"),
                    coerce_double("pcr_target_avg_conc", dtype_of(r, "pcr_target_avg_conc"))
                    .alias("pcr_target_avg_conc"))


@register("ag_box_stats", O.sql(
    "SELECT b.method AS concentration_method, CAST(b.n AS BIGINT) AS n, " + R("b.q1", "q1") + ", "
    + R("b.med", "median") + ", " + R("b.q3", "q3") + ", "
    + R("min(CASE WHEN s.conc0 >= b.q1 - 1.5 * (b.q3 - b.q1) THEN s.conc0 END)", "whisker_lo") + ", "
    + R("max(CASE WHEN s.conc0 <= b.q3 + 1.5 * (b.q3 - b.q1) THEN s.conc0 END)", "whisker_hi")
    + " FROM b_q b JOIN s_raw s ON s.concentration_method = b.method AND s.conc0 IS NOT NULL "
    "GROUP BY b.method, b.n, b.q1, b.med, b.q3"))
def q_box(spark, sf_dir):
    return finish(ST.box_stats(_methods(spark, sf_dir), "concentration_method", "pcr_target_avg_conc"))


@register("ag_group_median_order", O.sql(
    "SELECT method AS concentration_method, " + R("med", "median")
    + ", CAST(row_number() OVER (ORDER BY med, method) AS INTEGER) AS position FROM b_q"))
def q_median_order(spark, sf_dir):
    b = ST.box_stats(_methods(spark, sf_dir), "concentration_method", "pcr_target_avg_conc")
    w = Window.orderBy("median", "concentration_method")   # one row per method: bounded
    return finish(b.select("concentration_method", "median",
                           F.row_number().over(w).cast("int").alias("position")))


# ------------------------------------------------------------------ category mix

O.CTE["m_cnt"] = """
SELECT lower(trim(pcr_type)) AS category, count(*) AS c FROM s_raw
WHERE pcr_type IS NOT NULL GROUP BY lower(trim(pcr_type))"""
O.CTE["m_rank"] = """
SELECT category, c, count(*) OVER () AS k, row_number() OVER (ORDER BY c ASC, category DESC) AS rn FROM m_cnt"""
O.CTE["m_tail"] = """
SELECT CASE WHEN k > 3 AND rn <= 3 THEN 'other' ELSE category END AS category, sum(c) AS c
FROM m_rank GROUP BY 1"""
O.CTE["m_rows"] = """
SELECT s.state_raw AS state_territory,
       CASE WHEN t.category IS NOT NULL THEN lower(trim(s.pcr_type)) ELSE 'other' END AS pcr_type
FROM s_raw s LEFT JOIN (SELECT category FROM m_tail WHERE category <> 'other') t
  ON lower(trim(s.pcr_type)) = t.category
WHERE s.pcr_type IS NOT NULL AND s.state_raw IS NOT NULL"""
O.CTE["m_share"] = """
SELECT state_territory, pcr_type, count(*) AS n,
       100.0 * count(*) / sum(count(*)) OVER (PARTITION BY state_territory) AS share
FROM m_rows GROUP BY state_territory, pcr_type"""


@register("ag_tail_to_other", O.sql(
    "SELECT category, CAST(c AS BIGINT) AS count, " + R("100.0 * c / sum(c) OVER ()", "share")
    + " FROM m_tail"))
def q_tail(spark, sf_dir):
    return finish(ST.tail_to_other(raw_samples(spark, sf_dir), "pcr_type"))


def _mix(spark, sf_dir):
    r = raw_samples(spark, sf_dir)
    kept = ST.tail_to_other(r, "pcr_type")
    rows = ST.relabel_other(r.where(F.col("pcr_type").isNotNull()), "pcr_type", kept)
    return rows.select("state_territory", "pcr_type")


@register("wn_share_of_group", O.sql(
    "SELECT state_territory, pcr_type, CAST(n AS BIGINT) AS n, " + R("share", "share") + " FROM m_share"))
def q_share(spark, sf_dir):
    d = _mix(spark, sf_dir).groupBy("state_territory", "pcr_type").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("state_territory")
    return finish(d.withColumn("share", 100.0 * F.col("n") / F.sum("n").over(w)))


@register("ag_pivot_share", O.sql(
    "SELECT state_territory, row_number() OVER (ORDER BY max(CASE WHEN pcr_type = 'ddpcr' THEN share END) DESC, "
    "state_territory) AS rank, " + ", ".join(
        R(f"COALESCE(max(CASE WHEN pcr_type = '{c}' THEN share END), 0.0)", c.replace("-", "_"))
        for c in ("ddpcr", "other", "qpcr"))
    + " FROM m_share GROUP BY state_territory HAVING max(CASE WHEN pcr_type = 'ddpcr' THEN share END) > 0"))
def q_pivot(spark, sf_dir):
    wide, cats = ST.pivot_share(_mix(spark, sf_dir), "state_territory", "pcr_type", "ddpcr")
    return finish(wide.select("state_territory", "rank", *[F.col(c).alias(c.replace("-", "_")) for c in cats]))


# ------------------------------------------------------------------ trends (min-max scaling)

def _scale_sql(src: str, where: str, a: str, b: str, na: str, nb: str) -> str:
    return (f"SELECT state_territory, week_end, "
            + R(f"CASE WHEN {a} IS NULL THEN NULL WHEN max({a}) OVER () = min({a}) OVER () THEN 0.0 "
                f"ELSE ({a} - min({a}) OVER ()) / (max({a}) OVER () - min({a}) OVER ()) END", na) + ", "
            + R(f"CASE WHEN {b} IS NULL THEN NULL WHEN max({b}) OVER () = min({b}) OVER () THEN 0.0 "
                f"ELSE ({b} - min({b}) OVER ()) / (max({b}) OVER () - min({b}) OVER ()) END", nb)
            + f" FROM {src} {where}")


@register("ed_trend_scaled", O.sql(_scale_sql("p_ready", "", "log10_conc_mean", "admits_this_week",
                                              "conc_scaled", "admits_scaled")))
def q_trend(spark, sf_dir):
    d = ST.minmax_scale(panel(spark, sf_dir).ready, ["log10_conc_mean", "admits_this_week"])
    return finish(d.select("state_territory", "week_end",
                           F.col("log10_conc_mean_scaled").alias("conc_scaled"),
                           F.col("admits_this_week_scaled").alias("admits_scaled")))


@register("ed_trend_year", O.sql(_scale_sql(
    "p_ready", f"WHERE week_end >= DATE '{TREND_YEAR}-01-01' AND week_end < DATE '{TREND_YEAR + 1}-01-01'",
    "log10_conc_mean", "admits_this_week", "conc_scaled", "admits_scaled")))
def q_trend_year(spark, sf_dir):
    r = panel(spark, sf_dir).ready.where(
        (F.col("week_end") >= F.lit(f"{TREND_YEAR}-01-01").cast("date"))
        & (F.col("week_end") < F.lit(f"{TREND_YEAR + 1}-01-01").cast("date")))
    d = ST.minmax_scale(r, ["log10_conc_mean", "admits_this_week"])
    return finish(d.select("state_territory", "week_end",
                           F.col("log10_conc_mean_scaled").alias("conc_scaled"),
                           F.col("admits_this_week_scaled").alias("admits_scaled")))


@register("ed_z_vs_next", O.sql(_scale_sql(
    "p_feat", "WHERE week_end IS NOT NULL AND conc_site_z_mean IS NOT NULL AND y_reg_next_admits IS NOT NULL",
    "conc_site_z_mean", "y_reg_next_admits", "zscore_scaled", "next_admits_scaled")))
def q_z_vs_next(spark, sf_dir):
    f = panel(spark, sf_dir).features.dropna(subset=["week_end", "conc_site_z_mean", TARGET])
    d = ST.minmax_scale(f, ["conc_site_z_mean", TARGET])
    return finish(d.select("state_territory", "week_end",
                           F.col("conc_site_z_mean_scaled").alias("zscore_scaled"),
                           F.col(f"{TARGET}_scaled").alias("next_admits_scaled")))


@register("ed_z_vs_next_filtered", O.sql(_scale_sql(
    "p_feat", "WHERE week_end IS NOT NULL AND conc_site_z_mean IS NOT NULL AND y_reg_next_admits IS NOT NULL "
    f"AND upper(trim(state_territory)) = upper('{ONE_STATE}') AND year(week_end) = {TREND_YEAR}",
    "conc_site_z_mean", "y_reg_next_admits", "zscore_scaled", "next_admits_scaled").replace(
        "state_territory, week_end", "upper(trim(state_territory)) AS state_territory, week_end", 1)))
def q_z_vs_next_filtered(spark, sf_dir):
    """One state (any case) in one year, scaled after the restriction; running it raises if no row is left."""
    f = G.usable_rows(panel(spark, sf_dir).features, ["conc_site_z_mean", TARGET], f" {ONE_STATE} ", TREND_YEAR)
    d = ST.minmax_scale(f, ["conc_site_z_mean", TARGET])
    return finish(d.select("state_territory", "week_end", F.col("conc_site_z_mean_scaled").alias("zscore_scaled"),
                           F.col(f"{TARGET}_scaled").alias("next_admits_scaled")))


@register("fl_state_upper", O.sql("SELECT upper(trim(state_territory)) AS state_territory, week_end, "
                                  f"{R('admits', 'admits')} FROM p_ready "
                                  f"WHERE upper(trim(state_territory)) = upper('{ONE_STATE}')"))
def q_state_upper(spark, sf_dir):
    """The upper-case variant; running it raises if the state has no row."""
    r = G.only_state(panel(spark, sf_dir).ready, ONE_STATE)
    return finish(r.select("state_territory", "week_end", "admits"))


@register("fl_min_rows_required", O.sql(
    f"SELECT count(*) AS n, {R('corr(y_reg_next_admits, conc_site_z_mean)', 'r')} FROM p_feat "
    "WHERE conc_site_z_mean IS NOT NULL AND y_reg_next_admits IS NOT NULL"))
def q_min_rows_required(spark, sf_dir):
    """Correlation of the complete pairs; running it raises if there are fewer than two."""
    pairs = G.complete_pairs(panel(spark, sf_dir).features, "conc_site_z_mean", TARGET)
    return finish(ST.linear_fits(pairs, ["conc_site_z_mean"], TARGET).select("n", "r"))


@register("fl_state", O.sql(f"SELECT state_territory, week_end, {R('admits', 'admits')} FROM p_ready "
                            f"WHERE state_territory = '{ONE_STATE}'"))
def q_state(spark, sf_dir):
    r = panel(spark, sf_dir).ready.where(F.col("state_territory") == ONE_STATE)
    return finish(r.select("state_territory", "week_end", "admits"))


@register("so_distinct_sorted", O.sql(
    "SELECT state_territory, CAST(row_number() OVER (ORDER BY state_territory) AS INTEGER) AS position "
    "FROM (SELECT DISTINCT state_territory FROM p_ready)"))
def q_states(spark, sf_dir):
    d = panel(spark, sf_dir).ready.select("state_territory").distinct()
    w = Window.orderBy("state_territory")     # one row per area: bounded
    return d.select("state_territory", F.row_number().over(w).cast("int").alias("position"))


@register("io_profile_shape", O.sql(
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(25 AS BIGINT) AS n_cols, '"
    + ",".join(["state_territory", "week_end", "log10_conc_mean", "log10_conc_median",
                "conc_site_z_mean", "n_samples", "n_sites", "pct_nondetect", "pop_served",
                "admits", "coverage", "regime", "admits_per100k", "admits_next_week",
                "admits_this_week", "y_reg_next_admits", "pct_change_next", "y_surge_next_week",
                "next_week_end", "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3",
                "conc_delta_1w", "conc_roll3", "split_era"]) + "' AS columns FROM p_era"))
def q_shape(spark, sf_dir):
    return profile_shape(panel(spark, sf_dir).era)


# ------------------------------------------------------------------ county coverage

O.CTE["k_sites"] = """
SELECT lower(n.n_name) AS state_territory, c.c_custkey AS site,
  CASE WHEN c.c_custkey % 3 = 0 THEN CAST(c.c_nationkey AS VARCHAR) || ',' || CAST(c.c_custkey % 40 AS VARCHAR)
       WHEN c.c_custkey % 3 = 1 THEN ' ' || CAST(c.c_nationkey AS VARCHAR) || ', ' || CAST((c.c_custkey + 7) % 40 AS VARCHAR)
       ELSE CAST(c.c_custkey % 40 AS VARCHAR) || ',' END AS county_fips
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
O.CTE["k_counties"] = """
SELECT upper(n.n_name) AS state_id, CAST(c.c_custkey % 40 AS VARCHAR) AS county_fips
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
O.CTE["k_codes"] = ("SELECT DISTINCT " + _pad("trim(p)") + " AS code FROM "
                    "(SELECT unnest(string_split(county_fips, ',')) AS p FROM k_sites WHERE county_fips IS NOT NULL)")
O.CTE["k_ref"] = ("SELECT DISTINCT " + _pad("county_fips") + " AS code FROM k_counties WHERE county_fips IS NOT NULL")
O.CTE["k_rucc"] = """
SELECT CAST(p.p_partkey % 60 AS VARCHAR) AS FIPS, n.n_name AS State, 'RUCC_2023' AS Attribute,
       CAST(p.p_size AS VARCHAR) AS Value
FROM part p JOIN nation n ON p.p_partkey % 25 = n.n_nationkey"""


def _site_codes(spark, sf_dir):
    return C.explode_codes(fx.site_counties(spark, sf_dir))


def _ref_codes(spark, sf_dir):
    return C.reference_codes(fx.county_list(spark, sf_dir))


@register("ed_explode_codes", O.sql("SELECT code FROM k_codes"))
def q_codes(spark, sf_dir):
    return _site_codes(spark, sf_dir)


@register("st_intersect", O.sql("SELECT code FROM k_codes INTERSECT SELECT code FROM k_ref"))
def q_intersect(spark, sf_dir):
    return _site_codes(spark, sf_dir).intersect(_ref_codes(spark, sf_dir))


@register("ed_county_coverage", O.sql(
    "SELECT CAST(count(k.code) AS BIGINT) AS represented, CAST(count(*) AS BIGINT) AS total, "
    + R("100.0 * count(k.code) / count(*)", "coverage_pct")
    + " FROM k_ref r LEFT JOIN k_codes k ON r.code = k.code"))
def q_coverage(spark, sf_dir):
    return finish(C.county_coverage(_site_codes(spark, sf_dir), _ref_codes(spark, sf_dir)))


@register("ed_unrepresented_by_state", O.sql(
    "SELECT lower(t.state_id) AS state_territory, "
    + R("100.0 * (t.total - COALESCE(r.rep, 0)) / t.total", "unrepresented_percentage")
    + " FROM (SELECT state_id, count(DISTINCT county_fips) AS total FROM k_counties "
    "WHERE state_id IS NOT NULL GROUP BY state_id) t LEFT JOIN ("
    "  SELECT c.state_id, count(*) AS rep FROM (SELECT DISTINCT state_id, " + _pad("county_fips")
    + " AS code FROM k_counties WHERE state_id IS NOT NULL) c JOIN ("
    "    SELECT DISTINCT upper(state_territory) AS st, " + _pad("trim(p)") + " AS code FROM ("
    "      SELECT state_territory, unnest(string_split(county_fips, ',')) AS p FROM k_sites "
    "      WHERE county_fips IS NOT NULL)) s ON c.state_id = s.st AND c.code = s.code "
    "  GROUP BY c.state_id) r ON t.state_id = r.state_id"))
def q_unrep(spark, sf_dir):
    return finish(C.unrepresented_by_state(fx.site_counties(spark, sf_dir), fx.county_list(spark, sf_dir)))


@register("st_difference_both", O.sql(
    "SELECT CAST(count(*) FILTER (WHERE b.code IS NULL) AS BIGINT) AS first_only, "
    "CAST(count(*) FILTER (WHERE a.code IS NULL) AS BIGINT) AS second_only "
    "FROM k_codes a FULL OUTER JOIN k_ref b ON a.code = b.code"))
def q_diff(spark, sf_dir):
    return C.difference_sizes(_site_codes(spark, sf_dir), _ref_codes(spark, sf_dir))


@register("ed_rucc_compare", O.sql(
    "SELECT (k.code IS NOT NULL) AS represented, " + R("avg(TRY_CAST(trim(r.Value) AS DOUBLE))", "mean_value")
    + ", CAST(count(*) AS BIGINT) AS n FROM (SELECT " + _pad("FIPS") + " AS code, upper(State) AS st, Value "
    "FROM k_rucc WHERE Attribute = 'RUCC_2023') r "
    "LEFT JOIN k_codes k ON r.code = k.code "
    "WHERE r.st IN (SELECT DISTINCT upper(state_territory) FROM k_sites WHERE state_territory IS NOT NULL) "
    "GROUP BY (k.code IS NOT NULL)"))
def q_rucc(spark, sf_dir):
    return finish(C.rucc_compare(fx.site_counties(spark, sf_dir), fx.rucc_long(spark, sf_dir),
                                 _site_codes(spark, sf_dir)))


@register("jn_semi_membership", O.sql(
    "SELECT r.code FROM (SELECT DISTINCT " + _pad("FIPS") + " AS code FROM k_rucc) r "
    "WHERE r.code IN (SELECT code FROM k_codes)"))
def q_semi(spark, sf_dir):
    r = fx.rucc_long(spark, sf_dir).select(F.col("FIPS").alias("code")).distinct() \
        .select(C.pad_code(F.col("code")).alias("code"))
    return r.join(_site_codes(spark, sf_dir), "code", "left_semi")


@register("jn_anti_membership", O.sql(
    "SELECT r.code FROM (SELECT DISTINCT " + _pad("FIPS") + " AS code FROM k_rucc) r "
    "WHERE r.code NOT IN (SELECT code FROM k_codes)"))
def q_anti(spark, sf_dir):
    r = fx.rucc_long(spark, sf_dir).select(F.col("FIPS").alias("code")).distinct() \
        .select(C.pad_code(F.col("code")).alias("code"))
    return r.join(_site_codes(spark, sf_dir), "code", "left_anti")
