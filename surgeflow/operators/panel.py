"""Entry point B: state-week panel -> lead/lag features, labels, splits, folds.

The panel is already aggregated (one row per area and week), so a window
partitioned by area holds at most one row per calendar week: its size is
bounded by the calendar, not by the raw data volume.  All label and feature
columns share one ``WindowSpec`` -> one shuffle + one sort for the whole stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PanelConfig
from ..functions import semantics as S
from ..session import write_observed
from .quantiles import group_quantiles

PANEL_STEPS = (
    ("30_wastewater_weekly", "weekly signal table"),
    ("30b_hospital_weekly", "weekly label table"),
    ("31_joined_weekly", "join on state + week"),
    ("32_model_ready", "require label + >= 1 lag"),
)


def join_state_week(ww: DataFrame, labels: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    return ww.join(labels, [cfg.key, cfg.week], cfg.how)


def zero_match_guard(ww: DataFrame, labels: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Matched / unmatched key counts on both sides of the panel join (one query).

    ``assert_matches`` raises when nothing matches (e.g. weeks ending on Sunday on
    one side and Saturday on the other).
    """
    k = [cfg.key, cfg.week]
    a = ww.select(*k).distinct().withColumn("__l", F.lit(1))
    b = labels.select(*k).distinct().withColumn("__r", F.lit(1))
    j = a.join(b, k, "full")
    return j.agg(F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("matched_keys"),
                 F.count_if(F.col("__r").isNull()).alias("left_only_keys"),
                 F.count_if(F.col("__l").isNull()).alias("right_only_keys"))


#: Aggregates observed while the panel is written.
PANEL_COUNTS = {
    "rows": lambda: F.count(F.lit(1)),
    "matched": lambda: F.count("admits"),
    "gap_voided": lambda: F.count_if(~F.col("gap_ok")),
    "ready": lambda: F.count_if(F.col("y_surge_next_week").isNotNull() & F.col("log10_conc_lag1").isNotNull()),
}


def write_panel(features: DataFrame) -> tuple[DataFrame, dict]:
    """The written panel and its observed counts.

    Raises if the panel has rows but none with admissions: the join matched nothing.  The check
    reads the counts of the write itself."""
    written, counts = write_observed(features, "panel", *[make().alias(k) for k, make in PANEL_COUNTS.items()])
    counts = {k: int(counts.get(k) or 0) for k in PANEL_COUNTS}
    if counts["rows"] and not counts["matched"]:
        raise ValueError("join on (state, week) matched no rows; check the week-ending day")
    return written, counts


def assert_matches(guard: DataFrame) -> None:
    row = guard.first()
    if row is None or row["matched_keys"] == 0:
        raise ValueError("join on (state, week) matched no rows; check the week-ending day")


def per_capita(cfg: PanelConfig, population_col: str = "pop_served"):
    if cfg.per_capita_mode == "identity":
        return F.col("admits")
    if cfg.per_capita_mode == "constant":
        return F.col("admits") / 1e5
    if cfg.per_capita_mode == "population":
        return S.safe_ratio(F.col("admits") * 1e5, population_col)
    raise ValueError(cfg.per_capita_mode)


def state_median(m: DataFrame, name: str, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Each row's state median of admissions (NULL and NaN left out; NULL where there are none).

    ``median_as_of="all"`` takes the whole history (look-ahead, T13).  ``"current"`` takes the
    weeks up to the row's own, so a label of it owes nothing to later weeks; the window holds one
    row per calendar week.
    """
    if cfg.median_as_of == "all":
        med = group_quantiles(m, [cfg.key], "admits", [0.5], [name])  # one row per state
        return m.join(med, cfg.key, "left")
    if cfg.median_as_of != "current":
        raise ValueError(cfg.median_as_of)
    so_far = Window.partitionBy(cfg.key).orderBy(cfg.week).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return m.withColumn(name, F.percentile(S.nan_to_null(F.col("admits")), 0.5).over(so_far))


def build_features(m: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Targets, gap guard, lags, delta and rolling mean over ``W``."""
    key, wk = cfg.key, cfg.week
    w = Window.partitionBy(key).orderBy(wk)
    m = state_median(m, "__state_med", cfg)
    nxt = F.lead("admits", 1).over(w)
    nxt_week = F.lead(wk, 1).over(w)
    x = F.col("log10_conc_mean")
    if cfg.calendar_lags:
        wd = Window.partitionBy(key).orderBy(F.unix_date(F.col(wk)))
        lags = {f"log10_conc_lag{L}": F.max(x).over(wd.rangeBetween(-7 * L, -7 * L))
                for L in (1, 2, 3)}
        roll = wd.rangeBetween(-14, 0)
    else:
        lags = {f"log10_conc_lag{L}": F.lag(x, L).over(w) for L in (1, 2, 3)}
        roll = w.rowsBetween(-2, 0)
    m = m.withColumns({
        "admits_per100k": per_capita(cfg),
        "admits_next_week": nxt,
        "admits_this_week": F.col("admits"),
        "next_week_end": nxt_week,
        **lags,
        "__roll_n": F.count(x).over(roll),
        "__roll": F.avg(x).over(roll),
    })
    gap_ok = F.coalesce(F.datediff(F.col("next_week_end"), F.col(wk)) == 7, F.lit(False))
    pct = S.pct_change("admits_next_week", "admits")
    surge = F.coalesce((pct > cfg.surge_threshold)
                       & (F.col("admits_next_week") > F.col("__state_med")), F.lit(False)).cast("int")
    m = m.withColumns({
        "pct_change_next": pct,
        "y_reg_next_admits": F.when(gap_ok, F.col("admits_next_week")),
        "y_surge_next_week": F.when(F.col("admits_next_week").isNull() | ~gap_ok,
                                    F.lit(None).cast("int")).otherwise(surge),
        "conc_delta_1w": x - F.col("log10_conc_lag1"),
        "conc_roll3": F.when(F.col("__roll_n") >= 2, F.col("__roll")),
        "gap_ok": gap_ok,
    })
    return m.drop("__state_med", "__roll_n", "__roll")


PANEL_COLUMNS = (
    "state_territory", "week_end", "log10_conc_mean", "log10_conc_median",
    "conc_site_z_mean", "n_samples", "n_sites", "pct_nondetect", "pop_served",
    "admits", "coverage", "regime", "admits_per100k", "admits_next_week",
    "admits_this_week", "y_reg_next_admits", "pct_change_next", "y_surge_next_week",
    "next_week_end", "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3",
    "conc_delta_1w", "conc_roll3",
)


def model_ready(features: DataFrame) -> DataFrame:
    return features.dropna(subset=["y_surge_next_week", "log10_conc_lag1"]) \
        .select(*PANEL_COLUMNS)


def quantile_cut(df: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """One-row frame: the split point (days since epoch, may be x.5) of week_end."""
    days = df.select(F.unix_date(F.col(cfg.week)).cast("double").alias("__d"))
    return group_quantiles(days, [], "__d", [cfg.split_quantile], ["cut_days"])


def era_split(mr: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Era rows with ``split_era`` = train (week <= cut) / test."""
    era = mr.where(F.col(cfg.week) >= F.lit(cfg.era_start).cast("date"))
    cut = quantile_cut(era, cfg)
    j = era.crossJoin(F.broadcast(cut))            # one-row scalar
    split = F.when(F.unix_date(F.col(cfg.week)) <= F.col("cut_days"), F.lit("train")) \
        .otherwise(F.lit("test"))
    return j.withColumn("split_era", split).drop("cut_days")


def cut_date(mr: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    era = mr.where(F.col(cfg.week) >= F.lit(cfg.era_start).cast("date"))
    cut = quantile_cut(era, cfg)
    return cut.select(F.date_from_unix_date(F.floor("cut_days").cast("int")).alias("cut_date"),
                      (F.col("cut_days") - F.floor("cut_days")).alias("cut_day_fraction"))


def fold_table(spark: SparkSession, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    rows = [(i, s, a, b) for i, (s, a, b) in enumerate(cfg.folds, 1)]
    return spark.createDataFrame(rows, "fold int, start string, train_end string, test_end string") \
        .select("fold", *[F.col(c).cast("date").alias(c) for c in ("start", "train_end", "test_end")])


def rolling_origin(mr: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Fold sizes and base rates in one pass: range join with the (fixed, tiny) fold table."""
    folds = fold_table(mr.sparkSession, cfg)
    wk = F.col(cfg.week)
    j = mr.select(cfg.week, "y_surge_next_week").join(
        F.broadcast(folds), (wk >= F.col("start")) & (wk < F.col("test_end")))
    is_tr = wk < F.col("train_end")
    y = F.col("y_surge_next_week").cast("double")
    g = j.groupBy("fold", "train_end", "test_end").agg(
        F.count_if(is_tr).alias("train_n"), F.count_if(~is_tr).alias("test_n"),
        F.avg(F.when(is_tr, y)).alias("__tr"), F.avg(F.when(~is_tr, y)).alias("__te"))
    return g.where(F.col("test_n") > 0).select(
        "fold", "train_n", "test_n", F.round("__tr", 3).alias("train_rate"),
        F.round("__te", 3).alias("test_rate"), "train_end", "test_end")


def fold_rates(era: DataFrame) -> DataFrame:
    """n and base rate per train / test slice."""
    return era.groupBy("split_era").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("y_surge_next_week").cast("double")).alias("base_rate"),
        F.min("week_end").alias("first_week"), F.max("week_end").alias("last_week"))


def panel_step_log(spark: SparkSession, weekly_rows: int, label_rows: int, counts: dict) -> DataFrame:
    """(step, rows_remaining, reason) from the counts observed when the stages were written."""
    numbers = (weekly_rows, label_rows, counts["rows"], counts["ready"])
    return spark.createDataFrame([(step, n, reason) for (step, reason), n in zip(PANEL_STEPS, numbers)],
                                 "step string, rows_remaining long, reason string")


def null_report(df: DataFrame, pattern: str = "lag") -> DataFrame:
    cols = [c for c in df.columns if pattern in c]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "n_null")
