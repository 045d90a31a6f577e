"""Label side: jurisdiction-week admissions -> cleaned state-week labels.

Row-local work only (coercion, roll-up removal, regime, coverage), so the whole
stage is a single narrow scan; the audit uses one aggregate over step tags.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LabelConfig, ROLLUP_NAMES, ROLLUP_PREFIX
from ..functions import semantics as S
from ..functions.calendar import regime
from ..sources.io import normalize_headers

LABEL_STEPS = (
    ("20_raw_load", "as delivered"),
    ("21_valid_date_and_admits", "drop unparseable dates / null admissions"),
    ("22_drop_rollups", "drop national and regional roll-up rows"),
    ("23_drop_voluntary_window", "drop the voluntary-reporting window"),
)


def coverage_expr(df: DataFrame, cfg: LabelConfig):
    """Percent column if present, else reported/total ratio, else KeyError (plan time)."""
    cols = set(df.columns)
    if cfg.coverage_pct_col in cols:
        pct = S.coerce_double(cfg.coverage_pct_col, S.dtype_of(df, cfg.coverage_pct_col))
        return pct / 100.0
    if cfg.coverage_num_col in cols and cfg.coverage_den_col in cols:
        num = S.coerce_double(cfg.coverage_num_col, S.dtype_of(df, cfg.coverage_num_col))
        den = S.coerce_double(cfg.coverage_den_col, S.dtype_of(df, cfg.coverage_den_col))
        return S.safe_ratio(num, den)
    hint = [c for c in df.columns if "hosprep" in c][:5]
    raise KeyError(f"No coverage column found; columns like: {hint}")


def tag_labels(raw: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """Normalised headers, typed columns and the first failing step per row."""
    h = normalize_headers(raw)
    week = S.coerce_date(cfg.date_col, dtype=S.dtype_of(h, cfg.date_col))
    admits = S.coerce_double(cfg.admits_col, S.dtype_of(h, cfg.admits_col))
    state = S.text_norm(cfg.jurisdiction_col)
    is_rollup = (S.prefix_test(state, ROLLUP_PREFIX)
                 | F.coalesce(state.isin(*ROLLUP_NAMES), F.lit(False)))
    reg = regime(week, cfg.vol_start, cfg.vol_end)
    fail = (F.when(week.isNull() | admits.isNull(), F.lit("21_valid_date_and_admits"))
            .when(is_rollup, F.lit("22_drop_rollups"))
            .when(reg == "voluntary", F.lit("23_drop_voluntary_window")))
    return h.select(state.alias("state_territory"), week.alias("week_end"),
                    admits.alias("admits"), coverage_expr(h, cfg).alias("coverage"),
                    reg.alias("regime"), fail.alias("__fail"))


def clean_labels(raw: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    t = tag_labels(raw, cfg)
    return t.where(F.col("__fail").isNull()).drop("__fail")


def label_step_log(raw: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    t = tag_labels(raw, cfg)
    one = t.agg(F.count(F.lit(1)).alias("n"),
                *[F.count_if(F.col("__fail") == s).alias(f"f{i}")
                  for i, (s, _) in enumerate(LABEL_STEPS[1:])])
    vals = [F.col("n")]
    for i in range(len(LABEL_STEPS) - 1):
        vals.append(vals[-1] - F.col(f"f{i}"))
    rows = F.array(*[F.struct(F.lit(s).alias("step"), v.cast("long").alias("rows_remaining"),
                              F.lit(r).alias("reason"))
                     for (s, r), v in zip(LABEL_STEPS, vals)])
    return one.select(F.inline(rows))


def regime_counts(raw: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """``regime.value_counts()`` after the roll-up filter (before the window drop)."""
    t = tag_labels(raw, cfg).where(F.col("__fail").isNull()
                                   | (F.col("__fail") == "23_drop_voluntary_window"))
    return value_counts(t, "regime")


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per category (null dropped), descending count then category."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(col)))


def low_coverage(labels: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Count and share of weeks with coverage < threshold, window, distinct states.

    NULL coverage is not low but stays in the denominator (pandas ``(c<.8).mean()``).
    """
    low = F.coalesce(F.col("coverage") < threshold, F.lit(False))
    return labels.agg(
        F.count_if(low).alias("low_coverage_weeks"),
        F.avg(low.cast("double")).alias("low_coverage_share"),
        F.min("week_end").alias("first_week"), F.max("week_end").alias("last_week"),
        F.countDistinct("state_territory").alias("n_states"),
        F.count(F.lit(1)).alias("n_rows"))
