"""Entry point A: raw site-day samples -> audited state-week table.

Plan shape (3 shuffles on the row data): one-row global LOD median (scalar
broadcast), keep-first de-duplication as a ``row_number`` window keyed by (site, date, gene, matrix), per-site robust statistics as
aggregates joined back on ``site`` (written once, one row per site, and broadcast while small;
AQE splits a hot site otherwise), and the weekly ``groupBy(state, week)``.  Exact medians go
through ``group_quantiles`` so that no site or state-week is ever collected whole into one task.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (CleanSamplesConfig, LIQUID_UNIT, LOG_UNIT_PREFIX, OUTLIER_Z,
                      ROBUST_Z_CONST)
from ..functions import semantics as S
from ..functions.calendar import week_end_saturday
from ..session import cut_lineage, write_observed
from .quantiles import group_quantiles

STEP_REASONS = (
    ("00_raw_load", "as delivered"),
    ("01_valid_dates", "drop unparseable sample_collect_date"),
    ("02_conc_not_null", "drop rows with no target concentration"),
    ("03_units_copies_per_L", "drop units that cannot be converted to copies/L"),
    ("04_matrix_filter", "keep the comparable liquid sample matrices"),
    ("05_nondetect_LOD_half", "zeros replaced by LOD/2, flagged in nondetect_flag"),
    ("06_dedupe", "keep the first row per site/date/gene/matrix"),
    ("08_outlier_flagged", "site-relative outliers flagged, not dropped"),
    ("10_weekly_state_agg", "aggregate site-days to state-weeks"),
    ("11_min_sites", "drop state-weeks backed by too few sites"),
)


@dataclass
class SampleStages:
    prepared: DataFrame   # every raw row, coerced, with its first failing step in __fail
    filtered: DataFrame   # rows passing steps 01-04, non-detects substituted
    deduped: DataFrame
    scored: DataFrame     # + log10_conc, robust_z, outlier_flag, conc_site_z, week_end
    weekly_all: DataFrame
    weekly: DataFrame
    med_lod: DataFrame    # one row: med_lod
    weekly_counts: dict = field(default_factory=dict)  # observed when weekly_all was written


def _not_missing(df: DataFrame, name: str) -> Column:
    dt = S.dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, S.StringType):
        return S.null_words_to_null(c).isNotNull()
    if isinstance(dt, S.NumericType):
        return S.nan_to_null(c.cast("double")).isNotNull()
    return c.isNotNull()


def prepare(raw: DataFrame, cfg: CleanSamplesConfig = CleanSamplesConfig()) -> DataFrame:
    """Coerce types, harmonise units and tag every row with its first failing step."""
    c = cfg.cols
    date = S.coerce_date(c.date, dtype=S.dtype_of(raw, c.date))
    conc = S.coerce_double(c.conc, S.dtype_of(raw, c.conc))
    lod = S.coerce_double(c.lod, S.dtype_of(raw, c.lod))
    units = S.text_norm(c.units)
    is_log = S.prefix_test(units, LOG_UNIT_PREFIX)
    conc_linear = S.unlog10(conc, is_log)
    units_h = F.when(is_log, F.lit(LIQUID_UNIT)).otherwise(units)
    fail = (F.when(date.isNull(), F.lit("01_valid_dates"))
            .when(~_not_missing(raw, c.conc), F.lit("02_conc_not_null"))
            .when(F.coalesce(units_h != LIQUID_UNIT, F.lit(True)), F.lit("03_units_copies_per_L"))
            .when(~F.coalesce(F.col(c.matrix).isin(*cfg.keep_matrices), F.lit(False)),
                  F.lit("04_matrix_filter")))
    ordinal = (F.col(c.ordinal[0]) if len(c.ordinal) == 1
               else F.struct(*[F.col(o) for o in c.ordinal])).alias("__ord")
    return raw.select(
        ordinal,
        F.col(c.record_id).alias("record_id"),
        F.col(c.site).alias("site"),
        F.col(c.state).alias("state_raw"),
        date.alias("sample_collect_date"),
        F.col(c.matrix).alias("sample_matrix"),
        F.col(c.gene).alias("pcr_gene_target_agg"),
        conc_linear.alias("conc"),
        lod.alias("lod_sewage"),
        F.col(c.population).alias("population_served"),
        is_log.alias("is_log"),
        fail.alias("__fail"),
    )


def substitute_nondetects(kept: DataFrame, med_lod: DataFrame) -> DataFrame:
    """Zeros -> row LOD/2, or the global median LOD/2 when the row has no LOD."""
    nd = F.coalesce(F.col("conc") == 0, F.lit(False))
    has_lod = F.col("lod_sewage").isNotNull()
    j = kept.crossJoin(F.broadcast(med_lod))       # one-row scalar
    return j.withColumns({
        "nondetect_flag": S.nondetect_flag("conc"),
        "conc": (F.when(nd & has_lod, F.col("lod_sewage") / 2)
                 .when(nd, F.col("med_lod") / 2).otherwise(F.col("conc"))),
    }).drop("med_lod")


def dedupe_first(df: DataFrame, keys=("site", "sample_collect_date",
                                      "pcr_gene_target_agg", "sample_matrix"),
                 order_col: str = "__ord") -> DataFrame:
    """``drop_duplicates(keys, keep='first')`` with an explicit order (T1).

    One exchange: ``row_number() = 1`` is planned with a group limit on the map side, so a
    huge duplicate group shrinks to one row per map task before the shuffle.
    """
    first = Window.partitionBy(*keys).orderBy(order_col)
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def site_scores(df: DataFrame, exact: bool = True, stored: bool = False) -> DataFrame:
    """log10, per-site median / MAD / std, robust z, outlier flag, site z.

    For a ``stored`` table the statistics (one row per site) are written, so rows meet them by a
    broadcast as long as they are small, and every reader of the scores shares them."""
    keep = cut_lineage if stored else (lambda small: small)
    x = S.log10_clip("conc")
    rows = df.withColumn("log10_conc", x)
    med = keep(group_quantiles(rows.where(F.col("site").isNotNull()), ["site"], "log10_conc",
                               [0.5], ["__med"], exact=exact, stored=stored))
    rows_m = rows.join(med, "site", "left")
    dev = rows_m.select("site", F.abs(F.col("log10_conc") - F.col("__med")).alias("__dev"))
    mad = group_quantiles(dev.where(F.col("site").isNotNull()), ["site"], "__dev",
                          [0.5], ["__mad"], exact=exact, stored=stored)
    sd = rows.where(F.col("site").isNotNull()).groupBy("site").agg(
        F.stddev_samp("log10_conc").alias("__sd"))
    site_stats = keep(mad.join(sd, "site", "full"))
    out = rows_m.join(site_stats, "site", "left")
    centred = F.col("log10_conc") - F.col("__med")
    robust_z = F.lit(ROBUST_Z_CONST) * S.safe_ratio(centred, "__mad")
    out = out.withColumns({
        "robust_z": robust_z,
        "outlier_flag": F.coalesce((F.abs(robust_z) > OUTLIER_Z).cast("int"), F.lit(0)),
        "conc_site_z": F.coalesce(S.safe_ratio(centred, "__sd"), F.lit(0.0)),
    })
    return out.drop("__med", "__mad", "__sd")


def weekly_state(scored: DataFrame, exact: bool = True, stored: bool = False) -> DataFrame:
    """The central aggregate by (state, week); null keys dropped like pandas (T2)."""
    keys = ["state_territory", "week_end"]
    base = scored.withColumns({
        "state_territory": S.text_norm("state_raw"),
        "week_end": week_end_saturday("sample_collect_date"),
    }).where(F.col("state_territory").isNotNull() & F.col("week_end").isNotNull())
    # per site first: sites and their populations are then counted once without expanding rows
    site = base.groupBy(*keys, "site").agg(
        F.sum("log10_conc").alias("x"), F.count("log10_conc").alias("x_n"),
        F.sum("conc_site_z").alias("z"), F.count("conc_site_z").alias("z_n"),
        F.sum("nondetect_flag").alias("d"), F.count("nondetect_flag").alias("d_n"),
        F.count("record_id").alias("n"), F.sum("population_served").alias("pop"),
        F.max("population_served").alias("site_pop"))
    named = F.col("site").isNotNull()
    agg = site.groupBy(*keys).agg(
        (F.sum("x") / F.nullif(F.sum("x_n"), F.lit(0))).alias("log10_conc_mean"),
        (F.sum("z") / F.nullif(F.sum("z_n"), F.lit(0))).alias("conc_site_z_mean"),
        F.sum("n").alias("n_samples"),
        F.count("site").alias("n_sites"),
        (F.sum("d") / F.nullif(F.sum("d_n"), F.lit(0))).alias("pct_nondetect"),
        F.coalesce(F.sum("pop"), F.lit(0)).cast("long").alias("pop_served"),
        # each named site's population once, at its largest in the week
        F.coalesce(F.sum(F.when(named, F.col("site_pop"))), F.lit(0)).cast("long").alias("pop_served_distinct"),
    )
    med = group_quantiles(base, keys, "log10_conc", [0.5], ["log10_conc_median"], exact=exact, stored=stored)
    out = agg.join(med, keys, "left")
    return out.select("state_territory", "week_end", "log10_conc_mean", "log10_conc_median",
                      "conc_site_z_mean", "n_samples", "n_sites", "pct_nondetect", "pop_served",
                      "pop_served_distinct")


def kept_rows(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("__fail").isNull()).drop("__fail")


def clean_samples(raw: DataFrame, cfg: CleanSamplesConfig = CleanSamplesConfig(),
                  dealt: DataFrame | None = None) -> SampleStages:
    """All stages of ``raw``.  ``dealt`` are the same rows in tasks of a size to sort; only the
    de-duplication reads them, the counts and the median take ``raw`` as it lies."""
    prepared = prepare(raw, cfg)
    kept = kept_rows(prepared)
    med_lod = group_quantiles(kept, [], "lod_sewage", [0.5], ["med_lod"], exact=cfg.exact)
    filtered = substitute_nondetects(kept, med_lod)
    # the de-duplicated rows feed the site statistics, the weekly table and the
    # audit: write them once to the shared checkpoint folder (cuts lineage)
    to_sort = filtered if dealt is None else substitute_nondetects(kept_rows(prepare(dealt, cfg)), med_lod)
    deduped = dedupe_first(to_sort)
    if cfg.checkpoint:
        deduped = cut_lineage(deduped)
    scored = site_scores(deduped, exact=cfg.exact, stored=cfg.checkpoint)
    weekly_all = weekly_state(scored, exact=cfg.exact, stored=cfg.checkpoint)
    weekly = weekly_all.where(F.col("n_sites") >= cfg.min_sites)
    return SampleStages(prepared, filtered, deduped, scored, weekly_all, weekly, med_lod)


def sample_step_log(st: SampleStages, min_sites: int = 2) -> DataFrame:
    """(step, rows_remaining, reason) in one query: step tags + a few scalar counts."""
    fails = [s for s, _ in STEP_REASONS[1:5]]
    tagged = st.prepared.agg(
        F.count(F.lit(1)).alias("n_raw"),
        *[F.count_if(F.col("__fail") == s).alias(f"f_{i}") for i, s in enumerate(fails)])
    dd = st.deduped.agg(F.count(F.lit(1)).alias("n_dedupe"))
    wk = st.weekly_all.agg(F.count(F.lit(1)).alias("n_weeks"),
                           F.count_if(F.col("n_sites") >= min_sites).alias("n_support"))
    one = tagged.crossJoin(dd).crossJoin(wk)
    remaining = [F.col("n_raw")]
    for i in range(len(fails)):
        remaining.append(remaining[-1] - F.col(f"f_{i}"))
    vals = remaining + [remaining[-1], F.col("n_dedupe"), F.col("n_dedupe"),
                        F.col("n_weeks"), F.col("n_support")]
    rows = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(s).alias("step"),
                              v.cast("long").alias("rows_remaining"), F.lit(r).alias("reason"))
                     for i, ((s, r), v) in enumerate(zip(STEP_REASONS, vals))])
    return one.select(F.inline(rows)).drop("ord")


def sample_side_counts(st: SampleStages) -> DataFrame:
    """Log-unit rows, non-detects, duplicates removed and outliers flagged, one row."""
    a = st.prepared.agg(
        F.count_if(F.col("is_log") & ~F.coalesce(
            F.col("__fail").isin("01_valid_dates", "02_conc_not_null"), F.lit(False))
        ).alias("log_unit_rows"),
    )
    b = st.filtered.agg(F.sum("nondetect_flag").cast("long").alias("nondetects"),
                        F.count(F.lit(1)).alias("__n_f"))
    c = st.scored.agg(F.sum("outlier_flag").cast("long").alias("outliers_flagged"),
                      F.count(F.lit(1)).alias("__n_d"))
    one = a.crossJoin(b).crossJoin(c)
    return one.select("log_unit_rows", "nondetects",
                      (F.col("__n_f") - F.col("__n_d")).alias("duplicates_removed"),
                      "outliers_flagged")


WEEKLY_COUNTS = {"n_weeks": lambda _: F.count(F.lit(1)),
                 "n_support": lambda min_sites: F.count_if(F.col("n_sites") >= min_sites)}


def write_weekly(st: SampleStages, min_sites: int) -> dict:
    """Write the weekly table of ``st`` and return its observed counts."""
    counts = [make(min_sites).alias(k) for k, make in WEEKLY_COUNTS.items()]
    st.weekly_all, seen = write_observed(st.weekly_all, "weekly", *counts)
    st.weekly = st.weekly_all.where(F.col("n_sites") >= min_sites)
    return {k: int(seen.get(k) or 0) for k in WEEKLY_COUNTS}
