"""Parameters of every stage, as dataclasses (column names, dates, thresholds).

The same operators run on the health schema and on the driver's tables; only
these values differ.  Defaults describe the driver-table adapters
(``sources.fixtures``); ``HEALTH_*`` instances describe the original schema.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the analysed project's behaviour.
LIQUID_UNIT = "copies/l wastewater"
LOG_UNIT_PREFIX = "log10"
KEEP_MATRICES = ("raw wastewater", "post grit removal")
ROLLUP_PREFIX = "region"
ROLLUP_NAMES = ("usa", "us", "national", "all")
ROBUST_Z_CONST = 0.6745
OUTLIER_Z = 5.0
SURGE_THRESHOLD = 0.10
LEAKAGE_COLS = ("admits_next_week", "y_reg_next_admits", "pct_change_next",
                "y_surge_next_week", "next_week_end")
ID_COLS = ("state_territory", "week_end")
REDUNDANT_COLS = ("admits_this_week",)
# The 17 model inputs, in order (T11: dummies never reach a model by default).
MODEL_FEATURES = (
    "log10_conc_mean", "log10_conc_median", "conc_site_z_mean", "n_samples",
    "n_sites", "pct_nondetect", "pop_served", "admits", "coverage",
    "admits_per100k", "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3",
    "conc_delta_1w", "conc_roll3", "month", "epiweek_of_year",
)
CORR_COLUMNS = (
    "log10_conc_mean", "log10_conc_median", "conc_site_z_mean",
    "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3", "conc_delta_1w",
    "conc_roll3", "admits_this_week", "admits_per100k", "y_reg_next_admits",
)
HIST_COLUMNS = (
    "log10_conc_mean", "log10_conc_median", "conc_site_z_mean", "conc_delta_1w",
    "conc_roll3", "admits_this_week", "admits_per100k", "n_samples", "n_sites",
    "pct_nondetect", "pop_served", "coverage", "pct_change_next",
    "y_reg_next_admits",
)
SCATTER_PREDICTORS = (
    "log10_conc_mean", "conc_site_z_mean", "conc_roll3", "admits_this_week",
    "log10_conc_lag1", "log10_conc_lag2", "log10_conc_lag3", "conc_delta_1w",
)
TOP4_DEPENDENCE = ("admits_per100k", "conc_site_z_mean", "epiweek_of_year",
                   "log10_conc_mean")


@dataclass(frozen=True)
class SampleCols:
    record_id: str = "record_id"
    site: str = "site"
    state: str = "state_territory"
    date: str = "sample_collect_date"
    matrix: str = "sample_matrix"
    gene: str = "pcr_gene_target_agg"
    conc: str = "pcr_target_avg_conc"
    units: str = "pcr_target_units"
    lod: str = "lod_sewage"
    population: str = "population_served"
    # explicit first-row order for keep='first' (T1)
    ordinal: tuple = ("record_id",)


@dataclass(frozen=True)
class CleanSamplesConfig:
    cols: SampleCols = field(default_factory=SampleCols)
    min_sites: int = 2
    keep_matrices: tuple = KEEP_MATRICES
    exact: bool = True          # exact medians (distributed selection) vs sketches
    checkpoint: bool = True     # write the de-duplicated rows to spark.checkpoint.dir


@dataclass(frozen=True)
class LabelConfig:
    date_col: str = "weekendingdate"
    admits_col: str = "totalconfc19newadm"
    jurisdiction_col: str = "jurisdiction"
    coverage_pct_col: str = "totalconfc19newadmperchosprep"
    coverage_num_col: str = "numconfc19newadmhosprep"
    coverage_den_col: str = "numhosprep"
    vol_start: str = "1998-05-01"
    vol_end: str = "1998-10-31"


@dataclass(frozen=True)
class PanelConfig:
    key: str = "state_territory"
    week: str = "week_end"
    how: str = "left"
    surge_threshold: float = SURGE_THRESHOLD
    per_capita_mode: str = "identity"      # identity | constant | population
    median_as_of: str = "all"              # T13 compat: whole history; "current" = weeks so far
    era_start: str = "1997-01-01"
    split_quantile: float = 0.75
    calendar_lags: bool = False            # T21 compat: lags by row
    folds: tuple = (
        ("1997-01-01", "1998-01-01", "1998-07-01"),
        ("1997-01-01", "1998-07-01", "1999-01-01"),
        ("1997-01-01", "1999-01-01", "1999-07-01"),
        ("1997-01-01", "2000-01-01", "2000-07-01"),
    )


HEALTH_LABELS = LabelConfig(vol_start="2024-05-01", vol_end="2024-10-31")
HEALTH_PANEL = PanelConfig(
    era_start="2022-01-01",
    folds=(
        ("2022-01-01", "2023-01-01", "2023-07-01"),
        ("2022-01-01", "2023-07-01", "2024-01-01"),
        ("2022-01-01", "2024-01-01", "2024-07-01"),
        ("2022-01-01", "2025-01-01", "2025-07-01"),
    ),
)

# Driver-table adapters order duplicates by the full lineitem key tuple.
DRIVER_SAMPLES = CleanSamplesConfig(cols=SampleCols(ordinal=("record_key",)))
