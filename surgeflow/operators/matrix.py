"""Calendar / geography features, one-hot columns and the leakage-safe split."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ID_COLS, LEAKAGE_COLS, MODEL_FEATURES, REDUNDANT_COLS
from ..functions.calendar import (REGIMES, SEASONS, US_REGION, DEFAULT_REGION, add_region,
                                  iso_week, season)
from ..functions.semantics import numeric_columns

REGIONS = tuple(sorted(set(US_REGION.values()))) + (DEFAULT_REGION,)
VOCABULARIES = {"regime": REGIMES, "season": SEASONS, "region": REGIONS}


def add_temporal_geo(df: DataFrame, key: str = "state_territory", week: str = "week_end") -> DataFrame:
    out = df.withColumns({"month": F.month(week), "epiweek_of_year": iso_week(week)})
    out = out.withColumn("season", season("month"))
    return add_region(out, key)


def onehot(df: DataFrame, columns: Sequence[str], vocab: dict | None = None,
           observed: bool = False) -> DataFrame:
    """``pd.get_dummies(columns, prefix=columns)`` as 0/1 int columns.

    The vocabulary is declared (stable schema across folds); ``observed=True``
    takes the distinct values present instead (one small distinct aggregate over a
    column whose cardinality is the number of categories). NULL -> all zeros.
    """
    vocab = dict(VOCABULARIES if vocab is None else vocab)
    if observed:
        for c in columns:
            vocab[c] = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull())
                              .distinct().collect())
    out = df
    for c in columns:
        if c not in df.columns:
            continue
        values = sorted(vocab[c])
        out = out.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
                               for v in values}).drop(c)
    return out


def build_matrix(mr: DataFrame, observed_vocab: bool = False) -> tuple[DataFrame, DataFrame]:
    """(features, targets): the leak columns never reach the feature table."""
    df = add_temporal_geo(mr)
    df = df.drop(*[c for c in REDUNDANT_COLS if c in df.columns])
    cats = [c for c in ("regime", "season", "region") if c in df.columns]
    df = onehot(df, cats, observed=observed_vocab)
    present_leak = [c for c in LEAKAGE_COLS if c in df.columns]
    targets = df.select(*ID_COLS, *present_leak)
    features = df.drop(*present_leak)
    assert not set(features.columns) & set(LEAKAGE_COLS), "leak column in features"
    return features, targets


def model_columns(features: DataFrame, include_dummies: bool = False,
                  drop: Sequence[str] = ("state_territory", "week_end", "split_era")) -> list[str]:
    """The ordered model inputs: the 17 engineered names by default (T11)."""
    if include_dummies:
        return numeric_columns(features, exclude=set(drop) | set(LEAKAGE_COLS))
    return [c for c in MODEL_FEATURES if c in features.columns]
