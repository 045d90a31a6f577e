"""Guards that fail when the query runs, not while it is built.

A guard is a count of the rows, united with them: it adds no row where the count suffices and
raises where it does not, so nothing is executed before the action and an empty result cannot
pass unseen.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S


def require_rows(df: DataFrame, message: str, least: int = 1) -> DataFrame:
    """``df``; running it raises ``message`` if it has fewer than ``least`` rows."""
    few = df.agg(F.count(F.lit(1)).alias("__n")).where(
        F.when(F.col("__n") < least, F.raise_error(F.lit(message)).isNull()).otherwise(F.lit(False)))
    # the filter raises, so this side never gives a row whatever columns a later step keeps
    return df.unionByName(few.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))


def only_state(df: DataFrame, state: str | None, column: str = "state_territory") -> DataFrame:
    """Rows of one state, compared trimmed and in upper case; raises if there are none."""
    if state is None:
        return df
    kept = df.withColumn(column, F.upper(F.trim(F.col(column).cast("string")))).where(
        F.col(column) == state.strip().upper())
    return require_rows(kept, f"No rows found for state '{state}'.")


def in_year(week: Column, year: int | None) -> Column:
    """Weeks of a year as a range, which reaches the scan."""
    if year is None:
        return F.lit(True)
    return (week >= F.lit(f"{year}-01-01").cast("date")) & (week < F.lit(f"{year + 1}-01-01").cast("date"))


def usable_rows(df: DataFrame, numbers: list[str], state: str | None = None, year: int | None = None,
                week: str = "week_end") -> DataFrame:
    """Rows with a date and all of ``numbers`` (coerced; what is no date or number is missing) of a
    state and a year; raises if none is left."""
    kept = only_state(df, state).withColumn(week, S.coerce_date(week, dtype=S.dtype_of(df, week)))
    kept = kept.withColumns({c: S.coerce_double(c, S.dtype_of(df, c)) for c in numbers}).dropna(subset=[week, *numbers])
    return require_rows(kept.where(in_year(F.col(week), year)), "No valid data remains after applying the filters.")


def complete_pairs(df: DataFrame, predictor: str, target: str, least: int = 2) -> DataFrame:
    """(predictor, target) without missing values; raises if there are fewer than ``least``."""
    pairs = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in (predictor, target)]).dropna()
    return require_rows(pairs, "Not enough valid data points.", least)
