"""Scalar column expressions with pandas-compatible null / NaN semantics.

Rules decided once (survey traps T3-T10):
* NULL is "missing"; NaN is turned into NULL at every edge (T3).
* ANSI mode stays on, so casts and divisions go through ``try_*`` (T4).
* ``greatest(null, 1)`` is 1 in Spark, so clipping guards nulls (T5).
* ``NOT startswith`` on NULL is NULL; the pandas ``na=False`` rule is a
  coalesce to false (T7).
All helpers return ``Column`` objects that stay inside whole-stage codegen.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, BooleanType

# Accepted numeric text (fixed pattern); anything else coerces to NULL.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Words pandas reads as missing (fixed list).
NULL_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
              "n/a", "nan", "null")
# Date layouts tried in order by ``coerce_date`` (fixed list).
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
                "MM/dd/yyyy", "yyyy/MM/dd", "yyyyMMdd")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (pandas treats NaN as missing)."""
    c = col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def null_words_to_null(c) -> Column:
    c = col(c)
    return F.when(F.trim(c).isin(*NULL_WORDS), F.lit(None).cast("string")).otherwise(c)


def coerce_double(c, dtype: DataType | None = None) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad text -> NULL, NaN -> NULL.

    ``dtype`` is the input column's type when known at plan time: numeric input
    skips the text path entirely (no regex on already-typed columns).
    """
    c = col(c)
    if dtype is not None and isinstance(dtype, (NumericType, BooleanType)):
        return nan_to_null(c.cast("double"))
    s = c.cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


def coerce_date(c, formats=DATE_FORMATS, dtype: DataType | None = None) -> Column:
    """``pd.to_datetime(errors='coerce')`` truncated to a DATE (T6)."""
    c = col(c)
    if dtype is not None and not isinstance(dtype, StringType):
        return c.cast("date")
    s = F.trim(c.cast("string"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in formats])


def text_norm(c, upper: bool = False) -> Column:
    c = F.trim(col(c))
    return F.upper(c) if upper else F.lower(c)


def prefix_test(c, prefix: str) -> Column:
    """Null-safe ``str.startswith(prefix, na=False)``."""
    return F.coalesce(col(c).startswith(prefix), F.lit(False))


def unlog10(value, is_log) -> Column:
    """Rows reported in log10 -> linear ``10**x`` (NaN -> NULL)."""
    return F.when(is_log, nan_to_null(F.pow(F.lit(10.0), col(value)))).otherwise(col(value))


def nondetect_flag(value) -> Column:
    return F.coalesce((col(value) == 0).cast("int"), F.lit(0))


def log10_clip(value, lower: float = 1.0) -> Column:
    """``np.log10(x.clip(lower=1))`` with NULL kept (T5)."""
    v = col(value)
    return F.when(v.isNotNull(), F.log10(F.greatest(v, F.lit(lower))))


def safe_ratio(num, den) -> Column:
    """``a / b.replace(0, nan)`` -> NULL on zero / NULL denominator."""
    d = col(den)
    return F.try_divide(col(num), F.when(d != 0, d))


def pct_change(nxt, cur) -> Column:
    return safe_ratio(col(nxt) - col(cur), cur)


def pad_code(c, width: int = 5) -> Column:
    """``str.zfill(width)``: pad on the left, never truncate (T8)."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def safe_corr_parts(sxy, sxx, syy) -> Column:
    """Pearson r from co-moment sums; constant input -> NULL instead of an error (T10)."""
    den = F.sqrt(sxx * syy)
    return F.try_divide(sxy, F.when(den != 0, den))


def safe_corr(x, y) -> Column:
    """Pair-complete Pearson correlation as an aggregate expression.

    ``regr_sxy/sxx/syy`` only see rows where both inputs are non-null, exactly like
    pandas' pairwise-complete ``corr``; at least two pairs are required.
    """
    x, y = col(x), col(y)
    r = safe_corr_parts(F.regr_sxy(y, x), F.regr_sxx(y, x), F.regr_syy(y, x))
    return F.when(F.regr_count(y, x) >= 2, r)


def round6(c) -> Column:
    return F.round(col(c), 6)


def minmax_scaled(c, lo, hi) -> Column:
    """``MinMaxScaler``: (x-min)/(max-min); a constant column maps to 0."""
    c, lo, hi = col(c), col(lo), col(hi)
    rng = hi - lo
    return F.when(c.isNull(), F.lit(None).cast("double")).when(rng == 0, F.lit(0.0)) \
        .otherwise((c - lo) / rng)


def numeric_columns(df, exclude=()) -> list[str]:
    """``select_dtypes(include=np.number)``: numeric, booleans excluded."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def dtype_of(df, name: str) -> DataType:
    return df.schema[name].dataType
