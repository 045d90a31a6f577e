"""County coverage statistics: code lists, set membership and representation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import pad_code


def explode_codes(df: DataFrame, col: str = "county_fips", keep: tuple = ()) -> DataFrame:
    """Comma list -> one trimmed, zero-padded code per row (distinct).

    An empty piece (trailing comma) pads to '00000', like ``''.zfill(5)``.
    """
    d = df.where(F.col(col).isNotNull()).select(
        *keep, F.explode(F.split(F.col(col).cast("string"), ",", -1)).alias("__p"))
    return d.select(*keep, pad_code(F.trim("__p")).alias("code")).distinct()


def reference_codes(counties: DataFrame, col: str = "county_fips") -> DataFrame:
    return counties.where(F.col(col).isNotNull()).select(pad_code(F.col(col).cast("string"))
                                                         .alias("code")).distinct()


def county_coverage(site_codes: DataFrame, ref_codes: DataFrame) -> DataFrame:
    """Represented counties / all counties and the percentage (one pass)."""
    j = ref_codes.join(site_codes.withColumn("__hit", F.lit(1)), "code", "left")
    return j.agg(F.count_if(F.col("__hit").isNotNull()).alias("represented"),
                 F.count(F.lit(1)).alias("total")) \
        .withColumn("coverage_pct", 100.0 * F.col("represented") / F.col("total"))


def unrepresented_by_state(samples: DataFrame, counties: DataFrame,
                           state_col: str = "state_territory", fips_col: str = "county_fips",
                           ref_state: str = "state_id") -> DataFrame:
    """% of a state's counties with no site of that state (T16: spellings united by upper case).

    The denominator counts distinct *unpadded* codes per state (``nunique``).
    """
    site = explode_codes(samples.withColumn("__st", F.upper(F.col(state_col))), fips_col,
                         keep=("__st",)).withColumn("__hit", F.lit(1))
    ref = counties.where(F.col(ref_state).isNotNull())
    totals = ref.groupBy(ref_state).agg(F.countDistinct(fips_col).alias("total"))
    ref_codes = ref.select(ref_state, pad_code(F.col(fips_col).cast("string")).alias("code")) \
        .distinct()
    rep = ref_codes.join(site, (ref_codes[ref_state] == site["__st"]) & (ref_codes["code"] == site["code"]),
                         "inner").groupBy(ref_state).agg(F.count(F.lit(1)).alias("represented"))
    j = totals.join(rep, ref_state, "left")
    return j.select(F.lower(F.col(ref_state)).alias("state_territory"),
                    (100.0 * (F.col("total") - F.coalesce(F.col("represented"), F.lit(0)))
                     / F.col("total")).alias("unrepresented_percentage"))


def difference_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """|A - B| and |B - A| of two distinct code sets in one full-outer pass."""
    j = a.select("code", F.lit(1).alias("__a")).join(b.select("code", F.lit(1).alias("__b")),
                                                    "code", "full")
    return j.agg(F.count_if(F.col("__b").isNull()).alias("first_only"),
                 F.count_if(F.col("__a").isNull()).alias("second_only"))


def rucc_compare(samples: DataFrame, rucc: DataFrame, codes: DataFrame,
                 state_col: str = "state_territory", attribute: str = "RUCC_2023") -> DataFrame:
    """Mean attribute value of represented vs unrepresented counties in sampled states."""
    states = samples.where(F.col(state_col).isNotNull()) \
        .select(F.upper(F.col(state_col).cast("string")).alias("__st")).distinct()
    r = rucc.where(F.col("Attribute").cast("string") == attribute).select(
        pad_code(F.col("FIPS").cast("string")).alias("code"),
        F.upper(F.col("State").cast("string")).alias("__st"),
        F.when(F.trim(F.col("Value")).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
               F.trim(F.col("Value")).try_cast("double")).alias("value"))
    r = r.join(states, "__st", "left_semi")
    j = r.join(codes.select("code", F.lit(1).alias("__hit")), "code", "left")
    return j.groupBy((F.col("__hit").isNotNull()).alias("represented")) \
        .agg(F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n"))
