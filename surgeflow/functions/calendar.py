"""Calendar and geography expressions for the weekly panel."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .semantics import col

# State code -> census region (51 entries), unmatched -> 'territory'.
US_REGION = {
    "ct": "northeast", "me": "northeast", "ma": "northeast", "nh": "northeast",
    "ri": "northeast", "vt": "northeast", "nj": "northeast", "ny": "northeast",
    "pa": "northeast",
    "il": "midwest", "in": "midwest", "mi": "midwest", "oh": "midwest", "wi": "midwest",
    "ia": "midwest", "ks": "midwest", "mn": "midwest", "mo": "midwest", "ne": "midwest",
    "nd": "midwest", "sd": "midwest",
    "de": "south", "fl": "south", "ga": "south", "md": "south", "nc": "south",
    "sc": "south", "va": "south", "dc": "south", "wv": "south", "al": "south",
    "ky": "south", "ms": "south", "tn": "south", "ar": "south", "la": "south",
    "ok": "south", "tx": "south",
    "az": "west", "co": "west", "id": "west", "mt": "west", "nv": "west", "nm": "west",
    "ut": "west", "wy": "west", "ak": "west", "ca": "west", "hi": "west", "or": "west",
    "wa": "west",
}
DEFAULT_REGION = "territory"
SEASONS = ("winter", "spring", "summer", "fall")
REGIMES = ("mandatory_pre", "voluntary", "mandatory_post")


def week_end_saturday(d) -> Column:
    """Saturday that closes the Sunday->Saturday epiweek containing ``d``."""
    return F.next_day(F.date_sub(col(d).cast("date"), 1), "SAT")


def iso_week(d) -> Column:
    return F.weekofyear(col(d))


def season(month) -> Column:
    """Month -> season, right-closed bins (0,2],(2,5],(5,8],(8,11],(11,12]."""
    m = col(month)
    return (F.when(m <= 2, "winter").when(m <= 5, "spring").when(m <= 8, "summer")
            .when(m <= 11, "fall").when(m <= 12, "winter"))


def regime(d, vol_start: str, vol_end: str) -> Column:
    d = col(d)
    return (F.when(d < F.lit(vol_start).cast("date"), "mandatory_pre")
            .when(d <= F.lit(vol_end).cast("date"), "voluntary")
            .otherwise("mandatory_post"))


def region_lookup(spark: SparkSession, mapping: dict | None = None) -> DataFrame:
    """The (51-row, fixed size) region dictionary as a DataFrame for a broadcast join."""
    mapping = US_REGION if mapping is None else mapping
    return spark.createDataFrame(sorted(mapping.items()), "region_key string, region string")


def add_region(df: DataFrame, key: str = "state_territory", mapping: dict | None = None,
               out: str = "region") -> DataFrame:
    """Left join to the fixed-size dictionary (broadcast: its size is a constant)."""
    lk = region_lookup(df.sparkSession, mapping).withColumnRenamed("region", "__region")
    j = df.join(F.broadcast(lk), F.lower(F.col(key)) == lk["region_key"], "left")
    return (j.withColumn(out, F.coalesce(F.col("__region"), F.lit(DEFAULT_REGION)))
            .drop("region_key", "__region"))
