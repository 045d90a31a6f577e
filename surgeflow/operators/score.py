"""Latest-row scoring for every area at once (the dashboard's computation)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from ..functions.calendar import iso_week
from .models import FittedModels, apply_impute, apply_scale, sentinel_columns, strength


def latest_features(weekly: DataFrame, labels: DataFrame, key: str = "state_territory",
                    week: str = "week_end") -> DataFrame:
    """Last weekly row per area + lags / delta / 3-row mean (min_periods=1) +
    the area's latest label row, which may belong to another week (T24)."""
    w = Window.partitionBy(key).orderBy(week)
    wd = Window.partitionBy(key).orderBy(F.col(week).desc())
    x = F.col("log10_conc_mean")
    f = weekly.withColumns({
        **{f"log10_conc_lag{L}": F.lag(x, L).over(w) for L in (1, 2, 3)},
        "conc_roll3": F.avg(x).over(w.rowsBetween(-2, 0)),
        "__rn": F.row_number().over(wd),
    }).where(F.col("__rn") == 1).drop("__rn")
    f = f.withColumns({"conc_delta_1w": x - F.col("log10_conc_lag1"),
                       "month": F.month(week), "epiweek_of_year": iso_week(week)})
    h = labels.withColumn("__rn", F.row_number().over(wd)).where(F.col("__rn") == 1) \
        .select(key, F.col(week).alias("hosp_week_end"), "admits", "coverage")
    j = f.join(h, key, "left")
    return j.withColumns({
        "admits_per100k": F.col("admits") / 1e5,
        "week_gap_days": F.datediff(F.col(week), F.col("hosp_week_end")),
    })


def score_latest(fm: FittedModels, latest: DataFrame) -> DataFrame:
    cols = fm.features
    x = apply_scale(sentinel_columns(apply_impute(latest, fm.med, cols), cols), fm.scale, cols)
    x = fm.gbt.transform(x)
    p1 = vector_to_array(F.col("gbt_prob"))[1]
    pred = F.col("gbt_pred").cast("int")
    out = x.select("state_territory", "week_end", "hosp_week_end", "week_gap_days",
                   pred.alias("prediction"), p1.alias("probability"))
    out = out.withColumn("confidence", F.when(F.col("prediction") == 1, F.col("probability"))
                         .otherwise(1.0 - F.col("probability")))
    return out.withColumn("strength", strength("confidence"))
