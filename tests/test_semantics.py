import datetime as dt

from pyspark.sql import functions as F

from surgeflow.functions import semantics as S
from surgeflow.functions.calendar import iso_week, season, week_end_saturday


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("1.5",), ("1d",), ("NaN",), ("inf",), ("1,234",), (" 2e3 ",),
                                (None,), ("abc",)], "v string")
    got = [r[0] for r in df.select(S.coerce_double("v", df.schema["v"].dataType)).collect()]
    assert got == [1.5, None, None, None, None, 2000.0, None, None]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in df.select(S.nan_to_null("v")).collect()] == [None, 1.0]


def test_date_coercion_and_saturday(spark):
    df = spark.createDataFrame([("2024-01-06",), ("2024-01-07",), ("bad",), ("01/02/2021",)], "d string")
    out = df.select(S.coerce_date("d").alias("d")).select(
        "d", week_end_saturday("d").alias("w"), iso_week("d").alias("iso")).collect()
    assert out[0]["w"] == dt.date(2024, 1, 6)          # Saturday stays
    assert out[1]["w"] == dt.date(2024, 1, 13)         # Sunday -> next Saturday
    assert out[2]["d"] is None
    assert out[3]["d"] == dt.date(2021, 1, 2) and out[3]["iso"] == 53


def test_prefix_pad_clip(spark):
    df = spark.createDataFrame([(None, "123456", None), ("region 1", "", 0.5), ("x", "7", 5.0)],
                               "s string, c string, v double")
    r = df.select(S.prefix_test("s", "region").alias("p"), S.pad_code("c").alias("c"),
                  S.log10_clip("v").alias("l")).collect()
    assert [x["p"] for x in r] == [False, True, False]
    assert [x["c"] for x in r] == ["123456", "00000", "00007"]
    assert r[0]["l"] is None and r[1]["l"] == 0.0


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    assert df.agg(S.safe_corr("x", "y")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "x double, y double")
    assert abs(df2.agg(S.safe_corr("x", "y")).first()[0] - 1.0) < 1e-12


def test_season_bins(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r[0] for r in df.orderBy("m").select(season("m")).collect()]
    assert got == ["winter", "winter", "spring", "spring", "spring", "summer", "summer", "summer",
                   "fall", "fall", "fall", "winter"]
