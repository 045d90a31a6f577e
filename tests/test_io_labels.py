import os
import tempfile

import pytest
from pyspark.sql import functions as F

from surgeflow.config import LabelConfig
from surgeflow.operators import clean_labels as CL
from surgeflow.sources import io


def test_headers_and_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` A ` int, `b` int")
    n = io.normalize_headers(df)
    assert n.columns == ["a", "b"]
    assert io.resolve_column(n, ["x", "b", "a"]) == "b"
    with pytest.raises(KeyError):
        io.require_columns(n, ["a", "zz"])


def test_pick_largest_file(spark):
    d = tempfile.mkdtemp(prefix="sf-io-", dir="/tmp")
    for name, size in (("nhsn_small.csv", 10), ("nhsn_big.csv", 1000), ("other.txt", 5000)):
        with open(os.path.join(d, name), "w") as f:
            f.write("x" * size)
    assert io.pick_largest_file(spark, [f"{d}/*nhsn*.csv", f"{d}/*hrd*.csv"]).endswith("nhsn_big.csv")
    with pytest.raises(FileNotFoundError):
        io.pick_largest_file(spark, [f"{d}/*nothing*.csv"])


def _raw(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rollups_regime_and_coverage_fallback(spark):
    schema = ("` Jurisdiction ` string, weekendingdate string, totalconfc19newadm string, "
              "numconfc19newadmhosprep double, numhosprep double")
    rows = [("AK", "2024-04-27", "5", 9.0, 10.0), ("Region 1", "2024-04-27", "50", 1.0, 1.0),
            ("USA", "2024-04-27", "500", 1.0, 1.0), (None, "2024-04-27", "7", 1.0, 0.0),
            ("AK", "2024-06-01", "3", 1.0, 1.0), ("AK", "bad", "3", 1.0, 1.0),
            ("AK", "2024-11-02", "x", 1.0, 1.0), ("AK", "2024-11-09", "4", 1.0, 2.0)]
    cfg = LabelConfig(vol_start="2024-05-01", vol_end="2024-10-31")
    out = CL.clean_labels(_raw(spark, rows, schema), cfg).orderBy(F.col("week_end"),
                                                                  F.col("state_territory")).collect()
    assert [(r["state_territory"], r["regime"]) for r in out] == \
        [(None, "mandatory_pre"), ("ak", "mandatory_pre"), ("ak", "mandatory_post")]
    cov = {r["state_territory"]: r["coverage"] for r in out if r["regime"] == "mandatory_pre"}
    assert cov["ak"] == 0.9 and cov[None] is None          # zero denominator -> NULL
    log = [r["rows_remaining"] for r in CL.label_step_log(_raw(spark, rows, schema), cfg).collect()]
    assert log == [8, 6, 4, 3]


def test_missing_coverage_raises(spark):
    df = spark.createDataFrame([("AK", "2024-01-06", "1")],
                               "jurisdiction string, weekendingdate string, totalconfc19newadm string")
    with pytest.raises(KeyError):
        CL.clean_labels(df)


def test_feature_list_and_metrics_round_trip(spark):
    from surgeflow.config import MODEL_FEATURES
    from surgeflow.functions.semantics import numeric_columns
    from surgeflow.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    io.save_feature_list(spark, MODEL_FEATURES, f"{root}/test-features")
    assert io.load_feature_list(spark, f"{root}/test-features") == list(MODEL_FEATURES)
    m = spark.createDataFrame([("XGBoost", 0.5, 3)], "model string, f1 double, tp long")
    io.save_metrics(m, f"{root}/test-metrics")
    back = spark.read.json(f"{root}/test-metrics").first()
    assert back["model"] == "XGBoost" and back["tp"] == 3
    df = spark.createDataFrame([(1, True, "a", 2.0)], "i int, b boolean, s string, d double")
    assert numeric_columns(df) == ["i", "d"]                # booleans are not numbers


def test_declared_csv_keeps_faulty_records(spark, tmp_path):
    import datetime as dt
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("day,n,name\n2024-01-06,1,a\n2024-02-30,2,b\n2024-01-13,x,c\n2024-01-20\n2024-01-27,5,e,more\n"
                "\n,,\n\"2024-02-03\",7,\"x,y\"\n")
    df = io.read_csv_declared(spark, path, "day date, n int, name string", ["day", "n"])
    assert df.columns == ["day", "n", io.CORRUPT]
    day = dt.date
    assert [tuple(r) for r in df.collect()] == [
        (day(2024, 1, 6), 1, None), (None, 2, "2024-02-30,2,b"), (day(2024, 1, 13), None, "2024-01-13,x,c"),
        (day(2024, 1, 20), None, "2024-01-20"), (day(2024, 1, 27), 5, "2024-01-27,5,e,more"), (None, None, None),
        (day(2024, 2, 3), 7, None)]
    dates = io.read_csv_dates(spark, path, "day date, n int, name string")
    assert dates.columns == ["day", "n", "name"] and dates.where("day is null").count() == 2
    with pytest.raises(KeyError):
        io.read_csv_declared(spark, path, "day date", ["other"])
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv_dates(spark, path, "week date, n int, name string").collect()
