import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgeflow.operators import guards as G

SCHEMA = "state_territory string, week_end string, z string, y double, extra string"


def _rows(spark):
    nan = float("nan")
    return spark.createDataFrame([
        (" ny", "2024-01-06", "1.5", 2.0, "a"), ("NY ", "2023-12-30", "2", 3.0, "b"), ("ny", "bad", "1", 1.0, "c"),
        ("ny", "2024-02-03", "x", 1.0, "d"), ("ny", "2024-02-10", "3", nan, "e"), ("ma", "2022-01-01", "1", 1.0, "f"),
        (None, "2024-01-06", "1", 1.0, "g")], SCHEMA)


def test_rows_pass_a_guard_unchanged(spark):
    df = _rows(spark)
    assert sorted(map(str, G.require_rows(df, "none", 7).collect())) == sorted(map(str, df.collect()))
    assert G.require_rows(df, "none").schema.names == df.schema.names


@pytest.mark.parametrize("action", [lambda d: d.collect(), lambda d: d.count(), lambda d: d.select(F.lit(1)).collect(),
                                    lambda d: d.groupBy("extra").count().collect(),
                                    lambda d: d.write.format("noop").mode("overwrite").save()])
def test_an_empty_result_raises_when_it_runs(spark, action):
    few = G.require_rows(_rows(spark), "too few rows here", 8)  # building it runs nothing
    empty = G.only_state(_rows(spark), "tx")
    for guarded, message in ((few, "too few rows here"), (empty, "No rows found for state 'tx'")):
        with pytest.raises(Exception, match=message):
            action(guarded)


def test_state_and_year(spark):
    numbers = ["z", "y"]
    assert {r.extra for r in G.usable_rows(_rows(spark), numbers, " Ny").collect()} == {"a", "b"}
    kept = G.usable_rows(_rows(spark), numbers, "ny", 2024).collect()
    assert [(r.state_territory, r.week_end, r.z, r.y) for r in kept] == [("NY", dt.date(2024, 1, 6), 1.5, 2.0)]
    assert {r.extra for r in G.usable_rows(_rows(spark), numbers).collect()} == {"a", "b", "f", "g"}
    with pytest.raises(Exception, match="No valid data remains"):
        G.usable_rows(_rows(spark), numbers, "ma", 2024).collect()


def test_pairs(spark):
    assert G.complete_pairs(_rows(spark).withColumn("z", F.try_to_number("z", F.lit("9.9"))), "z", "y").count() >= 2
    with pytest.raises(Exception, match="Not enough valid data"):
        G.complete_pairs(_rows(spark).where("extra = 'a'").withColumn("z", F.lit(1.0)), "z", "y").count()
