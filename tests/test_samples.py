import datetime as dt

from pyspark.sql import functions as F

from surgeflow.config import CleanSamplesConfig, DRIVER_SAMPLES
from surgeflow.operators import clean_samples as CS
from surgeflow.sources import fixtures as fx

from conftest import SF0001


def test_golden_counts_sf0001(spark):
    st = CS.clean_samples(fx.samples_raw(spark, SF0001), DRIVER_SAMPLES)
    log = {r["step"]: r["rows_remaining"] for r in CS.sample_step_log(st).collect()}
    assert log["00_raw_load"] == 6000
    assert log["03_units_copies_per_L"] == 5674
    assert log["04_matrix_filter"] == 5144
    assert log["06_dedupe"] == 5053
    assert log["10_weekly_state_agg"] == 2724
    assert log["11_min_sites"] == 0
    side = CS.sample_side_counts(st).first()
    assert side["nondetects"] == 175 and side["outliers_flagged"] == 200
    assert st.med_lod.first()["med_lod"] == 28.0


def _raw(spark, rows):
    return spark.createDataFrame(rows, "record_id string, site string, state_territory string, "
                                 "sample_collect_date string, sample_matrix string, "
                                 "pcr_gene_target_agg string, pcr_target_avg_conc string, "
                                 "pcr_target_units string, lod_sewage string, population_served long")


def test_keep_first_nondetect_and_null_site(spark):
    rows = [
        ("r2", "s1", " AK ", "2024-01-01", "raw wastewater", "n1", "100", "copies/L wastewater", "10", 5),
        ("r1", "s1", "ak", "2024-01-01", "raw wastewater", "n1", "0", "copies/l wastewater", "10", 5),
        ("r3", "s1", "ak", "2024-01-02", "raw wastewater", "n1", "2", "log10 copies/l wastewater", None, 5),
        ("r4", None, "ak", "2024-01-03", "raw wastewater", "n1", "1000", "copies/l wastewater", None, 7),
        ("r5", "s2", "ak", "2024-01-03", "sludge", "n1", "1000", "copies/l wastewater", None, 7),
        ("r6", "s2", "ak", "bad", "raw wastewater", "n1", "1000", "copies/l wastewater", None, 7),
        ("r7", "s2", "ak", "2024-01-04", "raw wastewater", "n1", "text", "copies/l wastewater", "8", 7),
    ]
    st = CS.clean_samples(_raw(spark, rows), CleanSamplesConfig(min_sites=1, checkpoint=False))
    d = {r["record_id"]: r for r in st.deduped.collect()}
    assert "r1" in d and "r2" not in d                   # lowest record id kept
    assert d["r1"]["conc"] == 5.0 and d["r1"]["nondetect_flag"] == 1   # LOD/2
    assert abs(d["r3"]["conc"] - 100.0) < 1e-9           # log10 unit converted
    assert d["r7"]["conc"] is None                        # text survives as missing (T18)
    s = {r["record_id"]: r for r in st.scored.collect()}
    assert s["r4"]["conc_site_z"] == 0.0 and s["r4"]["robust_z"] is None
    w = st.weekly_all.collect()
    assert len(w) == 1 and w[0]["state_territory"] == "ak"
    assert w[0]["week_end"] == dt.date(2024, 1, 6)
    assert w[0]["n_samples"] == 4 and w[0]["n_sites"] == 2   # r1, r3, r4, r7


def test_duplicates_are_sorted_in_tasks_that_follow_the_table(spark, tmp_path, monkeypatch):
    rows = [(k // 3, k % 40, k // 40 % 30, k % 5, float(k % 9), 100.0 + k % 7, 0.01, 0.03, "A", "O",
             dt.datetime(1998, 1, 1 + k % 3)) for k in range(1200)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 4, 10.0 * k) for k in range(30)], "s_suppkey long, s_nationkey long, s_acctbal double") \
        .write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(4)], "n_nationkey long, n_name string") \
        .write.parquet(f"{tmp_path}/nation.parquet")

    def first_rows():
        kept = fx.samples_raw(spark, str(tmp_path))
        tasks = kept.select("site").rdd.getNumPartitions()
        deduped = CS.dedupe_first(CS.prepare(kept, DRIVER_SAMPLES)).drop("__ord")
        return tasks, sorted(map(str, deduped.collect()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, expected = first_rows()
        monkeypatch.setattr(fx, "ROWS_PER_TASK", 50)
        many, got = first_rows()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few <= 8 and many == 24
    assert got == expected and 0 < len(got) < 1200


def test_counts_of_the_samples_do_not_deal_the_table(spark, tmp_path, monkeypatch):
    from surgeflow.plans.stages import samples

    rows = [(k // 3, k % 40, k // 40 % 30, k % 5, float(k % 9), 100.0 + k % 7, 0.01, 0.03, "A", "O",
             dt.datetime(1998, 1, 1 + k % 3)) for k in range(1200)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 4, 10.0 * k) for k in range(30)], "s_suppkey long, s_nationkey long, s_acctbal double") \
        .write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(4)], "n_nationkey long, n_name string") \
        .write.parquet(f"{tmp_path}/nation.parquet")
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 50)
    st = samples(spark, str(tmp_path))
    for counted in (st.prepared, st.filtered, st.med_lod):
        assert "RepartitionByExpression" not in counted._jdf.queryExecution().analyzed().toString()
    log = {r["step"]: r["rows_remaining"] for r in CS.sample_step_log(st).collect()}
    alone = CS.clean_samples(fx.samples_raw(spark, str(tmp_path)), DRIVER_SAMPLES)
    assert log == {r["step"]: r["rows_remaining"] for r in CS.sample_step_log(alone).collect()}
    assert sorted(map(str, st.deduped.collect())) == sorted(map(str, alone.deduped.collect()))
    assert CS.sample_side_counts(st).collect() == CS.sample_side_counts(alone).collect()
