import numpy as np
from pyspark.sql import functions as F

from surgeflow.operators.quantiles import group_quantiles, wide_value_counts
from surgeflow.operators.stats import box_stats, corr_matrix
from surgeflow.session import cut_lineage


def test_group_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("hot", 3000), ("a", 1), ("b", 2), ("c", 57)):
        vals = np.round(rng.lognormal(3, 2, n), 3)         # ties on purpose
        rows += [(g, float(v)) for v in vals]
    rows += [("hot", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q1"], r["med"], r["q9"]) for r in
           group_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["q1", "med", "q9"]).collect()}
    for g in ("hot", "a", "b", "c"):
        v = np.array([x for k, x in rows if k == g and x is not None and not np.isnan(x)])
        exp = np.percentile(v, [10, 50, 90])
        assert np.allclose(got[g], exp, rtol=1e-12, atol=1e-12), g


def test_global_quantile(spark):
    rng = np.random.default_rng(3)
    vals = [float(x) for x in rng.integers(0, 50, 5000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = group_quantiles(df, [], "v", [0.5, 0.25], ["m", "q"]).first()
    assert r["m"] == np.percentile(vals, 50) and r["q"] == np.percentile(vals, 25)


def test_signs_zeros_extremes_and_null_keys(spark):
    vals = [-1e300, -5.5, -5.5, -1e-310, -0.0, 0.0, 5e-324, 3.25, 7e8, 1e300]
    df = spark.createDataFrame([("g", v) for v in vals] + [(None, 2.0), (None, 4.0)], "g string, v double")
    got = {r.g: (r.a, r.b, r.c) for r in group_quantiles(df, ["g"], "v", [0.0, 0.3, 1.0], ["a", "b", "c"]).collect()}
    assert np.allclose(got["g"], np.percentile(vals, [0, 30, 100]), rtol=1e-12, atol=0)
    assert np.allclose(got[None], (2.0, 2.6, 4.0), rtol=1e-12)
    assert group_quantiles(df.where("v > 1e305"), [], "v", [0.5], ["m"]).collect() == [(None,)]


def test_quantiles_leave_nothing_cached_and_are_lazy(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "plan only")
    group_quantiles(spark.range(100).select(F.col("id").cast("double").alias("v")), [], "v", [0.5], ["m"])
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("other", "")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_sketch_switch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    r = group_quantiles(df, [], "v", [0.5], ["m"], exact=False).first()
    assert abs(r["m"] - 500.0) <= 1.0


def test_box_stats_with_ties_nulls_and_a_single_value(spark):
    rng = np.random.default_rng(9)
    data = {"a": np.round(rng.lognormal(2, 1, 500), 1), "b": np.array([3.0]), "c": np.array([1.0, 1.0, 1.0, 50.0])}
    rows = [(g, float(x)) for g, v in data.items() for x in v] + [("a", None), (None, 1.0), ("d", None)]
    got = {r.g: r for r in box_stats(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert set(got) == set(data)
    for g, v in data.items():
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = v[v >= q1 - 1.5 * (q3 - q1)].min(), v[v <= q3 + 1.5 * (q3 - q1)].max()
        r = got[g]
        assert r.n == len(v) and np.allclose((r.q1, r.median, r.q3, r.whisker_lo, r.whisker_hi), (q1, med, q3, lo, hi))


def test_corr_matrix_is_pairwise_complete_without_repeating_rows(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((400, 3)) * [1.0, 1e-3, 5.0] + [1e6, 0.0, -7.0]  # far from zero on purpose
    x[:, 2] += 3 * x[:, 1] * 1e3
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [(*map(float, r), 0.1, None) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double, none double")
    made = corr_matrix(df, ["a", "b", "c", "same", "none"])
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    got = {(r.col_a, r.col_b): r.r for r in made.collect()}
    assert len(got) == 25
    for i, a in enumerate("abc"):
        for k, b in enumerate("abc"):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, k])
            assert abs(got[a, b] - np.corrcoef(x[ok, i], x[ok, k])[0, 1]) < 1e-9
    assert all(got[p] is None for p in got if {"same", "none"} & set(p))
    assert {r.r for r in corr_matrix(df.limit(0), ["a", "b"]).collect()} == {None}


def test_stored_table_is_read_twice_and_most_rows_are_not_shuffled(spark):
    rng = np.random.default_rng(5)
    groups = [(g, n) for g, n in (("a", 1), ("b", 2), ("hot", 20_000))] + [(f"s{i}", 300) for i in range(40)]
    rows = [(g, float(x)) for g, n in groups for x in rng.lognormal(2, 1, n) * rng.choice([-1, 1], n)]
    rows += [("hot", None), ("a", float("nan")), ("none", None), (None, 2.0), (None, 4.0), ("zero", 0.0), ("zero", -0.0)]
    df = cut_lineage(spark.createDataFrame(rows, "g string, v double").repartition(3))
    probs, names = [0.0, 0.1, 0.5, 1.0], ["lo", "q1", "med", "hi"]
    made = group_quantiles(df, ["g"], "v", probs, names, stored=True)
    got, plain = ({r.g: tuple(r)[1:] for r in x.collect()} for x in (made, group_quantiles(df, ["g"], "v", probs, names)))
    assert got == plain and "none" not in got and np.allclose(got[None], (2.0, 2.2, 3.0, 4.0))
    for g, _ in groups:
        assert np.allclose(got[g], np.percentile([x for k, x in rows if k == g and x is not None and x == x],
                                                 [0, 10, 50, 100]), rtol=1e-12), g
    counted = wide_value_counts(df, ["g"], "v", [0.5])
    assert counted.count() < len(rows) / 10
    assert "BroadcastHashJoin" in counted._jdf.queryExecution().executedPlan().toString()
