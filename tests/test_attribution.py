import itertools

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from surgeflow.operators import attribution as XP


def test_tree_shap_additivity(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 4))
    y = ((X[:, 0] + 0.5 * X[:, 1] * X[:, 2] + rng.normal(scale=0.3, size=300)) > 0).astype(float)
    rows = [(i, float(y[i]), *map(float, X[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double, c double, d double")
    v = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    m = GBTClassifier(maxIter=8, maxDepth=3, seed=1).fit(v)
    contrib = XP.tree_contributions(df, m, ["a", "b", "c", "d"], keys=["id"])
    raw = m.transform(v).select("id", vector_to_array("rawPrediction")[1].alias("F"),
                                vector_to_array("probability")[1].alias("p"))
    j = contrib.join(raw, "id").collect()
    for r in j:
        total = r["base"] + sum(r[f"phi_{c}"] for c in "abcd")
        assert abs(total - r["margin"]) < 1e-9
        assert abs(r["margin"] - 2 * r["F"]) < 1e-9
        assert abs(total - np.log(r["p"] / (1 - r["p"]))) < 1e-9
    # a feature the trees never split on gets exactly zero
    assert any(abs(r["phi_a"]) > 0 for r in j)


def conditional(tree_leaves, x, known, player):
    """Cover-weighted value of a tree when only the players in ``known`` are given."""
    total = 0.0
    for value, conds in tree_leaves:
        share = 1.0
        for col, thr, left, ratio in conds:
            share *= ((x[col] <= thr) == left) if player[col] in known else ratio
        total += value * share
    return total


def test_grouped_players_match_brute_force(spark, tmp_path):
    """A value and its missing indicator are one player; Shapley values over all subsets."""
    rng = np.random.default_rng(11)
    X = rng.normal(size=(250, 3))
    X[rng.random((250, 3)) < 0.25] = np.nan
    y = (np.nan_to_num(X[:, 0], nan=1.5) + np.nan_to_num(X[:, 1], nan=-1) * 0.7 > 0).astype(float)
    miss = np.isnan(X)
    full = np.column_stack((np.where(miss, -1e9, X), miss.astype(float)))
    cols = ["g_a", "g_b", "g_c", "m_a", "m_b", "m_c"]
    df = spark.createDataFrame([(i, float(y[i]), *map(float, full[i])) for i in range(250)],
                               "id long, label double, " + ", ".join(f"{c} double" for c in cols))
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    m = GBTClassifier(maxIter=6, maxDepth=4, seed=3).fit(v)
    player = [0, 1, 2, 0, 1, 2]
    got = XP.tree_contributions(df, m, cols, keys=["id"], group_of={c: c[2:] for c in cols}).collect()
    trees = XP.tree_table(m, str(tmp_path / "m"), spark)
    weight = {0: 1 / 3, 1: 1 / 6, 2: 1 / 3}
    for r in got[::10]:
        x = full[r["id"]]

        def game(known):
            return XP.LOG_ODDS * sum(w * conditional(leaves, x, known, player) for w, leaves in trees)
        for i, name in enumerate("abc"):
            others = [j for j in range(3) if j != i]
            phi = sum(weight[len(s)] * (game(set(s) | {i}) - game(set(s)))
                      for k in range(3) for s in itertools.combinations(others, k))
            assert abs(phi - r[f"phi_{name}"]) < 1e-9
        assert abs(game(set()) - r["base"]) < 1e-9
