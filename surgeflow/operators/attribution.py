"""Attribution of boosted-tree and linear predictions.

``tree_contributions`` computes exact path-dependent Shapley values of a Spark
``GBTClassificationModel``'s log-odds for every row, as a ``mapInPandas`` job: the
tree table (bounded by trees x nodes, independent of the data volume) is read
from the saved model and shipped with the task closure; rows stay distributed.

For one leaf with value v, the cover-weighted conditional expectation is the
product game  g(S) = v * prod_{j in P} (j in S ? o_j(x) : z_j)  over the distinct
features P on its path (o_j: x satisfies every split on j; z_j: product of cover
ratios of those splits).  Its Shapley values are enumerated over the subsets of
P (|P| <= depth), vectorised over the rows of a batch.  Summed over leaves and
trees, sum(contributions) + base = margin.  The players j are reported features: input
columns of one feature (a value and its missing indicator) enter or leave together.  The
model's probability is 1 / (1 + exp(-2 raw)), so log-odds are ``LOG_ODDS`` times raw.
"""
from __future__ import annotations

import itertools
import math
import os
import uuid
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Log-odds per unit of the boosted model's raw prediction.
LOG_ODDS = 2.0


def tree_table(gbt_model, path: str, spark) -> list:
    """Save the model under ``path`` and read back its node table as leaf paths."""
    gbt_model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("thr")).collect()
    weights = list(gbt_model.treeWeights)
    by_tree: dict = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r
    trees = []
    for t, nd in sorted(by_tree.items()):
        leaves = []

        def walk(nid, conds):
            n = nd[nid]
            if n["leftChild"] < 0:
                leaves.append((n["prediction"], list(conds)))
                return
            for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
                ratio = nd[child]["rawCount"] / max(n["rawCount"], 1)
                walk(child, conds + [(n["featureIndex"], n["thr"], left, ratio)])

        walk(0, [])
        trees.append((weights[t], leaves))
    return trees


def _leaf_terms(leaves, player: Sequence[int]):
    """Pre-compute per leaf: players, their conditions, z_j, and Shapley weights.

    ``player[i]`` is the player that input column i belongs to.
    """
    out = []
    for value, conds in leaves:
        feats = sorted({player[c[0]] for c in conds})
        z = {j: float(np.prod([c[3] for c in conds if player[c[0]] == j])) for j in feats}
        cj = {j: [(c[0], c[1], c[2]) for c in conds if player[c[0]] == j] for j in feats}
        m = len(feats)
        subsets = {}
        for i in feats:
            others = [j for j in feats if j != i]
            lst = []
            for k in range(len(others) + 1):
                coef = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                for s in itertools.combinations(others, k):
                    lst.append((coef, s, tuple(j for j in others if j not in s)))
            subsets[i] = lst
        out.append((value, feats, z, cj, subsets))
    return out


def shap_batch(X: np.ndarray, trees, players: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(contributions n x players, margin n, base) in log-odds for a batch of feature rows."""
    n = len(X)
    phi = np.zeros((n, players))
    margin = np.zeros(n)
    base = 0.0
    for w, leaves in trees:
        for value, feats, z, cj, subsets in leaves:
            o = {}
            for j in feats:
                ok = np.ones(n, dtype=bool)
                for col, thr, left in cj[j]:
                    ok &= (X[:, col] <= thr) if left else (X[:, col] > thr)
                o[j] = ok.astype(float)
            zz = float(np.prod([z[j] for j in feats])) if feats else 1.0
            base += w * value * zz
            reach = np.ones(n)
            for j in feats:
                reach *= o[j]
            margin += w * value * reach
            for i in feats:
                acc = np.zeros(n)
                for coef, s, rest in subsets[i]:
                    term = np.full(n, coef * float(np.prod([z[k] for k in rest])) if rest else coef)
                    for j in s:
                        term = term * o[j]
                    acc += term
                phi[:, i] += w * value * (o[i] - z[i]) * acc
    return LOG_ODDS * phi, LOG_ODDS * margin, LOG_ODDS * base


def tree_contributions(df: DataFrame, gbt_model, input_cols: Sequence[str],
                       keys: Sequence[str] = ("state_territory", "week_end"),
                       group_of: dict | None = None) -> DataFrame:
    """Wide table: keys, base, margin and one contribution column per feature group.

    ``group_of`` maps model input columns to reported features (e.g. the sentinel
    value and its missing indicator both report to the original feature).
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"attribution-model-{uuid.uuid4().hex}")
    group_of = group_of or {c: c for c in input_cols}
    names = list(dict.fromkeys(group_of[c] for c in input_cols))
    player = [names.index(group_of[c]) for c in input_cols]
    trees = [(w, _leaf_terms(leaves, player)) for w, leaves in tree_table(gbt_model, path, spark)]
    keys = list(keys)
    out_schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keys]
                           + ["base double", "margin double"]
                           + [f"phi_{nm} double" for nm in names])
    cols = list(input_cols)

    def run(batches):
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=float)
            phi, margin, base = shap_batch(X, trees, len(names))
            res = pdf[keys].copy()
            res["base"] = base
            res["margin"] = margin
            for i, nm in enumerate(names):
                res[f"phi_{nm}"] = phi[:, i]
            yield res

    return df.select(*keys, *cols).mapInPandas(run, out_schema)


def to_long(wide: DataFrame, keys=("state_territory", "week_end")) -> DataFrame:
    phis = [c for c in wide.columns if c.startswith("phi_")]
    renamed = wide.select(*keys, *[F.col(c).alias(c[4:]) for c in phis])
    return renamed.unpivot(list(keys), [c[4:] for c in phis], "feature", "contribution")


def mean_abs_rank(long: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    g = long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    w = Window.orderBy(F.col("mean_abs_contribution").desc(), "feature")  # one row per feature
    return g.withColumn("rank", F.row_number().over(w).cast("int"))


def linear_contributions(df: DataFrame, coef: Sequence[float], cols: Sequence[str],
                         means: dict) -> DataFrame:
    """coef_i * (x_i - mean_i) per feature for a (standardised) linear model."""
    return df.select("state_territory", "week_end", *[
        (F.lit(float(b)) * (F.col(c) - F.lit(float(means.get(c, 0.0))))).alias(f"phi_{c}")
        for b, c in zip(coef, cols)])
