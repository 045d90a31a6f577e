"""Exploratory statistics: correlation, linear fits, histograms, group summaries.

All multi-column statistics are computed in one aggregate pass: columns are
unpivoted to (feature, value) rows and grouped by feature, instead of one job
per column.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import semantics as S
from .quantiles import group_quantiles, quantiles_of_counts, value_counts


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (col_a, col_b, r).

    One row's share of the co-moment matrix (per pair: complete count, sums, squares, product) is
    a vector, and one aggregate adds the vectors up, map-side first; no row is repeated.  Values
    are centred on their column's mean beforehand, so the sums lose no digits.  Fewer than two
    complete pairs, or a column that is constant in them (its spread there below 1e-13 of the
    squared centred values), give NULL.
    """
    cols = list(columns)
    d = df.select(*[S.nan_to_null(F.col(c).cast("double")).alias(f"__x{i}") for i, c in enumerate(cols)])
    means = d.agg(*[F.avg(f"__x{i}").alias(f"__m{i}") for i in range(len(cols))])
    centred = d.crossJoin(F.broadcast(means)).select(*[(F.col(f"__x{i}") - F.col(f"__m{i}")).alias(f"__x{i}")
                                                       for i in range(len(cols))])
    pairs = [(i, k) for i in range(len(cols)) for k in range(i, len(cols))]
    parts = []
    for i, k in pairs:
        x, y = F.col(f"__x{i}"), F.col(f"__x{k}")
        both = x.isNotNull() & y.isNotNull()
        parts += [F.when(both, part).otherwise(0.0) for part in (F.lit(1.0), x, y, x * x, y * y, x * y)]
    # a row of zeros lets the aggregate answer an empty table
    none = df.sparkSession.range(1).select(F.array_repeat(F.lit(0.0), len(parts)).alias("v"))
    total = centred.select(F.array(*parts).alias("v")).union(none).select(array_to_vector("v").alias("v")).agg(
        vector_to_array(Summarizer.sum(F.col("v"))).alias("sums"))
    names = df.sparkSession.createDataFrame(
        [(6 * at, cols[a], cols[b]) for at, (i, k) in enumerate(pairs) for a, b in sorted({(i, k), (k, i)})],
        "at int, col_a string, col_b string")
    n, sx, sy, sxx, syy, sxy = [F.nullif(part, F.lit(0.0)) if j == 0 else part
                                for j, part in enumerate(F.get("sums", F.col("at") + j) for j in range(6))]

    def spread(squares, total):
        left = squares - total * total / n
        return F.when(left > 1e-13 * squares, left).otherwise(0.0)

    r = F.when(n > 1.5, S.safe_corr_parts(sxy - sx * sy / n, spread(sxx, sx), spread(syy, sy)))
    return F.broadcast(names).crossJoin(total).select("col_a", "col_b", r.alias("r"))  # one row of sums


def long_pairs(df: DataFrame, predictors: Sequence[str], target: str) -> DataFrame:
    """(predictor, x, y) rows for every predictor: one unpivot instead of a loop."""
    cols = [S.nan_to_null(F.col(p).cast("double")).alias(p) for p in predictors]
    d = df.select(*cols, S.nan_to_null(F.col(target).cast("double")).alias("__y"))
    return d.unpivot(["__y"], list(predictors), "predictor", "__x")


def linear_fits(df: DataFrame, predictors: Sequence[str], target: str,
                min_pairs: int = 2) -> DataFrame:
    """r, least-squares slope / intercept, r^2 and n per predictor (complete pairs only).

    Fewer than ``min_pairs`` complete pairs -> NULL statistics (the reference's NaN).
    """
    lp = long_pairs(df, predictors, target)
    y, x = F.col("__y"), F.col("__x")
    g = lp.groupBy("predictor").agg(
        F.regr_count(y, x).alias("n"), F.regr_sxy(y, x).alias("sxy"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
        F.regr_avgx(y, x).alias("mx"), F.regr_avgy(y, x).alias("my"))
    ok = F.col("n") >= min_pairs
    slope = F.try_divide(F.col("sxy"), F.when(F.col("sxx") != 0, F.col("sxx")))
    r = S.safe_corr_parts(F.col("sxy"), F.col("sxx"), F.col("syy"))
    return g.select("predictor", F.col("n").cast("long").alias("n"),
                    F.when(ok, r).alias("r"), F.when(ok, slope).alias("slope"),
                    F.when(ok, F.col("my") - slope * F.col("mx")).alias("intercept"),
                    F.when(ok, r * r).alias("r2"))


def corr_rank(fits: DataFrame) -> DataFrame:
    """Correlations sorted by absolute value (rank 1 = strongest)."""
    w = Window.orderBy(F.abs(F.col("r")).desc_nulls_last(), F.col("predictor"))
    # one row per predictor: a global window over this tiny table is bounded
    return fits.select("predictor", "r", F.row_number().over(w).cast("int").alias("rank"))


def minmax_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``MinMaxScaler`` fitted on the frame itself (NULL ignored, constant -> 0)."""
    stats = df.agg(*[F.min(c).alias(f"__lo_{c}") for c in columns],
                   *[F.max(c).alias(f"__hi_{c}") for c in columns])
    j = df.crossJoin(F.broadcast(stats))            # one-row scalar
    j = j.withColumns({f"{c}{suffix}": S.minmax_scaled(c, f"__lo_{c}", f"__hi_{c}")
                       for c in columns})
    return j.drop(*[f"__lo_{c}" for c in columns], *[f"__hi_{c}" for c in columns])


def fd_histogram(frames: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Histograms of several datasets on common Freedman-Diaconis edges, per column.

    Edges come from the concatenation of all datasets: width = 2 IQR n^(-1/3)
    (integer columns: width >= 1); IQR = 0 -> one bin; last bin closed.
    Output: column, dataset, bin, lo, hi, n_bins, count (non-empty bins).
    """
    parts = None
    int_cols = set()
    for name, df in frames.items():
        for f in df.schema.fields:
            if f.name in columns and isinstance(f.dataType, IntegralType):
                int_cols.add(f.name)
        d = df.select(*[S.nan_to_null(F.col(c).cast("double")).alias(c) for c in columns]) \
            .unpivot([], list(columns), "column", "x").where(F.col("x").isNotNull()) \
            .withColumn("dataset", F.lit(name))
        parts = d if parts is None else parts.unionByName(d)
    q = group_quantiles(parts, ["column"], "x", [0.25, 0.75], ["q1", "q3"])
    mm = parts.groupBy("column").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"),
                                     F.count(F.lit(1)).alias("n"))
    st = mm.join(q, "column")
    width = 2.0 * (F.col("q3") - F.col("q1")) * F.pow(F.col("n").cast("double"), -1.0 / 3.0)
    is_int = F.col("column").isin(*sorted(int_cols)) if int_cols else F.lit(False)
    width = F.when(is_int & (width < 1.0), F.lit(1.0)).otherwise(width)
    same = F.col("lo0") == F.col("hi0")
    lo = F.when(same, F.col("lo0") - 0.5).otherwise(F.col("lo0"))
    hi = F.when(same, F.col("hi0") + 0.5).otherwise(F.col("hi0"))
    nb = F.when(width > 0, F.ceil((F.col("hi0") - F.col("lo0")) / width)).otherwise(F.lit(1))
    nb = F.greatest(nb, F.lit(1)).cast("long")
    edges = st.select("column", lo.alias("lo"), hi.alias("hi"), nb.alias("n_bins"))
    j = parts.join(F.broadcast(edges), "column")    # one row per column: bounded
    step = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    b = F.least(F.floor((F.col("x") - F.col("lo")) / step), F.col("n_bins") - 1).cast("long")
    h = j.withColumn("bin", b).groupBy("column", "dataset", "bin", "lo", "hi", "n_bins") \
        .agg(F.count(F.lit(1)).alias("count"))
    stp = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    return h.select("column", "dataset", "bin", (F.col("lo") + F.col("bin") * stp).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * stp).alias("bin_hi"), "n_bins", "count")


def variation_rank(df: DataFrame, group: str, columns: Sequence[str], top_n: int = 10) -> DataFrame:
    """Per numeric column: mean per group -> sample std and range of those means -> top N."""
    d = df.select(group, *[S.nan_to_null(F.col(c).cast("double")).alias(c) for c in columns]) \
        .unpivot([group], list(columns), "feature", "v")
    means = d.groupBy("feature", group).agg(F.avg("v").alias("m")).where(F.col("m").isNotNull())
    g = means.groupBy("feature").agg(F.count(F.lit(1)).alias("k"),
                                     F.stddev_samp("m").alias("territory_mean_std"),
                                     (F.max("m") - F.min("m")).alias("territory_mean_range"))
    g = g.where(F.col("k") >= 2)
    w = Window.orderBy(F.col("territory_mean_std").desc(), F.col("feature"))
    # one row per feature: global ranking over a table bounded by the column count
    return g.select("feature", "territory_mean_std", "territory_mean_range",
                    F.row_number().over(w).cast("int").alias("rank")) \
        .where(F.col("rank") <= top_n)


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and whiskers (last point within 1.5 IQR) per group, no fliers.

    Everything comes from one (group, value, rows) table; the raw rows are read once."""
    counts = value_counts(df.where(F.col(group).isNotNull()), [group], value)
    q = quantiles_of_counts(counts, [group], [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr, v = F.col("q3") - F.col("q1"), F.col("__v")
    # one row of quartiles per group on the right
    return counts.join(q, group).groupBy(group).agg(
        F.sum("__c").alias("n"), *[F.any_value(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(v >= F.col("q1") - 1.5 * iqr, v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("q3") + 1.5 * iqr, v)).alias("whisker_hi"))


def tail_to_other(df: DataFrame, col: str, keep_tail: int = 3) -> DataFrame:
    """Counts per category; when there are more than ``keep_tail`` categories the
    ``keep_tail`` rarest (ties by name) are merged into 'other' (added to an existing
    'other').  Output: category, count, share (%)."""
    c = df.select(S.text_norm(col).alias("category")).where(F.col("category").isNotNull()) \
        .groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    w_all = Window.partitionBy()
    # category counts: one row per category, a bounded global window
    w = Window.orderBy(F.col("count").asc(), F.col("category").desc())
    c = c.withColumns({"__k": F.count(F.lit(1)).over(w_all), "__rn": F.row_number().over(w)})
    merged = F.when((F.col("__k") > keep_tail) & (F.col("__rn") <= keep_tail), F.lit("other")) \
        .otherwise(F.col("category"))
    g = c.groupBy(merged.alias("category")).agg(F.sum("count").alias("count"))
    return g.withColumn("share", 100.0 * F.col("count") / F.sum("count").over(w_all))


def relabel_other(df: DataFrame, col: str, kept: DataFrame) -> DataFrame:
    """Row-level category -> 'other' unless it is one of the kept categories."""
    k = kept.where(F.col("category") != "other").select(F.col("category").alias("__kc"))
    j = df.withColumn("__c", S.text_norm(col)).join(k, F.col("__c") == F.col("__kc"), "left")
    return j.withColumn(col, F.when(F.col("__c").isNull(), F.lit(None).cast("string"))
                        .when(F.col("__kc").isNotNull(), F.col("__c")).otherwise(F.lit("other"))) \
        .drop("__c", "__kc")


def pivot_share(df: DataFrame, group: str, col: str, order_category: str) -> tuple[DataFrame, list]:
    """Category share (%) per group as a wide 0-filled matrix, with the group's ``rank`` by
    falling share of ``order_category`` (ties by group); groups without it are dropped.

    Columns come in falling global frequency (ties by name).  More categories than Spark's
    pivot limit, or an absent ``order_category``, raise an error."""
    d = df.where(F.col(group).isNotNull() & F.col(col).isNotNull())
    cnt = d.groupBy(group, col).agg(F.count(F.lit(1)).alias("n"))
    cnt = cnt.withColumn("share", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    common = cnt.groupBy(col).agg(F.sum("n").alias("all")).orderBy(F.desc("all"), col).limit(most + 1)
    cats = [r[0] for r in common.collect()]
    if len(cats) > most:
        raise ValueError(f"more than {most} categories in {col}")
    if order_category not in cats:
        raise ValueError(f"no rows of category {order_category} in {col}")
    wide = cnt.groupBy(group).pivot(col, cats).agg(F.first("share")).fillna(0.0, subset=cats)
    first = Window.orderBy(F.desc(order_category), group)   # one row per group
    return wide.where(F.col(order_category) > 0).withColumn("rank", F.row_number().over(first)), cats
