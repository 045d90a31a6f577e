"""Exact grouped quantiles, one lazy plan for every group size.

1. Rows are counted per (group, value) with map-side combine, so a group that holds a third
   of all rows is spread over its values.
2. Values fall into fixed logarithmic buckets (relative width ``2 ** -BUCKET_BITS``, so the
   bucket of a value never depends on the data).  One row per (group, bucket) gives every
   bucket the number of rows before it.
3. Only buckets that hold a needed rank are opened: a running count over their distinct values
   finds the order statistics.

Nothing is cached, collected or sized while the plan is built; the counts of step 1 are
shuffled once and read by both later steps.  The result is the linear-interpolation quantile
(pandas / numpy default, Spark ``percentile``, DuckDB ``quantile_cont``).

A stored table of many groups is read twice instead (``stored=True``): the first read counts rows
per (group, wide bucket), the second takes steps 1 to 3 for the values of the wide buckets that
hold a needed rank.  These few buckets are written, so a small table of them is broadcast and most
rows are shuffled by neither read.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BUCKET_BITS = 14
WIDE_BITS = 5


def bucket_of(v: Column, bits: int = BUCKET_BITS) -> Column:
    """Order-preserving bucket: ln is monotone, its range for doubles is -745..710."""
    width = F.floor((F.least(F.ln(F.abs(v)), F.lit(710.0)) + 750.0) * float(1 << bits))
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * width).cast("long")


def known_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and ``__v`` (the value as double); NULL and NaN are left out."""
    v = df.select(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("__v"))
    return v.where(F.col("__v").isNotNull())


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``known_values`` with ``__c``, the rows of each value."""
    return known_values(df, keys, value).groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))


def wide_value_counts(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """``value_counts`` of the wide buckets that hold a needed rank, each with its bucket
    ``__w``, the group's rows before it ``__start`` and the group's rows ``__n``.

    ``df`` is read twice; the chosen buckets (at most two per group and quantile) are written."""
    v = known_values(df, keys, value)
    wide = bucket_of(F.col("__v"), WIDE_BITS)
    totals = v.groupBy(*keys, wide.alias("__b")).agg(F.count(F.lit(1)).alias("__bn"))
    chosen = cut_lineage(opened_buckets(totals, keys, probs))
    inside = v.withColumn("__b", wide).join(chosen, same_bucket(keys))
    return inside.groupBy(*keys, F.col("__b").alias("__w"), F.col("__before").alias("__start"), "__n", "__v").agg(
        F.count(F.lit(1)).alias("__c"))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], names: Sequence[str],
                    exact: bool = True, accuracy: int = 10000, stored: bool = False) -> DataFrame:
    """Return ``keys + names``: the ``probs`` quantiles of ``value`` per group.

    NULL (and NaN) values are ignored; a group with no values is absent (without keys there is
    always one row, of nulls if there are no values).
    ``exact=False`` uses the mergeable ``percentile_approx`` sketch instead.
    ``stored=True`` is for a ``df`` that is cheap to read twice; it runs the first read at once.
    """
    keys = list(keys)
    if exact and stored:
        return quantiles_of_counts(wide_value_counts(df, keys, value, probs), keys, probs, names)
    if exact:
        return quantiles_of_counts(value_counts(df, keys, value), keys, probs, names)
    v = F.nanvl(F.col(value).cast("double"), F.lit(None))
    out = df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull()).groupBy(*keys).agg(
        F.percentile_approx("__v", list(probs), accuracy).alias("__q"))
    return out.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])


def ranks_of(probs: Sequence[float]) -> list[tuple[Column, Column, Column]]:
    """Position, lower and upper rank of every quantile in a group of ``__n`` rows."""
    pos = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    return [(x, F.floor(x).cast("long"), F.ceil(x).cast("long")) for x in pos]


def opened_buckets(totals: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The buckets of ``totals`` (``keys``, ``__b``, its rows ``__bn``) that hold a needed rank.

    They come as ``__k0``.., ``__ob``, ``__before`` (the group's rows before the bucket) and
    ``__n``.  ``totals`` of ``wide_value_counts`` go on from their wide buckets' ``__start``."""
    part = [*keys, "__w"] if "__w" in totals.columns else list(keys)
    # one row per group and bucket, whatever the number of rows
    before = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("__bn").over(before), F.lit(0))
    if "__w" in totals.columns:
        passed, n = F.col("__start") + passed, F.col("__n")
    else:
        n = F.sum("__bn").over(Window.partitionBy(*part))
    totals = totals.select(*keys, "__b", "__bn", passed.alias("__before"), n.alias("__n"))
    wanted = F.lit(False)
    for _, lo, hi in ranks_of(probs):
        for k in (lo, hi):
            wanted = wanted | ((F.col("__before") <= k) & (k < F.col("__before") + F.col("__bn")))
    return totals.where(wanted).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                       F.col("__b").alias("__ob"), "__before", "__n")


def same_bucket(keys: Sequence[str]) -> Column:
    same = F.col("__b") == F.col("__ob")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return same


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Sequence[float],
                        names: Sequence[str]) -> DataFrame:
    """``group_quantiles`` of a table made by ``value_counts`` or ``wide_value_counts``."""
    keys = list(keys)
    counts = counts.withColumn("__b", bucket_of(F.col("__v")))
    known = [c for c in ("__w", "__start", "__n") if c in counts.columns]
    totals = counts.groupBy(*keys, *known, "__b").agg(F.sum("__c").alias("__bn"))
    opened = opened_buckets(totals, keys, probs)
    ranks = ranks_of(probs)
    inside = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.drop(*known).join(opened, same_bucket(keys)).withColumn(
        "__from", F.col("__before") + F.coalesce(F.sum("__c").over(inside), F.lit(0)))

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("__from") <= k) & (k < F.col("__from") + F.col("__c")), F.col("__v")))

    picked = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *[
        at(k).alias(f"__{side}{i}") for i, (_, lo, hi) in enumerate(ranks) for side, k in (("lo", lo), ("hi", hi))])
    out = []
    for i, (name, (pos, lo, hi)) in enumerate(zip(names, ranks)):
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append(F.when(lo == hi, low).otherwise((hi - pos) * low + (pos - lo) * high).alias(name))
    return picked.select(*keys, *out)


def median_of(df: DataFrame, keys: Sequence[str], value: str, name: str, **kw) -> DataFrame:
    return group_quantiles(df, keys, value, [0.5], [name], **kw)


def scalar_quantile_frame(df: DataFrame, value: str, probs, names, **kw) -> DataFrame:
    """One-row frame of global quantiles (a hot 'group' of all rows)."""
    return group_quantiles(df, [], value, probs, names, **kw)
