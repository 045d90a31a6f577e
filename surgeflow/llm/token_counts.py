"""Exact length histogram: totals, quantiles and truncated totals for every context limit.

Each task encodes its documents and counts them by encoded length, so the shuffle carries
one row per task and distinct length whatever the number of documents.  The histogram has
at most one row per distinct length (bounded by the longest document, not by the corpus);
suffix sums run inside blocks of lengths plus over the block totals.

Edge cases: null and empty texts have length 0 (plus ``extra`` ids per document); an empty
table gives an empty histogram; repeated rows count each time; only ``text`` is read.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import default_vocabulary, stage, token_ids

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


def length_histogram(docs: DataFrame, vocabulary: str | None = None, extra: int = 0) -> DataFrame:
    """(n_tokens, n_docs): exact counts of documents by encoded length."""
    path = vocabulary or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths: Counter[int] = Counter()
        for batch in batches:
            for _, _, bounds in token_ids(path).encode(batch.column(0)):
                lengths.update((np.diff(bounds) + extra).tolist())
        if lengths:
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(lengths.keys(), pa.int64()),
                                              "n_docs": pa.array(lengths.values(), pa.int64())})

    counted = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    # written once: every later sum reads the few rows instead of encoding again
    return stage(counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "length-histogram")


def context_table(histogram: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """For every context limit that is a length, and every one of ``limits`` (column
    ``context_limit``; null ones are left out): suffix counts and totals.

    n_docs: documents of just that length; n_docs_over / tokens_over: documents longer than the
    limit and their tokens; tokens_truncated: sum of min(length, limit); docs_within: share of
    documents that fit (null if there are none).  A limit between two lengths is a length of no
    document, so the same sums answer it.
    """
    if limits is not None:
        asked = limits.where(F.col("context_limit").isNotNull()).select(
            F.col("context_limit").cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_docs"))
        histogram = histogram.select("n_tokens", "n_docs").union(asked).groupBy("n_tokens").agg(
            F.sum("n_docs").alias("n_docs"))
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_tokens") * F.col("n_docs")
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
              .select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_above"),
                      F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_above"),
                      F.sum("d").over(Window.partitionBy()).alias("docs"),
                      F.sum("t").over(Window.partitionBy()).alias("tokens")))
    inside = (Window.partitionBy("block").orderBy(F.desc("n_tokens"))
              .rowsBetween(Window.unboundedPreceding, -1))
    over = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("d_above")
    over_tokens = F.coalesce(F.sum(tokens).over(inside), F.lit(0)) + F.col("t_above")
    # one row per block of lengths on either side, so the broadcast is bounded by the longest text
    return (h.join(blocks, "block")
            .select(F.col("n_tokens").alias("context_limit"), "n_docs", over.alias("n_docs_over"),
                    over_tokens.alias("tokens_over"),
                    (F.col("tokens") - over_tokens + over * F.col("n_tokens")).alias("tokens_truncated"),
                    F.try_divide(F.col("docs") - over, F.col("docs")).alias("docs_within"),
                    F.col("docs").alias("total_docs"), F.col("tokens").alias("total_tokens")))


def quantiles(table: DataFrame, probabilities: list[float]) -> DataFrame:
    """Smallest length that at least a share p of the documents do not exceed."""
    within = F.col("total_docs") - F.col("n_docs_over")
    return table.agg(*[F.min(F.when((F.col("n_docs") > 0) & (within >= p * F.col("total_docs")), F.col("context_limit")))
                       .alias(f"p{p:g}") for p in probabilities])


def totals_at(table: DataFrame, limits: DataFrame) -> DataFrame:
    """Truncated totals for any limits (column ``context_limit``), between lengths included."""
    histogram = table.select(F.col("context_limit").alias("n_tokens"), "n_docs")
    return context_table(histogram, limits).join(limits.select("context_limit").distinct(), "context_limit", "left_semi") \
        .select("context_limit", "tokens_truncated")


def context_report(histogram: DataFrame, limits: list[int], probabilities: list[float]) -> DataFrame:
    """``context_table`` of all lengths and ``limits``, with the quantiles of the lengths beside
    every row (``length_p50`` for 0.5)."""
    asked = histogram.sparkSession.createDataFrame([(n,) for n in limits], "context_limit long")
    table = context_table(histogram, asked)
    found = quantiles(table, probabilities).toDF(*[f"length_p{100 * p:g}" for p in probabilities])
    return table.crossJoin(F.broadcast(found))  # one row
