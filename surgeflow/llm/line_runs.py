"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A run is a Parquet table of (key, keeper, n_docs) sorted by the 128-bit line hash.  A batch
of lines is merge-joined with the runs: hashes that no run holds (anti-join) become the
batch's own run with the batch's largest document id as keeper; for the others only the
count is added.  Batches come in descending order of document id, so the first run that
holds a line knows the document that keeps it.  ``FAN_IN`` runs of one level are compacted
to one run of the next.

Edge cases: null and empty texts are one empty line; an id counts once per line however
often the row repeats, and repeated rows are treated alike; a null id sorts below all
others; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

#: Runs of one level that are merged into one run of the next.
FAN_IN = 2
#: Batches into which a whole table is cut by descending document id.
BATCHES = 4
#: Fixed values of the task: characters stripped at both ends, least key length, least documents.
BLANKS = " \t\n\u000b\f\r"
MIN_CHARS, MIN_DOCS = 20, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, line_no, key) of every line long enough to be a duplicate."""
    lines = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                        F.posexplode(text_lines(F.col("text"))).alias("line_no", "line"))
    return (lines.withColumn("line", line_key(F.col("line")))
            .where(F.char_length("line") >= min_chars)
            .select("doc_id", "text_hash", "line_no", F.unhex(F.md5("line")).alias("key")))


class LineRuns:
    """The levelled runs; every run is a written table, so a lost executor loses nothing."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Merge-anti-join a batch's (doc_id, key) with the runs and add its own run."""
        batch = (lines.select("key", "doc_id").distinct()
                 .groupBy("key").agg(F.max("doc_id").alias("keeper"), F.count(F.lit(1)).alias("n_docs")))
        runs = self.runs()
        if runs:
            held = runs[0].select("key")
            for run in runs[1:]:
                held = held.unionByName(run.select("key"))
            seen = held.distinct().withColumn("seen", F.lit(True))
            # a right side without the key is the anti-joined part: it brings the keeper
            batch = batch.join(seen, "key", "left").select(
                "key", F.when(F.col("seen").isNull(), F.col("keeper")).alias("keeper"),
                F.col("seen").isNull().alias("first"), "n_docs")
        else:
            batch = batch.select("key", "keeper", F.lit(True).alias("first"), "n_docs")
        self._put(0, batch.repartition("key").sortWithinPartitions("key"))

    def _put(self, level: int, run: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stage(run, f"line-run-{level}"))
        if len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, merged(full).repartition("key").sortWithinPartitions("key"))

    def counts(self) -> DataFrame:
        """(key, keeper, n_docs) over all runs."""
        return merged(self.runs())


def merged(runs: list[DataFrame]) -> DataFrame:
    """One row per key: counts add up; exactly one run brings the keeper."""
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("key").agg(F.max("keeper").alias("keeper"), F.bool_or("first").alias("first"),
                                   F.sum("n_docs").alias("n_docs"))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES) -> DataFrame:
    """(doc_id, text_hash, dropped): line numbers each document loses."""
    lines = hashed_lines(docs, min_chars)
    cuts = [k / batches for k in range(1, batches)]
    whole_numbers = dict(docs.dtypes)["doc_id"] in ("int", "bigint", "smallint", "tinyint")
    # rough cuts are enough: they only decide which batch a document comes in
    found = docs.stat.approxQuantile("doc_id", cuts, 0.01) if cuts and whole_numbers else []
    bounds = sorted({int(b) for b in found})
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("doc_id") > F.lit(bound), 0).otherwise(1)
    lines = stage(lines.withColumn("batch", batch), "lines", ["batch"])
    runs = LineRuns(docs.sparkSession)
    for k in range(len(bounds) + 1):
        runs.add(lines.where(F.col("batch") == k))
    common = runs.counts().where(F.col("n_docs") >= min_docs).select("key", "keeper")
    return (lines.join(common, "key")
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("dropped")))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               batches: int = BATCHES) -> DataFrame:
    """``doc_id``, ``text`` without the dropped lines, ``n_lines`` before and ``n_dropped``."""
    lost = dropped_lines(docs, min_chars, min_docs, batches).select(
        F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"), "dropped")
    # the lines are split below the join, so the lambda that picks lines does not split again
    cut = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                      text_lines(F.col("text")).alias("lines"))
    out = cut.join(lost.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("lost_id"))
                   & (F.col("text_hash") == F.col("lost_hash")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(
        F.transform(left, lambda i: F.get("lines", i)))
    return out.select("doc_id", F.array_join(kept, "\n").alias("text"),
                      F.size("lines").cast("long").alias("n_lines"),
                      F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"))
