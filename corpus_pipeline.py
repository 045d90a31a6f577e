"""Training-data pipeline over ``documents``: five stages, each one operator of surgeflow.llm.

Every stage but the last keeps rows of ``documents`` with all their columns; the last packs
what is left.  The dedup stages tell rows apart by a number given when they begin, so repeated
and null ids and columns of any name pass through.  Edge cases follow the operators: null and
empty texts are clean, are one group of copies, have no benchmark words and are packed as
one token; an empty table stays empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.llm import cuckoo, decontam, ngram_join, packing, toxicity
from surgeflow.llm.common import read_table, stage

#: Columns that a stage adds for its own use.
ROW, SCORE = "__pipeline_row", "__pipeline_score"


def _numbered(docs: DataFrame) -> DataFrame:
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")


def _view(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col(ROW).alias("row"), "doc_id", "text")


def _without(numbered: DataFrame, dropped: DataFrame) -> DataFrame:
    return numbered.join(dropped.select(F.col("row").alias(ROW)), ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = docs.withColumn(SCORE, toxicity.score_column(model, F.col("text"), spark))
    return scored.where(F.col(SCORE) < 0.5).drop(SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    return _without(rows, cuckoo.exact_groups(_view(rows), "row").where(~F.col("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    return _without(rows, ngram_join.near_classes(_view(rows), "row").where("row <> class_row and n_grams > 0"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the verdict depends on the text alone, so equal rows need no number to share it
    hashed = docs.withColumn(ROW, F.xxhash64(F.coalesce("text", F.lit(""))))
    found = decontam.decontaminate(hashed.select(F.struct("doc_id", ROW).alias("doc_id"), "text"),
                                   read_table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id.doc_id").alias("bad_id"),
                                             F.col(f"doc_id.{ROW}").alias("bad_hash")).distinct()
    return hashed.join(bad, hashed["doc_id"].eqNullSafe(bad["bad_id"]) & (hashed[ROW] == bad["bad_hash"]),
                       "left_anti").drop(ROW)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: Training and packing are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
