from collections import Counter

from llm_cases import EDGE_DOCS, SF0001, table  # noqa: F401
from pyspark.sql import functions as F
from test_text_ops import brute_exact, brute_hits, brute_near, check_packing

import __spark_entry__ as entry
import corpus_pipeline
from surgeflow.llm import queries, toxicity
from surgeflow.llm.common import read_table, stage


def test_queries_are_registered():
    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in found if q.startswith("op")}
    assert "pipeline" in found and set(queries.ORACLE) <= set(found)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def brute_stage(name, before, benchmark):
    """Texts and ids that a stage keeps, from its input rows."""
    if name == "exact_dedup":
        return Counter(i for i, _ in brute_exact(before).values())
    if name == "ngram_jaccard_join":
        classes, _ = brute_near(before)
        return len(set(classes))
    hits = brute_hits(before, benchmark)
    return Counter(i for i, n_words, n_hit, _ in hits if not (n_hit and 20 * n_hit >= n_words))


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF0001, "documents")
    labels = read_table(spark, SF0001, "labels")
    benchmark = [tuple(r) for r in read_table(spark, SF0001, "benchmark").select("item_id", "text").collect()]
    toxic = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).where("predicted = 1").collect()}
    for name, function in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = stage(function(spark, docs, SF0001), f"test-{name}")
        if name == "packing":
            n, total = check_packing(docs.collect(), before, 2048)
            assert n <= 1.02 * total / 2048 + 1
            break
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = Counter(i for i, _ in rows_of(docs))
        if name == "toxicity":
            assert kept == Counter(i for i, _ in before if i not in toxic)
        elif name == "ngram_jaccard_join":
            assert sum(kept.values()) == brute_stage(name, before, benchmark)
        else:
            assert kept == brute_stage(name, before, benchmark)


def test_stages_on_edge_rows(spark, table):
    docs = table(EDGE_DOCS, "doc_id long, text string")
    docs = stage(docs.withColumn("row", F.lit(7)), "test-edges")
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, docs, SF0001), f"test-edge-{name}")
        assert after.columns == docs.columns and after.count() > 0
        empty = function(spark, docs.limit(0), SF0001)
        assert empty.count() == 0 and empty.columns == docs.columns
    assert corpus_pipeline.pack_sequences(spark, docs, SF0001).count() >= len(EDGE_DOCS)
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), SF0001).count() == 0
