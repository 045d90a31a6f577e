"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, cuckoo, decontam, html_consensus, line_runs, ngram_join, packing, periodic, suffix_index,
               token_counts, toxicity, warc, whitening)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = cuckoo.exact_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op7_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)"""


@register
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.drop_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(read_table(spark, sf_dir, "documents"))
    return token_counts.context_report(histogram, [2**k for k in range(7, 21)], [0.05, 0.25, 0.5, 0.75, 0.95, 0.99])


@register
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE["op3_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(13, len(w)) AS size, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
       FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM bw),
s AS (SELECT DISTINCT size FROM g),
dw AS (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, s WHERE len(w) >= size),
m AS (SELECT dw.doc_id, g.item_id, dw.i, dw.size FROM dw
      JOIN g ON g.size = dw.size AND g.gram = array_to_string(dw.w[dw.i:dw.i + dw.size - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
      (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@register
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


@register
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_classes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "copies", "n_links")


@register
def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(warc.responses_from_pages(read_table(spark, sf_dir, "pages")), ("page_id",))
    return made.select("page_id", "record_type", "record_id", "refers_to", "block_digest", "source_block_digest",
                       "source_payload_digest", "n_bytes", F.sha2(warc.record_text(F.col("header"), F.col("block")), 256)
                       .alias("record_sha256"), "header", "block")


@register
def op8_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(read_table(spark, sf_dir, "conversations")).select(
        "conv_id", "chunk", "n_turns", "first_turn", F.sha2("text", 256).alias("text_sha256"))


ORACLE["op8_chat_snapshots"] = r"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list([role, text] ORDER BY pos) AS all_turns FROM p GROUP BY conv_id),
pre AS (SELECT DISTINCT k AS n, all_turns[1:k] AS turns FROM (SELECT n, all_turns, unnest(generate_series(1, n - 1)) AS k
        FROM c)),
m AS (SELECT min(conv_id) AS conv_id FROM c WHERE NOT EXISTS (SELECT 1 FROM pre WHERE pre.n = c.n
      AND pre.turns = c.all_turns) GROUP BY all_turns)
SELECT p.conv_id, (pos - 1) // 256 AS chunk, any_value(c.n) AS n_turns, min(pos) AS first_turn,
       sha256(string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY pos))
         AS text_sha256
FROM p JOIN m USING (conv_id) JOIN c USING (conv_id) GROUP BY p.conv_id, (pos - 1) // 256"""


@register
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.remove_repeats(read_table(spark, sf_dir, "documents"))
    # bytes of a character that is kept in part show as the replacement sign; the hash is of the bytes
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@register
def op11_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.main_text(read_table(spark, sf_dir, "pages"))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_period(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("best", periodic.best_run(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
                        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "collapsed")


@register
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read_table(spark, sf_dir, "embeddings"))
