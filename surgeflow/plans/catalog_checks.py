"""Queries whose input holds rows on both sides of the rule under test.

Bad numbers, bad dates, nulls, unmatched states and non-ASCII text are derived from the given
tables; each query has a DuckDB twin that states the rule in its own words.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import LabelConfig
from ..functions import calendar as CAL
from ..functions import semantics as S
from ..operators import attribution as XP
from ..operators import models as ML
from ..operators import stats as ST
from ..operators.clean_labels import coverage_expr
from ..sources import fixtures as fx
from . import oracle_sql as O
from .catalog import R, register
from .stages import finish, panel, samples
from .stages import labels as stage_labels

# ------------------------------------------------------------------ coercion, nulls, text

O.CTE["x_numbers"] = """
SELECT CASE l_linenumber WHEN 1 THEN '1d' WHEN 2 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' '
  WHEN 3 THEN 'n/a' WHEN 4 THEN NULL WHEN 5 THEN '1,' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
  WHEN 6 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'e-1'
  ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5' END AS value_text FROM lineitem"""


@register("sc_cast_num_coerce", O.sql(
    "SELECT value_text, " + R("CASE WHEN regexp_full_match(trim(value_text), '[+-]?[0-9]+([.][0-9]*)?(e-?[0-9]+)?') "
                              "THEN CAST(trim(value_text) AS DOUBLE) END", "value_num")
    + ", count(*) AS n FROM x_numbers GROUP BY value_text"))
def q_num(spark, sf_dir):
    q, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    text = (F.when(line == 1, "1d").when(line == 2, F.concat(F.lit(" "), q, F.lit(" "))).when(line == 3, "n/a")
            .when(line == 4, F.lit(None).cast("string")).when(line == 5, F.concat(F.lit("1,"), q))
            .when(line == 6, F.concat(F.lit("-"), q, F.lit("e-1"))).otherwise(F.concat(q, F.lit(".5"))))
    rows = fx.read(spark, sf_dir, "lineitem").select(text.alias("value_text"))
    return finish(rows.groupBy("value_text").agg(F.count(F.lit(1)).alias("n")).select(
        "value_text", S.coerce_double("value_text").alias("value_num"), "n"))


O.CTE["x_dates"] = """
SELECT CASE l_linenumber % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
  WHEN 2 THEN strftime(l_shipdate, '%Y-02-30') END AS date_text FROM lineitem"""


@register("sc_cast_date_coerce", O.sql(
    "SELECT date_text, TRY_CAST(date_text AS DATE) AS date_value, count(*) AS n FROM x_dates GROUP BY date_text"))
def q_date(spark, sf_dir):
    kind = F.col("l_linenumber") % 4
    text = (F.when(kind == 0, "unknown").when(kind == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
            .when(kind == 2, F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("-02-30"))))
    rows = fx.read(spark, sf_dir, "lineitem").select(text.alias("date_text"))
    return rows.groupBy("date_text").agg(F.count(F.lit(1)).alias("n")).select(
        "date_text", S.coerce_date("date_text").alias("date_value"), "n")


@register("fl_drop_null_key", O.sql(
    "SELECT lang, count(*) AS n_rows, count(quality) AS n_kept FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang"))
def q_drop_null(spark, sf_dir):
    """Documents whose label is missing are dropped; counted per language in one pass."""
    rows = fx.read(spark, sf_dir, "documents").select("doc_id", "lang").join(
        fx.read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    kept = S.nan_to_null(F.col("quality").cast("double")).isNotNull()
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(kept).alias("n_kept"))


LATIN1_OUT = r"[^\x20-\x21\x23-\x5B\x5D-\x7E¡-ÿ]"


@register("io_read_csv_latin1", O.sql(
    "SELECT doc_id, md5(line) AS line_md5, length(line) AS n_chars FROM (SELECT doc_id, trim(regexp_replace("
    r"coalesce(text, ''), '[^\x20-\x21\x23-\x5B\x5D-\x7E\x{00A1}-\x{00FF}]', ' ', 'g')) AS line FROM documents)"))
def q_csv_latin1(spark, sf_dir):
    """Whole texts with their accented letters, written and read as ISO-8859-1."""
    from ..sources import io as IO
    from .catalog_ids import _export_dir
    path = _export_dir(spark, "latin1")
    line = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), LATIN1_OUT, " "))
    fx.read(spark, sf_dir, "documents").select("doc_id", line.alias("line")).write.option("header", True).option(
        "encoding", "ISO-8859-1").csv(path)
    back = F.coalesce("line", F.lit(""))
    return IO.read_csv_latin1(spark, path).select(F.col("doc_id").cast("long"), F.md5(back.cast("binary")).alias("line_md5"),
                                                  F.char_length(back).cast("long").alias("n_chars"))


# ------------------------------------------------------------------ regions

#: State codes in alphabetical order, and one code that the dictionary lacks.
STATES = sorted(CAL.US_REGION) + ["pr"]
O.CTE["x_regions"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{r}')" for s, r in sorted(CAL.US_REGION.items())) + ") AS t(state, region)"
O.CTE["x_states"] = ("SELECT list_extract([" + ", ".join(f"'{s}'" for s in STATES)
                     + f"], CAST(c_custkey % {len(STATES)} + 1 AS INTEGER)) AS state FROM customer")


def _states(spark, sf_dir):
    codes = F.array(*[F.lit(s) for s in STATES])
    return fx.read(spark, sf_dir, "customer").select(
        F.upper(F.get(codes, (F.col("c_custkey") % len(STATES)).cast("int"))).alias("state_territory"))


@register("sc_region_map", O.sql(
    "SELECT state AS state_territory, coalesce(region, 'territory') AS region, count(*) AS n "
    "FROM x_states LEFT JOIN x_regions USING (state) GROUP BY 1, 2"))
def q_region(spark, sf_dir):
    d = CAL.add_region(_states(spark, sf_dir))
    return d.groupBy(F.lower("state_territory").alias("state_territory"), "region").agg(F.count(F.lit(1)).alias("n"))


@register("jn_lookup_region", O.sql(
    "SELECT coalesce(region, 'territory') AS region, count(*) AS n, count(region) AS matched "
    "FROM x_states LEFT JOIN x_regions USING (state) GROUP BY 1"))
def q_lookup(spark, sf_dir):
    d = CAL.add_region(_states(spark, sf_dir))
    return d.groupBy("region").agg(F.count(F.lit(1)).alias("n"),
                                   F.count_if(F.col("region") != CAL.DEFAULT_REGION).alias("matched"))


# ------------------------------------------------------------------ order, rounding, guards

@register("so_panel_sort", O.sql(
    "SELECT state_territory, week_end, " + R("admits", "admits") + ", row_number() OVER "
    "(ORDER BY state_territory, week_end) AS position FROM h_labels"))
def q_panel_sort(spark, sf_dir):
    """Labels in (state, week) order; the position is the row's place in the written table.

    The place is carried by a sort: rows before a state plus the place inside it."""
    labels = stage_labels(spark, sf_dir)[0].select("state_territory", "week_end", "admits")
    before = Window.orderBy("state_territory").rowsBetween(Window.unboundedPreceding, -1)
    # one row per state
    starts = labels.groupBy("state_territory").agg(F.count(F.lit(1)).alias("k")).select(
        "state_territory", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("state_territory").orderBy("week_end")
    return finish(labels.withColumn("place", F.row_number().over(inside)).join(starts, "state_territory").select(
        "state_territory", "week_end", "admits", (F.col("start") + F.col("place")).alias("position"))
        .orderBy("state_territory", "week_end"))


@register("so_topk", O.sql("SELECT site, count(*) AS n FROM s_raw GROUP BY site ORDER BY n DESC, site LIMIT 10"))
def q_topk(spark, sf_dir):
    """The ten sites with the most samples (TakeOrdered: ten rows per task)."""
    counts = fx.samples_raw(spark, sf_dir, dealt=False).groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "site").limit(10)


@register("sc_round6", O.sql(
    "SELECT state_territory, week_end, round(pct_nondetect / 3.0, 6) AS third FROM s_weekly_all"))
def q_round6(spark, sf_dir):
    return samples(spark, sf_dir).weekly_all.select("state_territory", "week_end",
                                                    S.round6(F.col("pct_nondetect") / 3.0).alias("third"))


@register("sc_coverage_fallback", O.sql(
    "SELECT n_name AS jurisdiction, " + R("CASE WHEN n_nationkey % 5 <> 0 THEN reported / total END", "coverage")
    + " FROM (SELECT n_nationkey, n_name, CAST(count(*) FILTER (WHERE o_orderstatus <> 'P') AS DOUBLE) AS reported, "
      "count(*) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
      "GROUP BY n_nationkey, n_name)"))
def q_coverage_ratio(spark, sf_dir):
    """No percent column: reported / total, null where the total is zero."""
    cfg = LabelConfig()
    o = fx.read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    c = fx.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = fx.read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey").agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("reported"), F.count(F.lit(1)).alias("total"))
    # every fifth nation reports a total of zero
    rows = rows.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("jurisdiction"), F.col("reported").alias(cfg.coverage_num_col),
        F.when(F.col("n_nationkey") % 5 == 0, 0).otherwise(F.col("total")).alias(cfg.coverage_den_col))
    return finish(rows.select("jurisdiction", coverage_expr(rows, cfg).alias("coverage")))


O.CTE["x_pairs"] = """
SELECT o_totalprice AS y, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN o_totalprice END AS one_pair,
  CAST(NULL AS DOUBLE) AS no_pair, CAST(o_custkey AS DOUBLE) AS all_pairs FROM orders"""


@register("fl_min_rows_guard", O.sql("\nUNION ALL ".join(
    f"SELECT '{c}' AS predictor, count({c}) AS n, " + R(f"CASE WHEN count({c}) >= 2 THEN corr(y, {c}) END", "r")
    + " FROM x_pairs" for c in ("one_pair", "no_pair", "all_pairs"))))
def q_min_rows(spark, sf_dir):
    """Statistics need two complete pairs; columns with one and with none give nulls."""
    o = fx.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("y"))
    least = o.agg(F.min("o_orderkey").alias("least"))
    d = o.crossJoin(F.broadcast(least)).select(  # one row
        "y", F.when(F.col("o_orderkey") == F.col("least"), F.col("y")).alias("one_pair"),
        F.lit(None).cast("double").alias("no_pair"), F.col("o_custkey").cast("double").alias("all_pairs"))
    return finish(ST.linear_fits(d, ["one_pair", "no_pair", "all_pairs"], "y").select("predictor", "n", "r"))


# ------------------------------------------------------------------ scores that SQL can repeat

O.CTE["x_scored"] = """
SELECT doc_id, quality AS label, n_chars / (n_chars + 1000.0) AS p, CAST(n_chars >= 1000 AS INTEGER) AS pred
FROM labels JOIN documents USING (doc_id)"""


def _scored(spark, sf_dir):
    s = fx.scores(spark, sf_dir)
    p = F.col("score") / (F.col("score") + 1000.0)
    return s.select("doc_id", "label", p.alias("p"), (F.col("score") >= 1000).cast("int").alias("pred"))


@register("ml_strength_bucket", O.sql(
    "SELECT CASE WHEN c >= 0.75 THEN 'High' WHEN c >= 0.5 THEN 'Moderate' ELSE 'Low' END AS strength, count(*) AS n "
    "FROM (SELECT CASE WHEN pred = 1 THEN p ELSE 0.9 - p END AS c FROM x_scored) GROUP BY 1"))
def q_strength(spark, sf_dir):
    d = _scored(spark, sf_dir).select(
        F.when(F.col("pred") == 1, F.col("p")).otherwise(0.9 - F.col("p")).alias("confidence"))
    return d.groupBy(ML.strength().alias("strength")).agg(F.count(F.lit(1)).alias("n"))


@register("so_first_match", O.sql(
    "SELECT CASE WHEN pred = 1 THEN 'true_positive' ELSE 'false_negative' END AS outcome, min(doc_id) AS doc_id, "
    + R("arg_min(p, doc_id)", "p") + " FROM x_scored WHERE label = 1 GROUP BY 1"))
def q_first_match(spark, sf_dir):
    """First true positive and first false negative by id."""
    d = _scored(spark, sf_dir).where("label = 1").withColumn(
        "outcome", F.when(F.col("pred") == 1, "true_positive").otherwise("false_negative"))
    return finish(d.groupBy("outcome").agg(F.min("doc_id").alias("doc_id"), F.min_by("p", "doc_id").alias("p")))


#: Coefficients of a fixed linear score over panel columns.
LINEAR = {"log10_conc_mean": 0.8, "admits": 0.05, "coverage": -1.5}
O.CTE["x_linear"] = "\nUNION ALL ".join(
    f"SELECT state_territory, week_end, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"{b} * (CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) AS contribution FROM p_era" for c, b in LINEAR.items())


def _linear(spark, sf_dir):
    d = panel(spark, sf_dir).era.select("state_territory", "week_end",
                                        *[F.col(c).cast("double").alias(c) for c in LINEAR])
    means = d.agg(*[F.avg(c).alias(c) for c in LINEAR]).first().asDict()  # one row
    means = {c: m or 0.0 for c, m in means.items()}
    return d, XP.to_long(XP.linear_contributions(d, list(LINEAR.values()), list(LINEAR), means))


@register("xp_mean_abs_rank", O.sql(
    "SELECT feature, " + R("m", "mean_abs_contribution") + ", CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) "
    "AS rank FROM (SELECT feature, avg(abs(contribution)) AS m FROM x_linear GROUP BY feature)"))
def q_mean_abs(spark, sf_dir):
    return finish(XP.mean_abs_rank(_linear(spark, sf_dir)[1]))


@register("xp_dependence", O.sql(
    "SELECT state_territory, week_end, feature, " + R("contribution", "contribution") + ", " + R("value", "value")
    + " FROM x_linear"))
def q_dependence(spark, sf_dir):
    d, long = _linear(spark, sf_dir)
    values = d.unpivot(["state_territory", "week_end"], list(LINEAR), "feature", "value")
    return finish(long.join(values, ["state_territory", "week_end", "feature"]))
