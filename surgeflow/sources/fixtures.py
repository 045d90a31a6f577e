"""Adapters that present the driver's tables in the shapes the operators read.

Each adapter is a lazy projection / join of the parquet tables, so Catalyst
prunes columns and pushes filters into the scans.  The DuckDB twins of these
expressions live in ``plans.oracle`` and must stay in step with this file.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import week_end_saturday
from ..session import table_path

# Ordinal that fixes the "first" row of a duplicate group (T1); unique in the data.
RECORD_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_shipdate")

#: Sample rows of one task that sorts them.
ROWS_PER_TASK = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def in_tasks(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over the session's shuffle partitions, or over tasks of
    ``ROWS_PER_TASK`` rows where these would hold more.  The rows of a stored table are counted
    from its footers."""
    tasks = -(-df.count() // ROWS_PER_TASK)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(tasks, *keys)


def samples_raw(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Site-day samples: lineitem x supplier x nation (FIXTURES.md section 3).

    ``dealt`` rows are for a reader that sorts them; one that only counts or filters takes them
    as they lie, without a shuffle of the table."""
    li = read(spark, sf_dir, "lineitem")
    if dealt:
        # the tasks sort a site's rows for the first of each duplicate group, so their number
        # follows the table; the table's own rows are narrower than the samples made of them
        li = in_tasks(li, "l_suppkey")
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nat = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has a fixed 25 rows; supplier grows with the data. It meets the samples by itself, so
    # the size of its own file decides whether it is broadcast; joined to nation first, its size
    # would be taken for the product of both and the samples would be shuffled.
    j = li.join(sup, li.l_suppkey == sup.s_suppkey) \
        .join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)
    rf = F.col("l_returnflag")
    units = (F.when(rf == "R", F.lit(" Log10 copies/L wastewater"))
             .when(rf == "A", F.lit("copies/L wastewater "))
             .when(F.col("l_discount") > 0.08, F.lit("copies/g dry sludge"))
             .otherwise(F.lit("copies/l wastewater")))
    conc = (F.when(rf == "R", F.log10("l_extendedprice"))
            .when(F.col("l_discount") == 0, F.lit(0.0))
            .otherwise(F.col("l_extendedprice")))
    matrix = (F.when(F.col("l_linestatus") == "O", F.lit("raw wastewater"))
              .when(F.col("l_tax") < 0.02, F.lit("sludge"))
              .otherwise(F.lit("post grit removal")))
    ln = F.col("l_linenumber")
    pcr = (F.when(ln.isin(1, 3), F.lit("qpcr")).when(ln.isin(2, 4), F.lit(" ddPCR"))
           .when(ln == 5, F.lit("dpcr")).when(ln == 6, F.lit("rt-qpcr")).otherwise(F.lit("lamp")))
    return j.select(
        F.struct(*RECORD_KEY).alias("record_key"),
        F.xxhash64(*RECORD_KEY).alias("record_id"),
        F.col("l_suppkey").alias("site"),
        F.lower(F.col("n_name")).alias("state_territory"),
        F.col("l_shipdate").cast("date").alias("sample_collect_date"),
        matrix.alias("sample_matrix"),
        rf.alias("pcr_gene_target_agg"),
        conc.alias("pcr_target_avg_conc"),
        units.alias("pcr_target_units"),
        F.when(F.col("l_quantity") >= 5, F.col("l_quantity")).alias("lod_sewage"),
        F.col("s_acctbal").cast("bigint").alias("population_served"),
        F.col("l_extendedprice").alias("flow_rate"),
        pcr.alias("pcr_type"),
        F.lower(F.concat_ws("-", rf, F.col("l_linestatus"))).alias("concentration_method"),
    )


def hospital_raw(spark: SparkSession, sf_dir: str, with_rollups: bool = True) -> DataFrame:
    """Jurisdiction-week admissions: orders x customer x nation, plus roll-up rows.

    One scan + one aggregate with grouping sets produces the nation rows, the
    'Region k' roll-ups and the 'USA' total (the rows the cleaner must remove).
    """
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    j = (o.join(cn, o.o_custkey == cn.c_custkey)
         .select("n_name", "n_regionkey",
                 week_end_saturday("o_orderdate").alias("wk"),
                 (F.col("o_orderstatus") != "P").cast("int").alias("reported")))
    aggs = [F.count(F.lit(1)).alias("admits"), F.avg("reported").alias("share")]
    if with_rollups:
        g = j.groupingSets([["n_name", "wk"], ["n_regionkey", "wk"], ["wk"]],
                           "n_name", "n_regionkey", "wk").agg(*aggs)
        juris = (F.when(F.col("n_name").isNotNull(), F.col("n_name"))
                 .when(F.col("n_regionkey").isNotNull(),
                       F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")))
                 .otherwise(F.lit("USA")))
    else:
        g = j.groupBy("n_name", "wk").agg(*aggs)
        juris = F.col("n_name")
    return g.select(
        juris.alias("jurisdiction"),
        F.date_format("wk", "yyyy-MM-dd").alias("weekendingdate"),
        F.col("admits").cast("double").alias("totalconfc19newadm"),
        (F.col("share") * 100.0).alias("totalconfc19newadmperchosprep"),
    )


def county_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County reference list: one padded code per customer key bucket, by state."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(F.upper(F.col("n_name")).alias("state_id"),
                    (F.col("c_custkey") % 40).cast("string").alias("county_fips")))


def site_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rows carrying a comma list of county codes (with blanks, trailing commas)."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    codes = (F.when(F.col("c_custkey") % 3 == 0,
                    F.concat_ws(",", F.col("c_nationkey").cast("string"),
                                (F.col("c_custkey") % 40).cast("string")))
             .when(F.col("c_custkey") % 3 == 1,
                   F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(", "),
                            ((F.col("c_custkey") + 7) % 40).cast("string")))
             .otherwise(F.concat((F.col("c_custkey") % 40).cast("string"), F.lit(","))))
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(F.lower(F.col("n_name")).alias("state_territory"),
                    F.col("c_custkey").alias("site"), codes.alias("county_fips")))


def rucc_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long attribute table (FIPS, State, Attribute, Value) from ``part``."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = p.join(F.broadcast(n), (p.p_partkey % 25) == n.n_nationkey).select(
        (F.col("p_partkey") % 60).cast("string").alias("FIPS"),
        F.col("n_name").alias("State"),
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"))
    return base.unpivot(["FIPS", "State"], ["p_size", "p_retailprice"], "Attribute", "Value") \
        .withColumn("Attribute", F.when(F.col("Attribute") == "p_size", F.lit("RUCC_2023"))
                    .otherwise(F.lit("PRICE")))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary label + score: labels.quality vs documents.n_chars."""
    lab = read(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"))
