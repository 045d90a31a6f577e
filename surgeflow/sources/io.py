"""Typed readers and writers at the edges of the pipeline.

Stage tables are Parquet; CSV appears only where data arrives or leaves.  The
helpers that inspect column names run at plan time and never touch rows.
"""
from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: Column that holds a record as it stood in the file when it does not fit the schema.
CORRUPT = "_corrupt_record"


def read_csv_projected(spark: SparkSession, path: str, columns: Sequence[str],
                       schema: StructType | str | None = None,
                       encoding: str = "UTF-8") -> DataFrame:
    """``read_csv(usecols=...)``: header CSV, all columns as text unless a schema is
    given, projected to ``columns`` (the CSV reader prunes unread columns)."""
    r = spark.read.option("header", True).option("encoding", encoding) \
        .option("mode", "PERMISSIVE").option("multiLine", False)
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    require_columns(df, columns)
    return df.select(*columns)


def read_csv_declared(spark: SparkSession, path: str, schema: StructType | str, columns: Sequence[str],
                      date_format: str = "yyyy-MM-dd", header: bool = True, encoding: str = "UTF-8",
                      corrupt: str = CORRUPT) -> DataFrame:
    """CSV of a declared schema in one pass: ``columns`` and ``corrupt``.

    A field that cannot be read as its type (bad dates and numbers too) is NULL, as are the fields
    that a short line lacks; fields beyond the schema are left out.  In all three cases ``corrupt``
    holds the line, else NULL.  An empty field is NULL and no fault, an empty line no record.  Header
    names that differ from the schema raise an error."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [c for c in columns if c not in declared.names]
    if missing:
        raise KeyError(f"Missing columns: {missing}")
    whole = StructType([*declared.fields, StructField(corrupt, StringType())])
    return spark.read.schema(whole).option("header", header).option("enforceSchema", False) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt) \
        .option("dateFormat", date_format).option("encoding", encoding).option("columnPruning", False) \
        .csv(path).select(*columns, corrupt)


def read_csv_dates(spark: SparkSession, path: str, schema: StructType | str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """``read_csv(parse_dates=[...])``: the schema's columns, its dates in ``date_format``;
    unparseable text -> NULL."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return read_csv_declared(spark, path, declared, declared.names, date_format).drop(CORRUPT)


def read_csv_latin1(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)


def pick_largest_file(spark: SparkSession, patterns: Sequence[str]) -> str:
    """Largest file matching any glob; listing only (no content), fails when none."""
    frames = []
    for p in patterns:
        try:
            frames.append(spark.read.format("binaryFile").load(p).select("path", "length"))
        except Exception:  # an unmatched glob raises at analysis time
            continue
    if not frames:
        raise FileNotFoundError(f"no file matches {list(patterns)}")
    allf = frames[0]
    for f in frames[1:]:
        allf = allf.unionByName(f)
    row = allf.agg(F.max_by("path", "length").alias("p")).first()
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no file matches {list(patterns)}")
    return row["p"]


def normalize_headers(df: DataFrame) -> DataFrame:
    """``columns = [c.strip().lower() ...]``."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    raise KeyError(f"none of {list(candidates)} found")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns: {missing}")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def save_feature_list(spark: SparkSession, names: Sequence[str], path: str) -> None:
    spark.createDataFrame([(i, n) for i, n in enumerate(names)], "ordinal int, feature string") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_feature_list(spark: SparkSession, path: str) -> list[str]:
    """Ordered feature names (a bounded, tiny table)."""
    return [r["feature"] for r in spark.read.parquet(path).orderBy("ordinal").collect()]


def save_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def profile_shape(df: DataFrame) -> DataFrame:
    """Column names, row and column counts (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("columns"))
