"""Stage builders shared by the registered queries.

A stage is a written table.  It is reused by later queries of the same session as long as the
files of the folder it was built from are the same (names, sizes and modification times).
"""
from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..config import DRIVER_SAMPLES, LabelConfig, PanelConfig
from ..operators import clean_labels as CL
from ..operators import clean_samples as CS
from ..operators import matrix as MX
from ..operators import panel as P
from ..session import cut_lineage, table_path, write_observed
from ..sources import fixtures as fx

_CACHE: dict = {}


@dataclass
class Panel:
    samples: CS.SampleStages
    labels_raw: DataFrame
    labels: DataFrame
    joined: DataFrame
    features: DataFrame
    ready: DataFrame
    era: DataFrame
    label_rows: int
    counts: dict


#: Tables that the stages read.
SAMPLE_TABLES, LABEL_TABLES = ("lineitem", "supplier", "nation"), ("orders", "customer", "nation")


def _files(spark: SparkSession, sf_dir: str, tables: tuple) -> tuple:
    """Count, bytes and last change of the tables' files, from a listing without contents."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").load([table_path(sf_dir, t) for t in tables])
    return tuple(listed.agg(F.count("path"), F.sum("length"), F.max("modificationTime").cast("string")).first())


def _key(spark: SparkSession, name: str, sf_dir: str, tables: tuple, *parts):
    """Stages are kept per application and per state of the files of their tables."""
    return (spark.sparkContext.applicationId, id(spark), name, sf_dir, _files(spark, sf_dir, tables)) + parts


def samples(spark: SparkSession, sf_dir: str, min_sites: int = 2) -> CS.SampleStages:
    k = _key(spark, "samples", sf_dir, SAMPLE_TABLES, min_sites)
    if k not in _CACHE:
        cfg = replace(DRIVER_SAMPLES, min_sites=min_sites)
        st = CS.clean_samples(fx.samples_raw(spark, sf_dir, dealt=False), cfg, fx.samples_raw(spark, sf_dir))
        # stage hand-over: the aggregated weekly table is small; write it once
        st.weekly_counts = CS.write_weekly(st, min_sites)
        _CACHE[k] = st
    return _CACHE[k]


def labels(spark: SparkSession, sf_dir: str, lcfg: LabelConfig = LabelConfig()) -> tuple[DataFrame, int]:
    """The written labels and their number; no sample stage is needed for them."""
    k = _key(spark, "labels", sf_dir, LABEL_TABLES, lcfg)
    if k not in _CACHE:
        made = CL.clean_labels(fx.hospital_raw(spark, sf_dir), lcfg)
        written, seen = write_observed(made, "labels", F.count(F.lit(1)).alias("rows"))
        _CACHE[k] = written, int(seen.get("rows") or 0)
    return _CACHE[k]


def matched_panel(weekly: DataFrame, labels: DataFrame, pcfg: PanelConfig) -> tuple[DataFrame, DataFrame, dict]:
    """The joined panel, its written features and their observed counts; a join without any
    match raises."""
    joined = P.join_state_week(weekly, labels, pcfg)
    feats, counts = P.write_panel(P.build_features(joined, pcfg))
    return joined, feats, counts


def panel(spark: SparkSession, sf_dir: str, min_sites: int = 2,
          lcfg: LabelConfig = LabelConfig(), pcfg: PanelConfig = PanelConfig()) -> Panel:
    k = _key(spark, "panel", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2], min_sites, lcfg, pcfg)
    if k not in _CACHE:
        st = samples(spark, sf_dir, min_sites)
        known, label_rows = labels(spark, sf_dir, lcfg)
        joined, feats, counts = matched_panel(st.weekly, known, pcfg)
        ready = P.model_ready(feats)
        era = cut_lineage(P.era_split(ready, pcfg))
        _CACHE[k] = Panel(st, fx.hospital_raw(spark, sf_dir), known, joined, feats, ready, era, label_rows, counts)
    return _CACHE[k]


def era_matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = _key(spark, "matrix", sf_dir, SAMPLE_TABLES + LABEL_TABLES[:2])
    if k not in _CACHE:
        _CACHE[k] = MX.build_matrix(panel(spark, sf_dir).era)
    return _CACHE[k]


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (and fold -0.0) for stable cross-engine hashing."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
