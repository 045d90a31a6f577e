"""Spark session helpers.

Cluster jobs get their configuration from the submitting environment; the
helpers here only fill in what is unset so that tests and the bench run the
same code on ``local[N]``.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "4g", app: str = "surgeflow") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    Only when it is unset (plain local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="surgeflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df):
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    The table survives executor loss, and later plans prune its columns and push their
    filters into the scan.
    """
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"stage-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df, name: str, *counts):
    """``cut_lineage(df)`` and the observed aggregates ``counts`` of its rows, as a dict.

    They are taken by the tasks that write the table, so there is no second pass, and a task
    that is run again for a lost executor counts once.
    """
    from pyspark.sql import Observation

    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    written = cut_lineage(df.observe(seen, *counts))
    return written, seen.get


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
