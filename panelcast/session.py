"""Spark session helpers.

The cluster decides ``spark.checkpoint.dir`` (a shared folder).  We only read it;
a local default is set only when the session has none (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints written by materialize() are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "panelcast", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names (``spark.checkpoint.dir`` or one set
    on the SparkContext); create a local one only when neither is set (tests, laptops)."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or (current.get() if current.isDefined() else None)
    if not d and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not current.isDefined():
        sc.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut lineage where a plan fans out into several branches: the (small, aggregated) panel is
    written once to the shared checkpoint folder and every branch reads it, instead of each
    branch re-reading and re-aggregating the raw facts.  Survives executor loss (files, not
    executor memory)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
