"""Sinks and the metrics-file source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned (e.g. by split) with rows clustered inside files."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with header (data dictionary, importance table).  ``single_file`` only for small,
    bounded tables (one row per column/feature)."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines of (possibly nested) rows, e.g. tidy metrics with a confusion matrix."""
    df.write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str, key: Sequence[str] = ("target",), arrays: bool = False) -> DataFrame:
    """Read all metrics under ``path`` and merge by key: for each key the rows of the latest run win.

    A run is a folder that ``write_json`` wrote (JSON lines, any number of part files); the latest has the
    greatest folder name.  With ``arrays`` every file holds one JSON array and is a run of its own."""
    name = r"([^/]+)$" if arrays else r"([^/]+)/[^/]+$"
    df = (spark.read.option("multiLine", arrays).option("recursiveFileLookup", True).json(path)
          .withColumn("__run", F.regexp_extract(F.col("_metadata.file_path"), name, 1)))
    latest = df.groupBy(*key).agg(F.max("__run").alias("__run"))   # one row per key: joined by size, not by hint
    same = [df[k].eqNullSafe(latest[k]) for k in (*key, "__run")]
    for c in same[1:]:
        same[0] = same[0] & c
    return df.join(latest, same[0], "left_semi").drop("__run")
