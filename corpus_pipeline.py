"""The corpus pipeline: documents pass through the stages in order.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and returns a DataFrame;
each result is written as Parquet and read again as the next stage's docs.  All but the last keep the columns
of ``documents``; the last says how many words the mix takes of every document.  Line dedup leaves copies of one earlier document
whole, so that near-dedup, which follows, finds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontam, line_dedup, mixing, near_dedup, toxicity
from panelcast.llm.common import scratch


STAGES = [
    ("toxicity", toxicity.stage),
    ("line dedup", line_dedup.stage),
    ("near dedup", near_dedup.stage),
    ("decontamination", decontam.stage),
    ("mixing", mixing.stage),
]

#: The learned scores and the minimum hashes of the first and third stage are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents`` of ``sf_dir``.  An empty table gives no rows."""
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
