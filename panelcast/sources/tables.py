"""Parquet scans (S9) and the panels built from the test tables (fixtures PANEL_A..E).

Money is summed as DECIMAL(18,2) (exact, order-independent) and only then cast to DOUBLE.
Timestamps are truncated to their period as DATE (TIMESTAMP for hours).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.scalar import period_of

SCHEMAS = {
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str, explicit_schema: bool = True) -> DataFrame:
    """Parquet scan; errors if absent.  ``explicit_schema`` skips footer inference."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if not os.path.exists(path) and "://" not in path:
        raise FileNotFoundError(path)
    reader = spark.read
    if explicit_schema and name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)


def _money(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def panel_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PANEL_A: (nation, segment) x month of o_orderdate: revenue = sum(o_totalprice), n_orders."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
                      period_of("o_orderdate", "month").alias("period"))
            .agg(_money("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders")))


def panel_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PANEL_B: supplier x month of l_shipdate: qty = sum(l_quantity), n_lines."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    return (li.groupBy(F.col("l_suppkey").alias("supplier"), period_of("l_shipdate", "month").alias("period"))
            .agg(_money("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines")))


def orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_nationkey").alias("nation"), period_of("o_orderdate").alias("period"))
            .agg(_money("o_totalprice").alias("order_revenue"), F.count(F.lit(1)).alias("n_orders")))


def lineitems_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .groupBy(F.col("s_nationkey").alias("nation"), period_of("l_shipdate").alias("period"))
            .agg(_money("l_quantity").alias("ship_qty"), F.count(F.lit(1)).alias("n_lines")))


def panel_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PANEL_D: event_type x day: avg(value), n, and the daily mean of the cyclic phase inputs."""
    e = read_table(spark, sf_dir, "events").select("ts", "event_type", "value", "user_id")
    return (e.groupBy("event_type", period_of("ts", "day").alias("period"))
            .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n_events")))


def panel_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PANEL_E: user x hour: n_events, sum(value)."""
    e = read_table(spark, sf_dir, "events").select("ts", "user_id", "value")
    return (e.groupBy("user_id", period_of("ts", "hour").alias("period"))
            .agg(F.count(F.lit(1)).alias("n_events"), _money("value").alias("sum_value")))
