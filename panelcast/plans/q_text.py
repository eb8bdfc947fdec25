"""Text-source queries over data derived from the tables: Spark writes a panel as text in the shared
checkpoint folder, in the layouts of the index files (all series in the same files, named by the first token of
a line, or one folder per series), and the readers parse it back.  Exercises S1-S7 and S10 on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.plans import oracle as O
from panelcast.plans.catalog import register
from panelcast.session import checkpoint_dir
from panelcast.sources import tables, text

MONTHS = text.MONTH_COLS


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/text-{name}-{uuid.uuid4().hex}"


def _write_table(lines: DataFrame, path: str, ordered: bool = False) -> None:
    """lines: (series, ln, line) -> text files that hold all series, each line after the name of its series.  Where their order
    says something, they are sorted by ranges of (series, ln): a long series is spread over several tasks and files."""
    if ordered:
        lines = lines.orderBy("series", "ln")
    lines.select(F.concat_ws(" ", "series", "line").alias("value")).write.text(path)


def _write_lines(lines: DataFrame, path: str) -> None:
    """lines: (series, ln, line) -> a folder per series; every task writes the lines it has."""
    lines.select("series", "line").write.partitionBy("series").text(path)


def _fixed_lines(pb: DataFrame) -> DataFrame:
    series = F.col("supplier").cast("string").alias("series")
    data = pb.select(series, (F.year("period") * 100 + F.month("period")).cast("long").alias("ln"),
                     F.format_string(" %4d %3d %10.2f %8d", F.year("period"), F.month("period"), F.col("qty"),
                                     F.col("n_lines")).alias("line"))
    keys = pb.select(series).distinct()
    head = keys.select("series", F.lit(0).cast("long").alias("ln"), F.lit(" YR  MON        QTY    LINES").alias("line"))
    blank = keys.select("series", F.lit(1).cast("long").alias("ln"), F.lit("").alias("line"))
    tail = keys.select("series", F.lit(10 ** 9).cast("long").alias("ln"), F.lit(" 9999  99    -999.90     -999").alias("line"))
    return head.unionByName(blank).unionByName(data).unionByName(tail)


@register("s1_fixed_text", sql=O.with_(O.PANEL_B) + """SELECT CAST(supplier AS VARCHAR) AS series, period, qty,
  CAST(n_lines AS DOUBLE) AS n_lines FROM panel_b""")
def s1_fixed_text(spark, sf):
    path = _scratch(spark, "fixed")
    _write_table(_fixed_lines(tables.panel_b(spark, sf)), path)
    return text.read_fixed(spark, path, columns=("qty", "n_lines"), series_from="column")


def _wide_lines(pb: DataFrame) -> DataFrame:
    """Year rows ``YYYY v v …`` with missing months as -999.9 glued to the previous token
    (the run-together layout), a 9999 row, then a second table that must be ignored."""
    series = F.col("supplier").cast("string").alias("series")
    wide = pb.groupBy(series, F.year("period").alias("year")).agg(
        *[F.max(F.when(F.month("period") == i + 1, F.col("qty"))).alias(m) for i, m in enumerate(MONTHS)])
    toks = [F.when(F.col(m).isNull(), F.lit("-999.9")).otherwise(F.format_string(" %.1f", F.col(m))) for m in MONTHS]
    data = wide.select("series", (F.col("year") + 10).cast("long").alias("ln"),
                       F.concat(F.format_string("%4d", F.col("year")), *toks).alias("line"))
    keys = wide.select("series").distinct()

    def const(ln, s):
        return keys.select("series", F.lit(ln).cast("long").alias("ln"), F.lit(s).alias("line"))
    header = "YEAR " + " ".join(m.upper() for m in MONTHS)
    parts = [const(0, "          STANDARDIZED DATA"), const(1, header), data,
             const(10 ** 6, "9999" + " -999.9" * 12), const(10 ** 6 + 1, ""), const(10 ** 6 + 2, "          ANOMALY"),
             const(10 ** 6 + 3, header), const(10 ** 6 + 4, "1990" + " 9.9" * 12)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("s3_wide_text", sql=O.with_(O.PANEL_B, """years AS (SELECT DISTINCT supplier, year(period) AS y,
  unnest(range(1, 13)) AS m FROM panel_b)""") + """SELECT CAST(y.supplier AS VARCHAR) AS series,
  CAST(make_date(y.y, y.m, 1) AS DATE) AS period, p.qty AS zwnd
FROM years y LEFT JOIN panel_b p ON p.supplier = y.supplier AND p.period = make_date(y.y, y.m, 1)""")
def s3_wide_text(spark, sf):
    path = _scratch(spark, "wide")
    _write_table(_wide_lines(tables.panel_b(spark, sf)), path, ordered=True)
    return text.read_wide_months(spark, path, value_name="zwnd", series_from="column")


def _daily_lines(ev: DataFrame) -> DataFrame:
    series = F.col("event_type").alias("series")
    day = F.to_date("ts")
    data = ev.select(series, (F.col("event_id") + 10).cast("long").alias("ln"), F.format_string(
        "%d %d %d %.6f %.6f %d %.6f Final", F.year(day), F.month(day), F.dayofmonth(day), F.col("value") / 100.0,
        -F.col("value") / 100.0, (F.col("user_id") % 8 + 1).cast("int"), F.col("value") / 25.0).alias("line"))
    keys = ev.select(series).distinct()
    h1 = keys.select("series", F.lit(0).cast("long").alias("ln"), F.lit("RMM values, missing = 999").alias("line"))
    h2 = keys.select("series", F.lit(1).cast("long").alias("ln"), F.lit("year month day RMM1 RMM2 phase amplitude source").alias("line"))
    return h1.unionByName(h2).unionByName(data)


@register("s7_daily_text", sql="""SELECT event_type AS series, CAST(date_trunc('month', ts) AS DATE) AS period,
  avg(value / 100.0) AS rmm1, avg(-value / 100.0) AS rmm2, avg(value / 25.0) AS mjo_amplitude,
  avg(CASE WHEN value / 25.0 >= 1.0 THEN sin(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END) AS mjo_sin,
  avg(CASE WHEN value / 25.0 >= 1.0 THEN cos(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END) AS mjo_cos
FROM events GROUP BY 1, 2""", r6=["rmm1", "rmm2", "mjo_amplitude", "mjo_sin", "mjo_cos"])
def s7_daily_text(spark, sf):
    path = _scratch(spark, "daily")
    _write_lines(_daily_lines(tables.read_table(spark, sf, "events")), path)
    return text.read_daily(spark, path, amplitude_threshold=1.0, series_from="folder")
