"""Text index files as distributed scans.

A directory of station files is read with ``spark.read.text``; the file path (from the
``_metadata`` column), its folder or the first token of every line (``series_from``) names the
series.  All layouts are split line by line, so a file may be large and hold many series.  Where the
wide year x month layout needs line order (to stop at the second table), the order is that of
file, block start and place in the block, and the cut comes from a summary by block: no line moves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import cyclic_cos, cyclic_sin, make_month
from panelcast.operators.panel import merge_sources

# Fixed values of the source formats.
MONTH_COLS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
FIXED_COLUMNS = ("nino12", "nino12_anom", "nino3", "nino3_anom", "nino4", "nino4_anom", "nino34", "nino34_anom")
WIDE_SENTINELS = (-999.9,)
DAILY_SENTINELS = (999.0,)


def _series_name(path: Column, series_from: str = "file") -> Column:
    """Series id from a file path: base name without extension, or the value of a
    ``key=value`` folder (``series_from="folder"``, as written by ``partitionBy``)."""
    if series_from == "folder":
        return F.regexp_extract(path, r"=([^/=]+)/[^/]*$", 1)
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def _lines(spark: SparkSession, path: str, series_from: str = "file") -> DataFrame:
    """``(series, ln, line)`` of every line; ``ln`` orders the lines of a series: file, block start, place in the block.
    With ``series_from="column"`` the first token of a line names its series and does not belong to the line."""
    value = F.col("value")
    series, line = ((F.regexp_extract(value, r"^\s*(\S+)", 1), F.regexp_replace(value, r"^\s*\S+\s?", ""))
                    if series_from == "column" else (_series_name(F.col("_metadata.file_path"), series_from), value))
    # ids rise within a task, and a task reads each of its blocks from first to last line
    ln = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("at"))
    return spark.read.text(path).select(series.alias("series"), ln.alias("ln"), line.alias("line"))


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def year_line(line: Column, year_range: tuple[int, int] = (1900, 2099)) -> Column:
    """First token is exactly 4 digits and a plausible year (drops headers and 9999 rows)."""
    tok = F.regexp_extract(line, r"^\s*(\S+)", 1)
    y = F.when(tok.rlike(r"^[0-9]{4}$"), tok.cast("int"))
    return F.coalesce(y.between(year_range[0], year_range[1]), F.lit(False))


def _num(tok: Column) -> Column:
    v = tok.try_cast("double")
    return F.when(~F.isnan(v), v)


def replace_sentinels(df: DataFrame, cols: Iterable[str], sentinels: Sequence[float]) -> DataFrame:
    """Sentinel values -> NULL in the given numeric columns."""
    cols = set(cols)
    s = [F.lit(float(x)) for x in sentinels]
    return df.select(*[F.when(~F.col(c).isin(*s), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def read_fixed(spark: SparkSession, path: str, columns: Sequence[str] = FIXED_COLUMNS,
               sentinels: Sequence[float] = (), year_range=(1900, 2099), series_from: str = "file") -> DataFrame:
    """Lines ``YR MON c1 … ck`` -> ``(series, period, c1…ck)``; other lines dropped."""
    raw = _lines(spark, path, series_from)
    lines = raw.filter(year_line(F.col("line"), year_range)).select("series", _tokens(F.col("line")).alias("t"))
    out = lines.select(
        "series",
        make_month(F.get(F.col("t"), 0).try_cast("int"), F.get(F.col("t"), 1).try_cast("int")).alias("period"),
        *[_num(F.get(F.col("t"), i + 2)).alias(c) for i, c in enumerate(columns)])
    out = out.filter(F.col("period").isNotNull())
    return replace_sentinels(out, columns, sentinels) if sentinels else out


def first_table(lines: DataFrame, year_range=(1900, 2099)) -> DataFrame:
    """S3: per series, keep data lines before the first non-blank, non-digit line that follows data.

    ``lines`` (series, ln, line), ``ln`` as of ``_lines``.  One row for every block with data and for every non-digit
    line gives the cut of each series; the data lines meet only that table."""
    trimmed = F.trim(F.col("line"))
    marked = lines.select("*", year_line(F.col("line"), year_range).alias("__data"),
                          ((trimmed != "") & ~trimmed.rlike(r"^[0-9]")).alias("__break"))
    marks = (marked.filter("__data OR __break").select("series", "__data", "ln", "ln.file", "ln.block", F.when(F.col("__break"), F.col("ln.at")).alias("at"))
             .groupBy("series", "__data", "file", "block", "at").agg(F.min("ln").alias("ln")))
    firsts = marks.groupBy("series").agg(F.min(F.when(F.col("__data"), F.col("ln"))).alias("__first"))
    cut = (marks.filter("NOT __data").join(firsts, "series").filter(F.col("ln") > F.col("__first"))
           .groupBy("series").agg(F.min("ln").alias("__cut")))
    return (marked.filter("__data").join(cut, "series", "left")
            .filter(F.col("__cut").isNull() | (F.col("ln") < F.col("__cut")))
            .select("series", "ln", "line"))


def wide_to_long(df: DataFrame, ids: Sequence[str], value_name: str, year: str = "year",
                 months: Sequence[str] = MONTH_COLS, sentinels: Sequence[float] = WIDE_SENTINELS) -> DataFrame:
    """``(ids, year, jan..dec)`` -> ``(ids, period, value)``; sentinels -> NULL after the cast."""
    ids = list(ids)
    long = df.unpivot([*ids, year], list(months), "__mon", value_name)
    mon_no = F.array_position(F.array(*[F.lit(m) for m in months]), F.col("__mon")).cast("int")
    v = F.col(value_name).cast("double")
    v = F.when(~v.isin(*[F.lit(float(s)) for s in sentinels]) & ~F.isnan(v), v)
    return long.select(*ids, make_month(F.col(year).cast("int"), mon_no).alias("period"), v.alias(value_name))


def read_wide_months(spark: SparkSession, path: str, value_name: str = "soi",
                     sentinels: Sequence[float] = WIDE_SENTINELS, first_table_only: bool = True,
                     strict: bool = False, year_range=(1900, 2099), series_from: str = "file") -> DataFrame:
    """S3 + S4 + S5 + S6: wide year x month text -> long monthly rows named ``value_name``.

    Run-together tokens such as ``2.0-999.9-999.9`` are split before a minus that follows a
    digit; ``strict=True`` keeps the reference's behaviour instead (the whole token missing,
    later months shifted).
    """
    lines = _lines(spark, path, series_from)
    if not strict:  # a year may run into its January too; 1951-1980 is no year
        lines = lines.withColumn("line", F.regexp_replace("line", r"^(\s*[0-9]{4})(?=-[0-9]+\.)", "$1 "))
    lines = first_table(lines, year_range) if first_table_only else lines.filter(year_line(F.col("line"), year_range))
    text = F.col("line") if strict else F.regexp_replace("line", r"(?<=[0-9])-", " -")
    toks = lines.select("series", _tokens(text).alias("t"))
    wide = toks.select("series", F.get(F.col("t"), 0).try_cast("int").alias("year"),
                       *[_num(F.get(F.col("t"), i + 1)).alias(m) for i, m in enumerate(MONTH_COLS)])
    return wide_to_long(wide, ["series"], value_name, sentinels=sentinels)


def read_daily(spark: SparkSession, path: str, amplitude_threshold: float = 1.0,
               sentinels: Sequence[float] = DAILY_SENTINELS, monthly: bool = True,
               series_from: str = "file") -> DataFrame:
    """S7 (+ F7, A1): ``year month day rmm1 rmm2 phase amplitude source`` lines starting with a
    digit; 999 sentinels -> NULL; phase as sin/cos gated by amplitude; monthly means."""
    raw = _lines(spark, path, series_from)
    lines = raw.filter(F.trim("line").rlike(r"^[0-9]")).select("series", _tokens(F.col("line")).alias("t"))
    names = ["rmm1", "rmm2", "phase", "amplitude"]
    d = lines.select("series", F.get(F.col("t"), 0).try_cast("int").alias("y"), F.get(F.col("t"), 1).try_cast("int").alias("m"),
                     F.get(F.col("t"), 2).try_cast("int").alias("d"),
                     *[_num(F.get(F.col("t"), i + 3)).alias(n) for i, n in enumerate(names)])
    d = replace_sentinels(d, names, sentinels)
    d = d.select("series", make_month("y", "m").alias("period"), F.col("d").alias("day"), *names,
                 cyclic_sin("phase", "amplitude", amplitude_threshold).alias("mjo_sin"),
                 cyclic_cos("phase", "amplitude", amplitude_threshold).alias("mjo_cos"))
    d = d.filter(F.col("period").isNotNull())
    if not monthly:
        return d
    return d.groupBy("series", "period").agg(
        F.avg("rmm1").alias("rmm1"), F.avg("rmm2").alias("rmm2"), F.avg("amplitude").alias("mjo_amplitude"),
        F.avg("mjo_sin").alias("mjo_sin"), F.avg("mjo_cos").alias("mjo_cos"))


def registry(sources: dict[str, tuple[Callable[[], DataFrame], bool]], on: Sequence[str]) -> DataFrame:
    """Build every enabled source and merge them on the key (one shuffle, see J1)."""
    frames = [factory() for _name, (factory, enabled) in sources.items() if enabled]
    if not frames:
        raise ValueError("no source enabled")
    return merge_sources(frames, on)
