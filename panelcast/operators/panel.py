"""Core panel operators: time filter, numeric coercion, calendar grid, forward fill, merge.

Layout: ``series`` (one or more key columns) + ``time`` + value columns.  Every ordered
operation is a window partitioned by the series key, so a panel is processed with one
exchange on the key and the windows that follow reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.scalar import add_periods, period_of

Series = str | Sequence[str]


def keys_of(series: Series) -> list[str]:
    if series is None:
        raise ValueError("a series key is required: windows are always partitioned by it")
    return [series] if isinstance(series, str) else list(series)


def ordered(series: Series, time: str) -> Window:
    return Window.partitionBy(*keys_of(series)).orderBy(time)


def q(name: str) -> str:
    """Backquoted identifier for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def over(series: Series, time: str | None = None, frame: tuple | None = None) -> str:
    """SQL window clause ``OVER (PARTITION BY … ORDER BY … ROWS BETWEEN …)``.

    Expressions are passed to the JVM as one SQL string each (one call instead of one per
    sub-expression); Catalyst builds the same plan as with the Column API."""
    parts = ["PARTITION BY " + ", ".join(q(k) for k in keys_of(series))]
    if time is not None:
        parts.append(f"ORDER BY {q(time)}")
    if frame is not None:
        lo, hi = frame
        lo_s = "UNBOUNDED PRECEDING" if lo is None else (f"{-lo} PRECEDING" if lo < 0 else
                                                          ("CURRENT ROW" if lo == 0 else f"{lo} FOLLOWING"))
        hi_s = "UNBOUNDED FOLLOWING" if hi is None else (f"{hi} FOLLOWING" if hi > 0 else
                                                          ("CURRENT ROW" if hi == 0 else f"{-hi} PRECEDING"))
        parts.append(f"ROWS BETWEEN {lo_s} AND {hi_s}")
    return "OVER (" + " ".join(parts) + ")"


def whole(series: Series) -> Window:
    return Window.partitionBy(*keys_of(series))


def value_columns(df: DataFrame, series: Series, time: str) -> list[str]:
    skip = set(keys_of(series)) | {time}
    return [c for c in df.columns if c not in skip]


# --------------------------------------------------------------------------- P1
def filter_time_range(df: DataFrame, time: str, start=None, end=None) -> DataFrame:
    """Keep ``start <= time <= end``; None leaves that side open.  Strings like '1996-01' are whole
    months: as an end bound every day and hour of that month is kept."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(time) >= _as_date(start))
    if end is not None:
        month = isinstance(end, str) and len(end) == 7
        cond = cond & ((F.col(time) < F.add_months(_as_date(end), 1)) if month else (F.col(time) <= _as_date(end)))
    return df.filter(cond)


def _as_date(v) -> Column:
    if isinstance(v, str) and len(v) == 7:  # 'YYYY-MM' = first day of that month
        v = v + "-01"
    return F.lit(v).cast("date") if isinstance(v, str) else F.lit(v)


# --------------------------------------------------------------------------- P2
def coerce_numeric(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """String columns -> DOUBLE, unparseable -> NULL; NaN -> NULL for every double column."""
    cols = set(cols) if cols is not None else {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if f.name in cols and isinstance(f.dataType, T.StringType):
            v = F.expr(f"try_cast(`{f.name}` as double)")
            out.append(F.when(~F.isnan(v), v).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(~F.isnan(c), c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# --------------------------------------------------------------------------- C1 / J2
def _gap_guard(gap_sql: str, max_gap_periods: int | None) -> str:
    """Outlier-date guard: a gap above the bound stops the job with an error (rows are never
    dropped or capped); the bound is the caller's statement of the largest plausible hole."""
    if max_gap_periods is None:
        return gap_sql
    return (f"CASE WHEN ({gap_sql}) > {int(max_gap_periods)} THEN "
            f"raise_error('grid gap above max_gap_periods={int(max_gap_periods)}: check for outlier dates') "
            f"ELSE ({gap_sql}) END")


def regular_grid(df: DataFrame, series: Series, time: str, unit: str = "month",
                 flag: str | None = "is_inserted", max_gap_periods: int | None = None) -> DataFrame:
    """Put every series on a gapless grid from its own first to its last period.

    One window pass: each observed row looks at the next observed period and emits
    itself plus one NULL row per missing period (``explode(sequence(0, gap))``).  No join
    to a calendar spine, no extra shuffle; grid size is the sum of each series' span.
    A period that occurs twice in a series stops the job with an error.
    """
    keys = keys_of(series)
    vals = value_columns(df, series, time)
    t = q(time)
    nxt = f"lead({t}) {over(series, time)}"
    gap = {"month": f"CAST(months_between({nxt}, {t}) AS INT)", "day": f"datediff({nxt}, {t})",
           "hour": f"CAST(timestampdiff(HOUR, {t}, {nxt}) AS INT)"}[unit]
    gap = f"CASE WHEN {nxt} = {t} THEN raise_error('grid: a series has a period twice') ELSE {gap} END"
    cols = [q(c) for c in keys + [time] + vals]
    step = df.selectExpr(*cols, f"greatest(coalesce({_gap_guard(gap, max_gap_periods)} - 1, 0), 0) AS __gap")
    step = step.selectExpr(*cols, "explode(sequence(0, __gap)) AS __k")
    shift = {"month": f"add_months({t}, __k)", "day": f"date_add({t}, __k)", "hour": f"timestampadd(HOUR, __k, {t})"}[unit]
    out = [q(k) for k in keys] + [f"{shift} AS {t}"] + [f"CASE WHEN __k = 0 THEN {q(c)} END AS {q(c)}" for c in vals]
    if flag:
        out.append(f"__k > 0 AS {q(flag)}")
    return step.selectExpr(*out)


def calendar_spine(df: DataFrame, series: Series, time: str, unit: str = "month") -> DataFrame:
    """Per-series calendar (series, time) from min to max; used for J2-style left joins."""
    keys = keys_of(series)
    step = {"month": "interval 1 month", "day": "interval 1 day", "hour": "interval 1 hour"}[unit]
    b = df.groupBy(*keys).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    return b.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr(step))).alias(time))


def reindex(df: DataFrame, series: Series, time: str, unit: str = "month") -> DataFrame:
    """Left join onto the per-series calendar; absent periods become NULL rows."""
    keys = keys_of(series)
    return calendar_spine(df, series, time, unit).join(df, on=[*keys, time], how="left")


# --------------------------------------------------------------------------- W7 / W8
def ffill(df: DataFrame, cols: Iterable[str] | None, series: Series, time: str,
          limit: int | None = None, whole_gap_only: bool = False,
          flag_prefix: str | None = None) -> DataFrame:
    """Forward fill within each series.

    ``limit=k`` fills at most the first k rows after the last valid value (pandas
    ``ffill(limit=k)``); ``limit=None`` fills without bound.  ``whole_gap_only`` fills a gap
    only when the whole gap is at most ``limit`` rows long.  ``flag_prefix`` adds a boolean
    ``<prefix><col>`` telling which values were filled.
    """
    cols = list(cols) if cols is not None else value_columns(df, series, time)
    if whole_gap_only and limit is not None:
        return _ffill_whole_gaps(df, cols, series, time, limit, flag_prefix)
    w = over(series, time, (-limit if limit is not None else None, 0))
    out = []
    for c in df.columns:
        if c in cols:
            filled = f"last({q(c)}, true) {w}"
            out.append(f"{filled} AS {q(c)}")
            if flag_prefix:
                out.append(f"({q(c)} IS NULL AND {filled} IS NOT NULL) AS {q(flag_prefix + c)}")
        else:
            out.append(q(c))
    return df.selectExpr(*out)


def _ffill_whole_gaps(df, cols, series, time, limit, flag_prefix):
    w = ordered(series, time)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    tmp = df.select("*", F.row_number().over(w).alias("__rn"), F.count(F.lit(1)).over(whole(series)).alias("__n"))
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        pos = F.when(F.col(c).isNotNull(), F.col("__rn"))
        prev = F.last(pos, ignorenulls=True).over(before)
        nxt = F.coalesce(F.first(pos, ignorenulls=True).over(after), F.col("__n") + 1)
        ok = F.col(c).isNull() & prev.isNotNull() & ((nxt - prev - 1) <= limit)
        out.append(F.when(ok, F.last(c, ignorenulls=True).over(before)).otherwise(F.col(c)).alias(c))
        if flag_prefix:
            out.append(ok.alias(flag_prefix + c))
    return tmp.select(*out)


# --------------------------------------------------------------------------- C2
def clean(df: DataFrame, series: Series, time: str, start=None, end=None, max_gap: int = 3,
          unit: str = "month", whole_gap_only: bool = False) -> DataFrame:
    """P1 -> P2 -> C1 (truncate + grid) -> W7, as one lazy plan."""
    df = filter_time_range(df, time, start, end)
    df = coerce_numeric(df, [c for c in value_columns(df, series, time)])
    df = df.withColumn(time, period_of(time, unit))
    grid = regular_grid(df, series, time, unit)
    vals = [c for c in value_columns(df, series, time)]
    return ffill(grid, vals, series, time, limit=max_gap, whole_gap_only=whole_gap_only)


# --------------------------------------------------------------------------- J1 / S8
def merge_sources(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer merge of k sources on a unique key with ONE shuffle.

    ``unionByName(allowMissingColumns)`` + ``groupBy(key).agg(first(ignorenulls))`` equals the
    chained full outer join when each source has at most one row per key and disjoint
    value columns.
    """
    on = list(on)
    value_cols: list[str] = []
    for f in frames:
        for c in f.columns:
            if c not in on and c not in value_cols:
                value_cols.append(c)
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.groupBy(*on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in value_cols])


def merge_sources_join(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """J1 as chained USING full outer joins (one shuffle per source); kept for comparison."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, on=list(on), how="full_outer")
    return out


# --------------------------------------------------------------------------- fixture prep
def standardize(df: DataFrame, cols: Iterable[str], series: Series, suffix: str = "",
                mask: Column | None = None) -> DataFrame:
    """(v - mean) / stddev_samp per series; ``mask`` restricts the rows the moments come from."""
    w = whole(series)
    ws = over(series)
    exprs = {}
    for c in cols:
        if mask is None:
            mu, sd = f"avg({q(c)}) {ws}", f"stddev_samp({q(c)}) {ws}"
            exprs[c] = F.expr(f"CASE WHEN {sd} > 0 THEN ({q(c)} - {mu}) / {sd} END").alias(c + suffix)
            continue
        src = F.when(mask, F.col(c))
        mu, sd = F.avg(src).over(w), F.stddev_samp(src).over(w)
        exprs[c] = F.when(sd > 0, (F.col(c) - mu) / sd).alias(c + suffix)
    if suffix:
        return df.select("*", *exprs.values())
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])


# --------------------------------------------------------------------------- W9 / W10
def latest_valid(df: DataFrame, cols: Iterable[str], series: Series, time: str) -> DataFrame:
    """Per series, the last non-missing value of each column and when it was seen."""
    keys = keys_of(series)
    aggs = []
    for c in cols:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time))).alias(c))
        aggs.append(F.max(F.when(F.col(c).isNotNull(), F.col(time))).alias(f"{c}_{time}"))
    return df.groupBy(*keys).agg(*aggs)


def current_state(df: DataFrame, cols: Iterable[str], series: Series, time: str, at=None) -> DataFrame:
    """The state vector at the last period (or at ``at``): each value filled forward from
    history up to that period (never from later rows)."""
    keys = keys_of(series)
    src = df if at is None else df.filter(F.col(time) <= _as_date(at))
    aggs = [F.max(time).alias(time)]
    for c in cols:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time))).alias(c))
    return src.groupBy(*keys).agg(*aggs)


# --------------------------------------------------------------------------- J4 / Q6
def at_offset(col: str, series: Series, time: str, periods: int, unit: str = "month") -> str:
    """SQL: the value of ``col`` exactly ``periods`` periods later (earlier if negative) in the series, NULL where that period is
    absent.  A RANGE frame on the period's number: no join, no grid, and all offsets share one exchange and sort."""
    keys = ", ".join(q(k) for k in keys_of(series))
    side = f"{abs(int(periods))} {'FOLLOWING' if periods > 0 else 'PRECEDING'}"
    return (f"max({q(col)}) OVER (PARTITION BY {keys} ORDER BY {_ordinal_sql(time, unit)} "
            f"RANGE BETWEEN {side} AND {side})")


def shift_join(df: DataFrame, cols: Iterable[str], series: Series, time: str, periods: int,
               unit: str = "month", suffix: str | None = None) -> DataFrame:
    """Value ``periods`` periods earlier, looked up by the period itself (one read of ``df``).

    Works on gapped panels (absent period -> NULL).  A period that occurs twice gives its largest value.
    """
    suffix = suffix if suffix is not None else f"_shift{periods}"
    return df.selectExpr("*", *[f"{at_offset(c, series, time, -periods, unit)} AS {q(c + suffix)}" for c in cols])


# --------------------------------------------------------------------------- padded time filter
def padded_range(df: DataFrame, time: str, start, end, reach_back: int, reach_ahead: int,
                 compute, unit: str = "month") -> DataFrame:
    """Filter a wider range so that windows see their full frames, compute, then trim.

    Catalyst cannot push a time filter below a window (it would cut frames); this helper
    pushes ``[start - back, end + ahead]`` to the scan and trims after ``compute``.
    """
    lo = add_periods(_as_date(start), -reach_back, unit) if start is not None else None
    hi = add_periods(_as_date(end), reach_ahead, unit) if end is not None else None
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(time) >= lo)
    if hi is not None:
        cond = cond & (F.col(time) <= hi)
    return filter_time_range(compute(df.filter(cond)), time, start, end)


# --------------------------------------------------------------------------- A1
def rollup_mean(df: DataFrame, series: Series, time: str, cols: Iterable[str], unit: str = "month",
                count_col: str | None = "n", out: str | None = None) -> DataFrame:
    """A1: mean of each column per series and coarser period (missing values skipped).
    Partial aggregation happens before the shuffle, so a hot series costs one combiner."""
    keys = keys_of(series)
    aggs = [F.avg(c).alias(c) for c in cols]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys, period_of(time, unit).alias(out or time)).agg(*aggs)


# --------------------------------------------------------------------------- skew-safe variants
_ORIGIN = {"month": "DATE'1970-01-01'", "day": "DATE'1970-01-01'", "hour": "TIMESTAMP_NTZ'1970-01-01 00:00:00'"}


def _ordinal_sql(time: str, unit: str) -> str:
    t = q(time)
    return {"month": f"CAST(months_between({t}, {_ORIGIN[unit]}) AS BIGINT)",
            "day": f"CAST(datediff({t}, {_ORIGIN[unit]}) AS BIGINT)",
            "hour": f"CAST(timestampdiff(HOUR, {_ORIGIN[unit]}, {t}) AS BIGINT)"}[unit]


def _join_summary(df: DataFrame, summary: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df`` with the columns of its summary table; a NULL key is a series like any other."""
    right = summary.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(on)], *[c for c in summary.columns if c not in on])
    return df.join(right, [F.col(c).eqNullSafe(F.col(f"__on{i}")) for i, c in enumerate(on)], "left")


def regular_grid_bucketed(df: DataFrame, series: Series, time: str, bucket: int, unit: str = "month",
                          flag: str | None = "is_inserted") -> DataFrame:
    """C1 for hot / very long series: the time axis is cut into buckets of ``bucket`` periods and
    the next observed period is found inside (series, bucket) partitions; the last row of a
    bucket takes the first period of the next non-empty bucket from a per-bucket summary
    (``span / bucket`` rows per series).  Same output as :func:`regular_grid`."""
    keys = keys_of(series)
    vals = value_columns(df, series, time)
    b = df.selectExpr("*", f"floor({_ordinal_sql(time, unit)} / {int(bucket)}) AS __b")
    summary = b.groupBy(*keys, "__b").agg(F.min(time).alias("__first"))
    summary = summary.selectExpr(*[q(k) for k in keys], "__b", f"lead(__first) {over(keys, '__b')} AS __next_first")
    nxt = f"coalesce(lead({q(time)}) {over([*keys, '__b'], time)}, __next_first)"
    t = q(time)
    gap = {"month": f"CAST(months_between({nxt}, {t}) AS INT)", "day": f"datediff({nxt}, {t})",
           "hour": f"CAST(timestampdiff(HOUR, {t}, {nxt}) AS INT)"}[unit]
    gap = f"CASE WHEN {nxt} = {t} THEN raise_error('grid: a series has a period twice') ELSE {gap} END"
    j = _join_summary(b, summary, [*keys, "__b"])
    cols = [q(c) for c in keys + [time] + vals]
    step = j.selectExpr(*cols, f"greatest(coalesce({gap} - 1, 0), 0) AS __gap")
    step = step.selectExpr(*cols, "explode(sequence(0, __gap)) AS __k")
    shift = {"month": f"add_months({t}, __k)", "day": f"date_add({t}, __k)", "hour": f"timestampadd(HOUR, __k, {t})"}[unit]
    out = [q(k) for k in keys] + [f"{shift} AS {t}"] + [f"CASE WHEN __k = 0 THEN {q(c)} END AS {q(c)}" for c in vals]
    if flag:
        out.append(f"__k > 0 AS {q(flag)}")
    return step.selectExpr(*out)


def standardize_by_join(df: DataFrame, cols: Iterable[str], series: Series) -> DataFrame:
    """Standardisation for hot series: moments by a partially aggregated ``groupBy`` (one
    combiner per task, however big a series is) joined back on the key, instead of a window
    that holds a whole series in one task."""
    keys = keys_of(series)
    cols = list(cols)
    stats = df.groupBy(*keys).agg(*[F.avg(c).alias(f"__mu{i}") for i, c in enumerate(cols)],
                                  *[F.stddev_samp(c).alias(f"__sd{i}") for i, c in enumerate(cols)])
    j = _join_summary(df, stats, keys)
    idx = {c: i for i, c in enumerate(cols)}
    return j.selectExpr(*[
        f"CASE WHEN __sd{idx[c]} > 0 THEN ({q(c)} - __mu{idx[c]}) / __sd{idx[c]} END AS {q(c)}" if c in idx else q(c)
        for c in df.columns])


def ffill_bucketed(df: DataFrame, cols: Iterable[str], series: Series, time: str, bucket: int,
                   unit: str = "month") -> DataFrame:
    """W8 without a limit for hot / very long series: fill inside (series, time bucket)
    partitions, and carry the last non-missing value of earlier buckets in from a per-bucket
    summary (``span / bucket`` rows per series, windowed and joined back).  Same result as
    ``ffill(limit=None)``."""
    keys = keys_of(series)
    cols = list(cols)
    b = df.selectExpr("*", f"floor({_ordinal_sql(time, unit)} / {int(bucket)}) AS __b")
    inner = over([*keys, "__b"], time, (None, 0))
    within = b.selectExpr(*[q(c) for c in df.columns], "__b",
                          *[f"last({q(c)}, true) {inner} AS __in{i}" for i, c in enumerate(cols)])
    summ = b.groupBy(*keys, "__b").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time))).alias(f"__last{i}")
                                         for i, c in enumerate(cols)])
    carry = over(keys, "__b", (None, -1))
    summ = summ.selectExpr(*[q(k) for k in keys], "__b",
                           *[f"last(__last{i}, true) {carry} AS __carry{i}" for i in range(len(cols))])
    j = _join_summary(within, summ, [*keys, "__b"])
    idx = {c: i for i, c in enumerate(cols)}
    return j.selectExpr(*[f"coalesce(__in{idx[c]}, __carry{idx[c]}) AS {q(c)}" if c in idx else q(c) for c in df.columns])
