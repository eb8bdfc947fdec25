"""Exploration and analogue jobs.

Analogue search looks up the earlier and later months of every row by RANGE frames on the period's number: one read,
one shuffle, for one init month or all twelve, also where the months lie in other years.
Threshold events are runs of neighbouring periods; they meet a dated event table by slices of time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS
from panelcast.operators.panel import Series, _ordinal_sql, add_periods, at_offset, keys_of, q


#: More pairs in one aggregate would no longer be compiled to code.
PAIRS_AT_ONCE = 64


def month_lookup(df: DataFrame, value: Column, month: str = "month") -> DataFrame:
    """J7 dimension: one row per calendar month (at most 12 rows)."""
    return df.groupBy(month).agg(value)


def value_counts(df: DataFrame, col: str, normalize: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """A3: count per value (missing excluded) and its share of the group total."""
    c = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        c = c.select("*", (F.col("n") / F.sum("n").over(Window.partitionBy(*by))).alias("share"))
    return c


def pivot_share(df: DataFrame, row: str, col: str, values: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A5: row percentages of ``col`` categories per ``row`` (fixed category list -> one pass)."""
    p = df.filter(F.col(col).isNotNull()).groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    total = sum((F.coalesce(F.col(f"`{v}`"), F.lit(0)) for v in values), F.lit(0))
    return p.select(row, *[(F.coalesce(F.col(f"`{v}`"), F.lit(0)) * 100.0 / total).alias(n) for v, n in zip(values, names)])


def correlations(df: DataFrame, cols: Sequence[str], target: Column, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every column with the target (pairwise-complete) in one pass
    -> (by…, feature, corr, abs_corr)."""
    t = target.alias("__y")
    src = df.select(*by, *cols, t)
    row = src.groupBy(*by).agg(*[F.corr(F.col(c).cast("double"), F.col("__y").cast("double")).alias(c) for c in cols])
    long = row.unpivot(list(by), list(cols), "feature", "corr")
    return long.select("*", F.abs("corr").alias("abs_corr"))


def top_k(df: DataFrame, metric: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k rows with largest ``metric`` (ties broken by ``tie``): TakeOrdered."""
    return df.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), *[F.col(c).asc() for c in tie]).limit(k)


def correlation_matrix(df: DataFrame, cols: Sequence[str], complete_rows: bool = False) -> DataFrame:
    """All pairs (a < b and a = b) of Pearson correlations (pairwise-complete) -> (col_a, col_b, corr).

    Up to :data:`PAIRS_AT_ONCE` pairs are one compiled aggregate; more go by :func:`masked_correlations`.
    ``complete_rows=True`` drops rows with any missing value and lets ``pyspark.ml.stat.Correlation`` compute the
    matrix in one ``treeAggregate`` (the k x k result is the only thing brought to the driver)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    if complete_rows:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation
        vec = VectorAssembler(inputCols=list(cols), outputCol="__v").transform(
            df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna())
        mat = Correlation.corr(vec, "__v").first()[0].toArray()       # k x k, bounded by the column list
        idx = {c: i for i, c in enumerate(cols)}
        rows = [(a, b, float(mat[idx[a], idx[b]])) for a, b in pairs]
        return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")
    if len(pairs) > PAIRS_AT_ONCE:
        return masked_correlations(df, cols)
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"p{i}").alias("corr"))
                                          for i, (a, b) in enumerate(pairs)])).alias("s")).select("s.*")


def masked_correlations(df: DataFrame, cols: Sequence[str], flat: float = 1e-12) -> DataFrame:
    """A7 for long column lists with gaps: (col_a, col_b, corr) of every pair over the rows that have both.

    Each row becomes the vector of its masks, values and squares, gaps as 0.  One Gram matrix of these vectors (a JVM-side
    ``treeAggregate``) holds the count, sums, squares and products of every pair at once: masks by masks are the counts, values by
    masks the sums, squares by masks the squares, values by values the products.  Columns are shifted by their mean first, so
    that nothing cancels.  The k columns are written once and read twice (means, then the matrix); 3k x 3k doubles come to the driver, bounded by the column list.
    NULL where a pair has fewer than two rows, or where one side varies by less than the share ``flat`` of its squares; NaN and infinite
    values count as gaps."""
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    from panelcast.session import materialize

    k, inf = len(cols), float("inf")
    raw = [F.col(c).cast("double") for c in cols]
    finite = [F.when((F.abs(c) < inf) & ~F.isnan(c), c) for c in raw]
    x = materialize(df.select(*[c.alias(f"__x{i}") for i, c in enumerate(finite)]))
    # a constant column is shifted by its value, so that its squares are 0 and not rounding
    shift = [F.when(F.min(f"__x{i}") == F.max(f"__x{i}"), F.min(f"__x{i}")).otherwise(F.avg(f"__x{i}")) for i in range(k)]
    m = x.agg(F.count(F.lit(1)), *[F.coalesce(s, F.lit(0.0)) for s in shift]).first()
    out = "col_a string, col_b string, corr double"
    if not m[0]:
        return df.sparkSession.createDataFrame([(a, b, None) for i, a in enumerate(cols) for b in cols[i:]], out)
    v = [F.col(f"__x{i}") - F.lit(m[i + 1]) for i in range(k)]
    parts = x.select(*[F.when(F.col(f"__x{i}").isNotNull(), 1.0).otherwise(0.0).alias(f"__m{i}") for i in range(k)],
                     *[F.coalesce(v[i], F.lit(0.0)).alias(f"__v{i}") for i in range(k)],
                     *[F.coalesce(v[i] * v[i], F.lit(0.0)).alias(f"__s{i}") for i in range(k)])
    vec = VectorAssembler(inputCols=parts.columns, outputCol="__r").transform(parts).select("__r")
    g = RowMatrix(MLUtils.convertVectorColumnsFromML(vec, "__r"), 0, 3 * k).computeGramianMatrix().toArray()
    n, sums, squares, products = g[:k, :k], g[k:2 * k, :k], g[2 * k:, :k], g[k:2 * k, k:2 * k]
    # [i, j]: of column i over the rows that also have column j
    spread = n * squares - sums * sums
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = (n * products - sums * sums.T) / np.sqrt(spread * spread.T)
    known = (n >= 2) & (spread > flat * n * squares) & (spread.T > flat * n * squares.T)
    return df.sparkSession.createDataFrame(
        [(a, b, float(np.clip(corr[i, j], -1.0, 1.0)) if known[i, j] else None)
         for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i], out)


def extents(df: DataFrame, time: str, by: Sequence[str]) -> DataFrame:
    """Rows and first/last period per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("start"), F.max(time).alias("end"))


def by_year(df: DataFrame, series: Series, time: str, cols: dict[str, tuple[str, int]]) -> DataFrame:
    """One row per (series, year) with ``name = value of column c in month m`` (NULL if absent)."""
    keys = keys_of(series)
    return df.groupBy(*keys, F.year(time).cast("int").alias("year")).agg(
        *[F.max(F.when(F.month(time) == m, F.col(c))).alias(name) for name, (c, m) in cols.items()])


def analogues(df: DataFrame, series: Series, time: str, value: str, month: int | None = 4, lo: float = 0.0,
              hi: float = 0.5, prior_months: int = 2, prior_max: float = 0.0, current_year: int | None = None,
              outcome: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """N1 + J4 + J5: years whose ``month`` value is in [lo, hi] and whose value ``prior_months``
    earlier (in the year before, if need be) is < prior_max, before the current year (latest year of the series, or given).

    ``outcome`` adds later values, e.g. ``{"nov_value": ("anom", 11)}``: the first November after the init
    month.  ``month=None`` searches all twelve init months in one pass and adds the column ``month``.
    """
    keys = keys_of(series)
    offsets = {name: (c, (m - month) % 12 or 12) for name, (c, m) in (outcome or {}).items()} if month else {}
    if outcome and not month:
        raise ValueError("outcomes by calendar month need an init month")
    last = "max(year(" + q(time) + ")) OVER (PARTITION BY " + ", ".join(map(q, keys)) + ")" if current_year is None else str(int(current_year))
    rows = df.selectExpr(
        *map(q, keys), f"CAST(year({q(time)}) AS INT) AS year", f"CAST(month({q(time)}) AS INT) AS month", f"{q(value)} AS init_value",
        f"{at_offset(value, series, time, -prior_months)} AS prior_value",
        *[f"{at_offset(c, series, time, n)} AS {q(name)}" for name, (c, n) in offsets.items()], f"{last} AS __last")
    found = rows.filter(F.col("init_value").between(lo, hi) & (F.col("prior_value") < prior_max) & (F.col("year") < F.col("__last")))
    return found.drop("__last") if month is None else found.filter(F.col("month") == month).drop("__last", "month")


def analogue_summary(an: DataFrame, series: Series, phase_col: str, value_col: str, label: str = LABELS[2]) -> DataFrame:
    """Per series, analogue count, share reaching ``label``, ensemble mean and mean of positives."""
    keys = keys_of(series)
    return an.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_analogues"), F.count_if(F.col(phase_col) == label).alias("n_high"),
        (F.count_if(F.col(phase_col) == label) / F.count(F.lit(1))).alias("high_ratio"),
        F.avg(value_col).alias("mean_outcome"), F.avg(F.when(F.col(value_col) > 0, F.col(value_col))).alias("mean_positive"))


def trajectories(an: DataFrame, df: DataFrame, series: Series, time: str, value: str, start_month: int = 4,
                 end_month: int = 12) -> DataFrame:
    """Path of ``value`` from start_month to end_month of each analogue year (left join)."""
    keys = keys_of(series)
    steps = an.select(*keys, "year", F.explode(F.sequence(F.lit(0), F.lit(end_month - start_month))).alias("month_offset"))
    steps = steps.select("*", add_periods(F.make_date("year", F.lit(start_month), F.lit(1)), F.col("month_offset")).alias(time))
    return steps.join(df.select(*keys, time, value), [*keys, time], "left")


def sign_agreement(df: DataFrame, series: Series, time: str, a: str, b: str) -> DataFrame:
    """Latest non-missing value of two variables per series and whether their signs agree."""
    keys = keys_of(series)
    s = df.groupBy(*keys).agg(F.max_by(F.col(a), F.when(F.col(a).isNotNull(), F.col(time))).alias(a),
                              F.max_by(F.col(b), F.when(F.col(b).isNotNull(), F.col(time))).alias(b))
    return s.select("*", (F.signum(a) == F.signum(b)).alias("signs_agree"))


def exceedance(df: DataFrame, series: Series, time: str, value: str, lo: float = -0.5, hi: float = 0.5) -> DataFrame:
    """Per (series, year) months above ``hi`` and below ``lo``."""
    keys = keys_of(series)
    return df.groupBy(*keys, F.year(time).cast("int").alias("year")).agg(
        F.count_if(F.col(value) > hi).alias("months_above"), F.count_if(F.col(value) < lo).alias("months_below"),
        F.max(value).alias("peak"), F.min(value).alias("trough"))


def exceedance_runs(df: DataFrame, series: Series, time: str, value: str, lo: float = -0.5, hi: float = 0.5,
                    unit: str = "month") -> DataFrame:
    """One row per run of neighbouring periods above ``hi`` or below ``lo``: side, start, end, length, peak (the most extreme value).

    Gaps and islands: the period's number minus the row's rank among the rows of its side is the same within a run only.  An
    absent period or a missing value ends a run."""
    keys = keys_of(series)
    side = f"CASE WHEN {q(value)} > {float(hi)!r} THEN 'above' WHEN {q(value)} < {float(lo)!r} THEN 'below' END"
    rows = df.selectExpr(*map(q, keys), q(time), f"{q(value)} AS __v", f"{side} AS side").filter("side IS NOT NULL")
    by = ", ".join(map(q, keys))
    rows = rows.selectExpr("*", f"{_ordinal_sql(time, unit)} - row_number() OVER (PARTITION BY {by}, side ORDER BY {q(time)}) AS __run")
    return rows.groupBy(*keys, "side", "__run").agg(
        F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n_periods"),
        F.max_by("__v", F.abs("__v")).alias("peak")).drop("__run")


def join_events(runs: DataFrame, events: DataFrame, salts: int = 1) -> DataFrame:
    """Every pair of a run (start, end) and an event (event, start, end) that share a day, with ``n_shared_months``.

    Both sides are cut into calendar years and meet by year: an equi-join instead of a comparison of all pairs.  A pair is kept in the
    first year that both have.  ``salts`` deals the runs of a crowded year over so many tasks, and copies the events."""
    years = lambda a, b: F.explode(F.sequence(F.year(a), F.year(b)))
    salt = F.pmod(F.xxhash64(*runs.columns), F.lit(salts))
    left = runs.select("*", years("start", "end").alias("__year"), salt.alias("__salt"))
    right = events.select("event", F.col("start").alias("event_start"), F.col("end").alias("event_end"))
    right = right.select("*", years("event_start", "event_end").alias("__year"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("__salt"))
    first, last = F.greatest("start", "event_start"), F.least("end", "event_end")
    both = left.join(right, ["__year", "__salt"]).filter((first <= last) & (F.col("__year") == F.year(first)))
    return both.select(*runs.columns, "event", "event_start", "event_end",
                       (F.months_between(F.trunc(last, "month"), F.trunc(first, "month")) + 1).cast("bigint").alias("n_shared_months"))
