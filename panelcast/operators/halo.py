"""Halo buckets: bounded windows over very long (or very hot) series without one-task partitions.

A window partitioned by the series key puts a whole series in one task.  For series with
millions of periods, split the time axis into buckets of ``bucket`` periods, copy each row to
the neighbouring bucket(s) whose frames can reach it, run the window function per
(series, bucket), and keep each row only in its home bucket.

``reach_back`` / ``reach_ahead`` must be the SUM of the reaches of chained windows
(e.g. fill 3 + smoothing 2 back, lead 6 ahead) and ``bucket`` must be at least each reach so
that only adjacent buckets are needed.  Only bounded ROWS frames on a dense grid qualify:
unbounded frames (standardisation, unlimited fill) need a per-bucket summary instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import periods_between
from panelcast.operators.panel import Series, keys_of

ORIGIN = {"month": "1970-01-01", "day": "1970-01-01", "hour": "1970-01-01 00:00:00"}


def with_halo(df: DataFrame, series: Series, time: str, fn: Callable[[DataFrame, list[str]], DataFrame],
              reach_back: int, reach_ahead: int, bucket: int, unit: str = "month",
              bucket_col: str = "__bucket") -> DataFrame:
    """Apply ``fn(frame, series_keys)`` per (series, time bucket) with halo rows; see module doc."""
    if bucket < max(reach_back, reach_ahead, 1):
        raise ValueError("bucket must be at least the window reach")
    keys = keys_of(series)
    origin = F.lit(ORIGIN[unit]).cast("timestamp" if unit == "hour" else "date")
    o = periods_between(origin, F.col(time), unit)
    b = F.floor(o / F.lit(bucket)).cast("long")
    pos = o - b * bucket
    home = F.struct(b.alias("b"), F.lit(True).alias("h"))
    nxt = F.when(pos >= bucket - reach_back, F.struct((b + 1).alias("b"), F.lit(False).alias("h")))
    prv = F.when(pos <= reach_ahead - 1, F.struct((b - 1).alias("b"), F.lit(False).alias("h")))
    copies = F.filter(F.array(home, nxt, prv), lambda s: s.isNotNull())
    x = df.select("*", F.explode(copies).alias("__c")).select(
        *df.columns, F.col("__c.b").alias(bucket_col), F.col("__c.h").alias("__home"))
    out = fn(x, [*keys, bucket_col])
    return out.filter(F.col("__home")).drop("__home", bucket_col)


#: A list of long series is broadcast up to this many rows (they are counted first), joined by shuffle above.
BROADCAST_SERIES = 100_000


def route_by_length(df: DataFrame, series: Series, time: str, plain: Callable[[DataFrame], DataFrame],
                    bucketed: Callable[[DataFrame], DataFrame], max_periods: int, unit: str = "month") -> DataFrame:
    """``plain`` over the series that span at most ``max_periods`` periods, ``bucketed`` over the longer ones, as one table.

    Both functions give the same rows for any series, so the result does not depend on ``max_periods``; it decides only how
    many periods one task may hold.  ``df`` (the aggregated panel, not the raw facts) is written once and read by the table of
    lengths, which has one row per series, and by both paths.  Series with a NULL key are routed like any other."""
    from panelcast.session import materialize

    keys = keys_of(series)
    p = materialize(df)
    span = periods_between(F.min(time), F.max(time), unit) + 1
    long = materialize(p.groupBy(*keys).agg(span.alias("__span")).filter(F.col("__span") > max_periods)
                       .select(*[F.col(k).alias(f"__long_{i}") for i, k in enumerate(keys)]))
    n = long.count()
    if n == 0:
        return plain(p)
    long = F.broadcast(long) if n <= BROADCAST_SERIES else long
    same = [F.col(k).eqNullSafe(F.col(f"__long_{i}")) for i, k in enumerate(keys)]
    return plain(p.join(long, same, "left_anti")).unionByName(bucketed(p.join(long, same, "left_semi")))
