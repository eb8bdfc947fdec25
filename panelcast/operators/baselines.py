"""Naive baselines as DataFrame plans (A4, M11, M12, M13) and the long predictions layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS
from panelcast.operators.panel import Series, keys_of, ordered


def long_targets(df: DataFrame, series: Series, time: str, targets: Sequence[str],
                 carry: Sequence[str] = ()) -> DataFrame:
    """Unpivot class targets into ``(keys, time, carry…, target, y_true)`` (NULL truths kept)."""
    keys = keys_of(series)
    stacked = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("y_true")) for t in targets]))
    return df.select(*keys, time, *carry, stacked.alias("__s")).select(
        *keys, time, *carry, F.col("__s.target").alias("target"), F.col("__s.y_true").alias("y_true"))


def modal_class(train_long: DataFrame, by: Sequence[str] = ("target",), labels: Sequence[str] = LABELS,
                label_col: str = "y_true") -> DataFrame:
    """A4: most frequent label per group; ties broken by the fixed label order (deterministic)."""
    by = list(by)
    counts = train_long.filter(F.col(label_col).isNotNull()).groupBy(*by, label_col).agg(F.count(F.lit(1)).alias("n"))
    order = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label_col))
    w = Window.partitionBy(*by).orderBy(F.col("n").desc(), F.when(order > 0, order).otherwise(F.lit(10**6)),
                                        F.col(label_col))
    return (counts.select("*", F.row_number().over(w).alias("__r")).filter("__r = 1")
            .select(*by, F.col(label_col).alias("modal_class"), F.col("n").alias("modal_n")))


def climatology(train_long: DataFrame, test_long: DataFrame, by: Sequence[str] = ("target",),
                labels: Sequence[str] = LABELS) -> DataFrame:
    """The training modal class is the prediction for every test row.

    The modal table has one row per group (targets, or targets x series): joined on the
    group key, it is a broadcast when small and a co-partitioned join otherwise.
    """
    m = modal_class(train_long, by, labels)
    if tuple(by) == ("target",):
        m = F.broadcast(m)   # one row per target: bounded by the configured horizons
    return (test_long.join(m, on=list(by), how="left")
            .select(*test_long.columns, F.lit("climatology").alias("model"), F.col("modal_class").alias("y_pred")))


def persistence(test_long: DataFrame, phase_col: str) -> DataFrame:
    """The current class is the forecast for any horizon."""
    return test_long.select("*", F.lit("persistence").alias("model"), F.col(phase_col).alias("y_pred"))


def persistence_value(df: DataFrame, value: str, series: Series, time: str, fill_zero: bool = True) -> DataFrame:
    """Current value filled forward (unbounded, within the given rows only), then 0."""
    w = ordered(series, time).rowsBetween(Window.unboundedPreceding, 0)
    v = F.last(value, ignorenulls=True).over(w)
    if fill_zero:
        v = F.coalesce(v, F.lit(0.0))
    return df.select("*", v.alias("persistence_value"))
