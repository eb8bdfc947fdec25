"""Class and value targets at several horizons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import HIGH_THRESHOLD, LABELS, LOW_THRESHOLD, phase_sql
from panelcast.operators.panel import Series, over, q

DEFAULT_HORIZONS = (1, 3, 6)


def smooth(value: str, series: Series, time: str, window: int = 3, min_periods: int = 2):
    """Trailing ``window`` rows incl. current; NULL unless ``min_periods`` are non-missing."""
    w = over(series, time, (-(window - 1), 0))
    return F.expr(f"CASE WHEN count({q(value)}) {w} >= {min_periods} THEN avg({q(value)}) {w} END")


def label(df: DataFrame, value: str, series: Series, time: str,
          horizons: Sequence[int] = DEFAULT_HORIZONS, lo: float = LOW_THRESHOLD, hi: float = HIGH_THRESHOLD,
          window: int = 3, min_periods: int = 2, names: Sequence[str] = LABELS,
          class_prefix: str = "enso", value_prefix: str = "nino34", decimals: int = 2) -> DataFrame:
    """``<class_prefix>_phase`` at t, and per horizon L the class ``<class_prefix>_tL`` and
    the value ``<value_prefix>_tL`` (rounded to ``decimals``) of the smoothed series at t+L.

    The class uses the unrounded value.  The smoothed series itself is not kept (it would
    leak the targets).  Requires a dense grid (rows = periods).
    """
    if value not in df.columns:
        raise ValueError(f"source column {value!r} not found; available: {df.columns}")
    w = over(series, time)
    tmp = df.select("*", smooth(value, series, time, window, min_periods).alias("__sm"))
    scale = float(10 ** decimals)
    exprs = [f"{phase_sql('__sm', lo, hi, names)} AS {q(class_prefix + '_phase')}"]
    for h in horizons:
        future = f"lead(__sm, {h}) {w}"
        exprs.append(f"{phase_sql(future, lo, hi, names)} AS {q(f'{class_prefix}_t{h}')}")
        exprs.append(f"rint({future} * {scale}) / {scale} AS {q(f'{value_prefix}_t{h}')}")
    return tmp.selectExpr(*[q(c) for c in df.columns], *exprs)


def target_columns(horizons: Sequence[int] = DEFAULT_HORIZONS, class_prefix: str = "enso",
                   value_prefix: str = "nino34") -> dict[str, list[str]]:
    """Role lists produced by :func:`label` (used by feature selection and the leakage gate)."""
    return {
        "phase": [f"{class_prefix}_phase"],
        "class": [f"{class_prefix}_t{h}" for h in horizons],
        "value": [f"{value_prefix}_t{h}" for h in horizons],
    }
