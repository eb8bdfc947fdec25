"""Strictly backward-looking features (W1-W4, F2-F5, C4, C5), all in one ``select``.

Every expression shares the same window spec, so Catalyst plans one exchange on the
series key and one sort for all of them.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.scalar import BARRIER_MONTHS, GROWTH_MONTHS, crossing_months
from panelcast.operators.panel import Series, _ordinal_sql, keys_of, over, q


def _e(sql: str, name: str) -> Column:
    return F.expr(f"{sql} AS {q(name)}")


def _range_over(series: Series, time: str, unit: str, lo: int, hi: int) -> str:
    """RANGE frame over the integer period ordinal: exact on panels with absent periods."""
    keys = ", ".join(q(k) for k in keys_of(series))
    return (f"OVER (PARTITION BY {keys} ORDER BY {_ordinal_sql(time, unit)} "
            f"RANGE BETWEEN {-lo} PRECEDING AND {('CURRENT ROW' if hi == 0 else f'{-hi} PRECEDING')})")


def _past(col: str, series, time, L: int, gapped: str | None) -> str:
    """Value L periods back: ``lag`` on a dense grid, an exact-offset RANGE frame otherwise."""
    if gapped is None:
        return f"lag({q(col)}, {L}) {over(series, time)}"
    return f"first({q(col)}) {_range_over(series, time, gapped, -L, -L)}"


def lag_exprs(col: str, series: Series, time: str, lags: Iterable[int], gapped: str | None = None) -> list[Column]:
    """``{col}_lag{L}`` = value L periods back (rows on a dense grid; ``gapped=unit`` uses
    RANGE frames on the period ordinal so absent periods count as missing, no grid needed)."""
    return [_e(_past(col, series, time, L, gapped), f"{col}_lag{L}") for L in lags]


def _rolling(fn: str, col: str, series, time, W: int, min_periods: int, gapped: str | None = None) -> str:
    w = over(series, time, (-(W - 1), 0)) if gapped is None else _range_over(series, time, gapped, -(W - 1), 0)
    return f"CASE WHEN count({q(col)}) {w} >= {min_periods} THEN {fn}({q(col)}) {w} END"


def rolling_mean_exprs(col: str, series: Series, time: str, windows: Iterable[int], min_periods: int = 2,
                       gapped: str | None = None):
    """Trailing mean over W periods incl. current, NULL unless ``min_periods`` non-missing."""
    return [_e(_rolling("avg", col, series, time, W, min_periods, gapped), f"{col}_rm{W}") for W in windows]


def rolling_std_exprs(col: str, series: Series, time: str, windows: Iterable[int], min_periods: int = 2,
                      gapped: str | None = None):
    """Trailing sample standard deviation (ddof 1)."""
    return [_e(_rolling("stddev_samp", col, series, time, W, min_periods, gapped), f"{col}_rstd{W}") for W in windows]


def diff_exprs(col: str, series: Series, time: str, periods: Iterable[int], gapped: str | None = None) -> list[Column]:
    """``x_t - x_{t-P}``."""
    return [_e(f"{q(col)} - {_past(col, series, time, P, gapped)}", f"{col}_diff{P}") for P in periods]


def calendar_exprs(time: str) -> list[Column]:
    """month sin/cos, month and year as INT."""
    m = f"CAST(month({q(time)}) AS DOUBLE)"
    return [_e(f"sin(2 * pi() * {m} / 12.0)", "month_sin"), _e(f"cos(2 * pi() * {m} / 12.0)", "month_cos"),
            _e(f"CAST(month({q(time)}) AS INT)", "month"), _e(f"CAST(year({q(time)}) AS INT)", "year")]


def barrier_exprs(time: str, horizons: Iterable[int], barrier_months=BARRIER_MONTHS,
                  growth_months=GROWTH_MONTHS, barrier_name: str = "crosses_spring",
                  growth_name: str = "init_in_growth_phase") -> list[Column]:
    """Window-crosses-barrier flags per horizon and growth-phase flag."""
    m = f"month({q(time)})"
    out = [_e(f"{m} IN ({', '.join(map(str, crossing_months(int(h), barrier_months)))})", f"{barrier_name}_t{h}")
           for h in horizons]
    out.append(_e(f"{m} IN ({', '.join(map(str, sorted(set(growth_months))))})", growth_name))
    return out


def build_features(df: DataFrame, base: Sequence[str], series: Series, time: str,
                   lags: Iterable[int] | None = (1, 3, 6), mean: Iterable[int] | None = (3,),
                   std: Iterable[int] | None = (3,), diff: Iterable[int] | None = (1,),
                   min_periods: int = 2, horizons: Iterable[int] = (1, 3, 6),
                   barrier_months=BARRIER_MONTHS, growth_months=GROWTH_MONTHS,
                   calendar: bool = True, gapped: str | None = None) -> DataFrame:
    """C4: per base variable lags, rolling mean/std, differences; then calendar and barrier flags.

    A base variable absent from ``df`` is skipped with a warning; ``None`` disables a transform.
    By default it needs a dense grid (ROWS frames count rows).  ``gapped="month"`` (or "day",
    "hour") computes the same values on a panel with absent periods through RANGE frames on
    the period ordinal, without materialising the grid.
    """
    exprs: list[Column] = []
    for col in base:
        if col not in df.columns:
            warnings.warn(f"base variable {col!r} not in DataFrame - skipped", stacklevel=2)
            continue
        if lags:
            exprs += lag_exprs(col, series, time, lags, gapped)
        if mean:
            exprs += rolling_mean_exprs(col, series, time, mean, min_periods, gapped)
        if std:
            exprs += rolling_std_exprs(col, series, time, std, min_periods, gapped)
        if diff:
            exprs += diff_exprs(col, series, time, diff, gapped)
    if calendar:
        exprs += calendar_exprs(time)
        exprs += barrier_exprs(time, horizons, barrier_months, growth_months)
    return df.select("*", *exprs)


def features_from_config(df: DataFrame, config: dict, series: Series, time: str,
                         horizons: Iterable[int] = (1, 3, 6)) -> DataFrame:
    """C4 driven by a config dict ``{base_variables, transformations: {lags: {enabled, months}, ...}}``."""
    tf = config.get("transformations", {})

    def pick(name, key, default):
        spec = tf.get(name, {})
        return spec.get(key, default) if spec.get("enabled", True) else None

    return build_features(df, config.get("base_variables", []), series, time,
                          lags=pick("lags", "months", [1, 3, 6]),
                          mean=pick("rolling_mean", "windows", [3]),
                          std=pick("rolling_std", "windows", [3]),
                          diff=pick("diff", "periods", [1]), horizons=horizons)


def feature_columns(df: DataFrame, exclude: Iterable[str], series: Series, time: str,
                    numeric_only: bool = False, include_bool: bool = True) -> list[str]:
    """Every column except targets, keys and time (optionally numeric [and boolean] only)."""
    skip = set(exclude) | set(keys_of(series)) | {time}
    out = []
    for f in df.schema:
        if f.name in skip:
            continue
        kinds = (T.NumericType, T.BooleanType) if include_bool else (T.NumericType,)
        if numeric_only and not isinstance(f.dataType, kinds):
            continue
        out.append(f.name)
    return out
