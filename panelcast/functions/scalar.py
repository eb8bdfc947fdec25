"""Scalar column builders: phase labels, calendar encodings, period arithmetic.

All return ``pyspark.sql.Column`` expressions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results:
# class names in ascending order of the value (low, middle, high),
# thresholds -0.5 / +0.5, and the export integer codes 0, 1, 2.
LABELS: tuple[str, str, str] = ("La Niña", "Neutral", "El Niño")
LABEL_INT: dict[str, int] = {"La Niña": 0, "Neutral": 1, "El Niño": 2}
LOW_THRESHOLD = -0.5
HIGH_THRESHOLD = 0.5
# Boreal spring (March-May) and the post-barrier growth phase (June-November).
BARRIER_MONTHS = (3, 4, 5)
GROWTH_MONTHS = (6, 7, 8, 9, 10, 11)

UNITS = ("month", "day", "hour")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_null_if_nan(x) -> Column:
    """NaN is missing in the reference; in Spark it must become NULL (NaN > 0.5 is true)."""
    x = _c(x)
    return F.when(~F.isnan(x), x)


def phase_label(x, lo: float = LOW_THRESHOLD, hi: float = HIGH_THRESHOLD,
                names: Sequence[str] = LABELS) -> Column:
    """strict thresholds; > hi -> names[2], < lo -> names[0], else names[1]; NULL stays NULL."""
    x = _c(x)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x > hi, F.lit(names[2]))
            .when(x < lo, F.lit(names[0]))
            .otherwise(F.lit(names[1])))


def _lit_sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def phase_sql(x: str, lo: float = LOW_THRESHOLD, hi: float = HIGH_THRESHOLD, names: Sequence[str] = LABELS) -> str:
    """F1 as a SQL expression string over the SQL expression ``x``."""
    return (f"CASE WHEN ({x}) IS NULL THEN CAST(NULL AS STRING) WHEN ({x}) > {float(hi)} THEN {_lit_sql(names[2])} "
            f"WHEN ({x}) < {float(lo)} THEN {_lit_sql(names[0])} ELSE {_lit_sql(names[1])} END")


def round_half_even(x, decimals: int = 2) -> Column:
    """round on the binary value, ties to even (``rint(x * 10^d) / 10^d``)."""
    scale = float(10 ** decimals)
    return F.rint(_c(x) * scale) / scale


def month_sin(month) -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(month).cast("double") / 12.0)


def month_cos(month) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(month).cast("double") / 12.0)


def crossing_months(horizon: int, barrier: Iterable[int] = BARRIER_MONTHS) -> list[int]:
    """Init months whose forecast window t+1..t+horizon touches a barrier month (constant-folded)."""
    barrier = set(barrier)
    out = []
    for m in range(1, 13):
        window = {(m + step - 1) % 12 + 1 for step in range(1, horizon + 1)}
        if window & barrier:
            out.append(m)
    return out


def crosses_barrier(month, horizon, barrier: Iterable[int] = BARRIER_MONTHS) -> Column:
    """literal horizon -> ``month IN (...)``; column horizon -> ``exists(sequence(1, h), ...)``."""
    month = _c(month)
    if isinstance(horizon, int):
        return month.isin(crossing_months(horizon, barrier))
    b = F.array(*[F.lit(m) for m in sorted(set(barrier))])
    return F.exists(F.sequence(F.lit(1), _c(horizon)),
                    lambda s: F.array_contains(b, F.pmod(month + s - 1, F.lit(12)) + 1))


def in_months(month, months: Iterable[int] = GROWTH_MONTHS) -> Column:
    """F5 (and P13): calendar-month membership."""
    return _c(month).isin(sorted(set(months)))


def cyclic_sin(phase, amplitude, threshold: float = 1.0, n_phases: int = 8) -> Column:
    """sin of 2*pi*(phase-1)/n when amplitude >= threshold, else 0.0 (missing amplitude -> 0.0)."""
    angle = F.lit(2 * math.pi) * (_c(phase).cast("double") - 1.0) / float(n_phases)
    return F.when(_c(amplitude) >= threshold, F.sin(angle)).otherwise(F.lit(0.0))


def cyclic_cos(phase, amplitude, threshold: float = 1.0, n_phases: int = 8) -> Column:
    angle = F.lit(2 * math.pi) * (_c(phase).cast("double") - 1.0) / float(n_phases)
    return F.when(_c(amplitude) >= threshold, F.cos(angle)).otherwise(F.lit(0.0))


def label_to_int(x, mapping: dict[str, int] | None = None) -> Column:
    """F8: label -> int through a literal map; unknown / NULL stays NULL."""
    mapping = mapping or LABEL_INT
    m = F.create_map(*[v for k, i in mapping.items() for v in (F.lit(k), F.lit(i))])
    return m[_c(x)].cast("int")


def lead_from_name(target) -> Column:
    """``enso_t3`` -> 3; names without a ``t<digits>`` suffix -> NULL."""
    s = F.regexp_extract(_c(target), r"t([0-9]+)$", 1)
    return F.when(s != "", s.cast("int"))


def make_month(year, month) -> Column:
    """First day of the month from integer parts (invalid parts -> NULL)."""
    y, m = _c(year), _c(month)
    ok = y.between(1, 9999) & m.between(1, 12)
    return F.when(ok, F.make_date(F.when(ok, y).otherwise(1), F.when(ok, m).otherwise(1), F.lit(1)))


def period_of(ts, unit: str = "month") -> Column:
    """Truncate a date/timestamp to the start of its period (month/day -> DATE, hour -> the type of ``ts``)."""
    ts = _c(ts)
    if unit == "month":
        return F.trunc(ts, "month")
    if unit == "day":
        return F.to_date(ts)
    if unit == "hour":
        # not date_trunc: it turns a time without zone into an instant, and clock changes then merge hours
        return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))
    raise ValueError(f"unit must be one of {UNITS}")


def periods_between(start, end, unit: str = "month") -> Column:
    """Whole periods from ``start`` to ``end`` (both on the period grid)."""
    start, end = _c(start), _c(end)
    if unit == "month":
        return F.months_between(end, start).cast("int")
    if unit == "day":
        return F.datediff(end, start)
    if unit == "hour":
        return F.timestamp_diff("HOUR", start, end).cast("int")
    raise ValueError(f"unit must be one of {UNITS}")


def add_periods(ts, k, unit: str = "month") -> Column:
    """``ts`` moved by ``k`` periods (k may be a column)."""
    ts = _c(ts)
    k = F.lit(k) if isinstance(k, int) else _c(k)
    if unit == "month":
        return F.add_months(ts, k)
    if unit == "day":
        return F.date_add(ts, k)
    if unit == "hour":
        return F.timestamp_add("HOUR", k, ts)
    raise ValueError(f"unit must be one of {UNITS}")
