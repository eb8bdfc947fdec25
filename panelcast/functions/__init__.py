"""Scalar column functions (built-in expressions only, no Python UDFs)."""

from panelcast.functions.scalar import (
    LABELS,
    LABEL_INT,
    add_periods,
    crossing_months,
    crosses_barrier,
    cyclic_cos,
    cyclic_sin,
    in_months,
    label_to_int,
    lead_from_name,
    make_month,
    month_cos,
    month_sin,
    period_of,
    periods_between,
    phase_label,
    round_half_even,
    to_null_if_nan,
)

__all__ = [
    "LABELS", "LABEL_INT", "add_periods", "crossing_months", "crosses_barrier", "cyclic_cos",
    "cyclic_sin", "in_months", "label_to_int", "lead_from_name", "make_month", "month_cos",
    "month_sin", "period_of", "periods_between", "phase_label", "round_half_even", "to_null_if_nan",
]
