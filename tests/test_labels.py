"""Labelling cases (phases found, target columns, trailing missing, shift equality, custom horizons)."""
import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS
from panelcast.operators.labels import label

LA, NE, EN = LABELS


def months(n, start=(1990, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def frame(spark, values, series="s1"):
    return spark.createDataFrame([(series, d, v) for d, v in zip(months(len(values)), values)],
                                 "series string, period date, x double")


def rows(df, col):
    return [r[col] for r in df.orderBy("series", "period").collect()]


def test_each_phase_found(spark):
    vals = [1.5, 1.6, 1.4, 1.2, 0.0, 0.0, 0.1, -1.2, -1.5, -1.4, 0.0, 0.0]
    out = label(frame(spark, vals), "x", "series", "period")
    phases = set(rows(out, "enso_phase")) - {None}
    assert phases == {LA, NE, EN}


def test_targets_exist_and_trailing_missing(spark):
    out = label(frame(spark, [0.1 * i for i in range(24)]), "x", "series", "period")
    for h in (1, 3, 6):
        assert f"enso_t{h}" in out.columns and f"nino34_t{h}" in out.columns
    t6 = rows(out, "enso_t6")
    assert all(v is None for v in t6[-6:]) and sum(v is None for v in t6) >= 6
    assert "__sm" not in out.columns


def test_shift_equality_all_rows(spark):
    vals = [0.9, -0.7, 0.2, 1.3, -1.1, 0.0, 0.6, -0.6, 0.4, 1.8, -2.0, 0.3, 0.8, -0.2, 0.1, 0.7]
    out = label(frame(spark, vals), "x", "series", "period")
    ph, t1 = rows(out, "enso_phase"), rows(out, "enso_t1")
    for i in range(len(vals) - 1):
        assert t1[i] == ph[i + 1]


def test_custom_horizons(spark):
    out = label(frame(spark, [0.1] * 20), "x", "series", "period", horizons=(2, 12))
    assert {"enso_t2", "enso_t12", "nino34_t2", "nino34_t12"} <= set(out.columns)
    assert "enso_t1" not in out.columns


def test_matches_pandas_and_series_do_not_mix(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, 40).round(3).tolist()
    b = rng.normal(0, 1, 40).round(3).tolist()
    a[5] = None
    df = frame(spark, a, "a").unionByName(frame(spark, b, "b"))
    out = label(df, "x", "series", "period").toPandas().sort_values(["series", "period"])
    for s, vals in (("a", a), ("b", b)):
        sm = pd.Series(vals, dtype="float64").rolling(3, min_periods=2).mean()
        got = out[out.series == s]
        exp_phase = np.where(sm.isna(), None, np.where(sm > 0.5, EN, np.where(sm < -0.5, LA, NE)))
        assert list(got.enso_phase) == list(exp_phase)
        fut = sm.shift(-3)
        exp_val = (np.rint(fut * 100) / 100).tolist()
        got_val = got.nino34_t3.tolist()
        for x, y in zip(exp_val, got_val):
            assert (pd.isna(x) and pd.isna(y)) or abs(x - y) < 1e-12


def test_missing_source_column_raises(spark):
    with pytest.raises(ValueError):
        label(frame(spark, [0.0] * 5), "nope", "series", "period")


def test_class_uses_unrounded_value(spark):
    # smoothed 0.504 -> El Nino, while the value target rounds to 0.5
    out = label(frame(spark, [0.504, 0.504, 0.504, 0.504, 0.504]), "x", "series", "period")
    r = out.orderBy("period").collect()[0]
    assert r.enso_t1 == EN and abs(r.nino34_t1 - 0.5) < 1e-12


def test_nan_becomes_null(spark):
    from panelcast.operators.panel import coerce_numeric
    df = frame(spark, [0.1, 0.2, 0.3]).withColumn(
        "x", F.when(F.col("period") == dt.date(1990, 2, 1), F.lit(float("nan"))).otherwise(F.col("x")))
    assert rows(coerce_numeric(df), "x") == [0.1, None, 0.3]
