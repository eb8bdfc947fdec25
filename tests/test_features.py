"""Feature cases: columns exist, lag equality, targets excluded, absent base skipped, pandas parity."""
import datetime as dt
import math
import warnings

import numpy as np
import pandas as pd

from panelcast.operators.features import build_features, feature_columns, features_from_config
from panelcast.operators.labels import label, target_columns
from test_labels import months

CONFIG = {"base_variables": ["warmth", "press"],
          "transformations": {"lags": {"enabled": True, "months": [1, 3]},
                              "rolling_mean": {"enabled": True, "windows": [3]},
                              "rolling_std": {"enabled": True, "windows": [3]},
                              "diff": {"enabled": True, "periods": [1]}}}


def frame(spark, n=41, series=("s1",)):
    rows = []
    for k, s in enumerate(series):
        rows += [(s, d, math.sin(0.7 * i + k) + 0.1 * i, (i * i + 3 * k) % 11 - 5.0) for i, d in enumerate(months(n))]
    return spark.createDataFrame(rows, "series string, period date, warmth double, press double")


def test_columns_exist(spark):
    df = label(frame(spark), "warmth", "series", "period")
    out = features_from_config(df, CONFIG, "series", "period")
    for c in ["warmth_lag1", "warmth_lag3", "warmth_rm3", "warmth_rstd3", "warmth_diff1",
              "press_lag1", "month_sin", "month_cos", "month", "year", "crosses_spring_t1", "crosses_spring_t3",
              "crosses_spring_t6", "init_in_growth_phase"]:
        assert c in out.columns, c


def test_lag1_equals_shift(spark):
    out = build_features(frame(spark, series=("a", "b")), ["warmth"], "series", "period").toPandas()
    for s, g in out.groupby("series"):
        g = g.sort_values("period")
        pd.testing.assert_series_equal(g.warmth.shift(1).reset_index(drop=True),
                                       g.warmth_lag1.reset_index(drop=True), check_names=False)


def test_targets_excluded(spark):
    df = label(frame(spark), "warmth", "series", "period")
    out = build_features(df, ["warmth"], "series", "period")
    roles = target_columns()
    excl = roles["phase"] + roles["class"] + roles["value"]
    feats = feature_columns(out, excl, "series", "period")
    assert not set(feats) & set(excl)
    assert "warmth_lag1" in feats


def test_absent_base_skipped(spark):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        out = build_features(frame(spark), ["warmth", "zwnd850_anom"], "series", "period")
    assert any("zwnd850_anom" in str(x.message) for x in w)
    assert not any(c.startswith("zwnd850_anom_") for c in out.columns)


def test_rolling_matches_pandas_with_gaps(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(0, 1, 50)
    vals[[3, 4, 10, 20, 21, 22]] = np.nan
    rows = [("s", d, None if np.isnan(v) else float(v)) for d, v in zip(months(50), vals)]
    df = spark.createDataFrame(rows, "series string, period date, x double")
    out = build_features(df, ["x"], "series", "period", lags=(2,), mean=(3, 5), std=(3,), diff=(1,)).toPandas()
    out = out.sort_values("period").reset_index(drop=True)
    s = pd.Series(vals)
    for name, exp in [("x_rm3", s.rolling(3, min_periods=2).mean()), ("x_rm5", s.rolling(5, min_periods=2).mean()),
                      ("x_rstd3", s.rolling(3, min_periods=2).std()), ("x_diff1", s.diff(1)), ("x_lag2", s.shift(2))]:
        np.testing.assert_allclose(out[name].astype(float).to_numpy(), exp.to_numpy(), rtol=1e-12, atol=1e-12, equal_nan=True)


def test_barrier_months(spark):
    df = spark.createDataFrame([("s", dt.date(2000, m, 1), 0.0) for m in range(1, 13)], "series string, period date, x double")
    out = build_features(df, [], "series", "period").orderBy("period").collect()
    assert [r.month for r in out if r.crosses_spring_t1] == [2, 3, 4]
    assert [r.month for r in out if r.crosses_spring_t3] == [1, 2, 3, 4, 12]
    assert [r.month for r in out if r.crosses_spring_t6] == [1, 2, 3, 4, 9, 10, 11, 12]
    assert [r.month for r in out if r.init_in_growth_phase] == [6, 7, 8, 9, 10, 11]
