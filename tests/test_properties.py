"""Property tests on random gapped panels: the three grid builders agree, and fill / rolling /
shift agree with pandas on the gridded series."""
import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.operators import features, panel

series_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 60),
              st.one_of(st.none(), st.floats(-5, 5, allow_nan=False).map(lambda x: round(x, 3)))),
    min_size=1, max_size=40)


def _month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series_st, st.integers(1, 7))
def test_grids_agree_and_match_pandas(spark, rows, bucket):
    seen, uniq = set(), []
    for s, i, v in rows:
        if (s, i) not in seen:
            seen.add((s, i))
            uniq.append((s, _month(i), v))
    df = spark.createDataFrame(uniq, "series string, period date, x double")
    g1 = sorted(map(tuple, panel.regular_grid(df, "series", "period").collect()))
    g2 = sorted(map(tuple, panel.regular_grid_bucketed(df, "series", "period", bucket).collect()))
    g3 = sorted(map(tuple, panel.reindex(df, "series", "period").select("series", "period", "x").collect()))
    assert g1 == g2
    assert [r[:3] for r in g1] == g3
    grid = panel.regular_grid(df, "series", "period")
    out = features.build_features(panel.ffill(grid, ["x"], "series", "period", limit=2), ["x"], "series", "period",
                                  lags=(1, 2), mean=(3,), std=(3,), diff=(1,), calendar=False).toPandas()
    for s, g in out.groupby("series"):
        g = g.sort_values("period").reset_index(drop=True)
        raw = pd.Series([r[2] for r in g1 if r[0] == s], dtype="float64").ffill(limit=2)
        np.testing.assert_allclose(g.x.astype(float), raw, equal_nan=True)
        for name, exp in [("x_lag2", raw.shift(2)), ("x_rm3", raw.rolling(3, min_periods=2).mean()),
                          ("x_rstd3", raw.rolling(3, min_periods=2).std()), ("x_diff1", raw.diff())]:
            np.testing.assert_allclose(g[name].astype(float), exp, rtol=1e-9, atol=1e-9, equal_nan=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series_st)
def test_gapped_features_equal_grid_features(spark, rows):
    seen, uniq = set(), []
    for s, i, v in rows:
        if (s, i) not in seen:
            seen.add((s, i))
            uniq.append((s, _month(i), v))
    df = spark.createDataFrame(uniq, "series string, period date, x double")
    kw = dict(lags=(1, 4), mean=(3,), std=(3,), diff=(2,), calendar=False)
    grid = features.build_features(panel.regular_grid(df, "series", "period"), ["x"], "series", "period", **kw)
    want = grid.filter("NOT is_inserted").drop("is_inserted")
    got = features.build_features(df, ["x"], "series", "period", gapped="month", **kw)
    cols = sorted(got.columns)
    a = sorted(tuple(r[c] for c in cols) for r in want.collect())
    b = sorted(tuple(r[c] for c in cols) for r in got.collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or u == v or abs(u - v) < 1e-9


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-3, 3, allow_nan=False).map(lambda x: round(x, 3))), min_size=20, max_size=80),
       st.integers(11, 30))
def test_halo_equals_global_random(spark, vals, bucket):
    from panelcast.operators import labels
    from panelcast.operators.halo import with_halo
    rows = [(s, _month(i), v) for s in ("a", "b") for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "series string, period date, x double")

    def chain(d, k):
        f = panel.ffill(d, ["x"], k, "period", limit=3)
        lab = labels.label(f, "x", k, "period")
        return features.build_features(lab, ["x"], k, "period", lags=(1, 6), mean=(3,), std=(3,), diff=(1,), calendar=False)

    glob = sorted(map(tuple, chain(df, ["series"]).collect()), key=lambda r: (r[0], r[1]))
    halo = with_halo(df, "series", "period", chain, reach_back=9, reach_ahead=6, bucket=bucket)
    got = sorted(map(tuple, halo.select(*chain(df, ["series"]).columns).collect()), key=lambda r: (r[0], r[1]))
    assert len(got) == len(glob)
    for x, y in zip(glob, got):
        for u, v in zip(x, y):
            assert (u is None and v is None) or u == v or (isinstance(u, float) and abs(u - v) < 1e-9)
