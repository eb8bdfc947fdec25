"""Invariants: halo buckets equal the global window; union-merge equals chained full outer
joins; window grid equals calendar-spine reindex; limited fill equals pandas; whole-gap fill."""
import datetime as dt

import numpy as np
import pandas as pd

from panelcast.operators import features, labels, panel
from panelcast.operators.halo import with_halo
from test_labels import months


def long_series(spark, n=600, gaps=True):
    rng = np.random.default_rng(7)
    vals = rng.normal(0, 1, n)
    if gaps:
        vals[rng.choice(n, 40, replace=False)] = np.nan
    rows = [(s, d, None if np.isnan(v) else float(v)) for s in ("a", "b") for d, v in zip(months(n, (1900, 1)), vals)]
    return spark.createDataFrame(rows, "series string, period date, x double")


def _labels_and_lags(df, keys):
    f = panel.ffill(df, ["x"], keys, "period", limit=3)
    lab = labels.label(f, "x", keys, "period")
    return features.build_features(lab, ["x"], keys, "period", lags=(1, 6), mean=(3,), std=(3,), diff=(1,), calendar=False)


def test_halo_equals_global(spark):
    df = long_series(spark)
    glob = _labels_and_lags(df, ["series"]).toPandas().sort_values(["series", "period"]).reset_index(drop=True)
    # chained reach back: fill 3 + smoothing 2 + lag 6 -> 11; ahead: lead 6 of a 2-back smooth -> 6
    halo = with_halo(df, "series", "period", _labels_and_lags, reach_back=11, reach_ahead=6, bucket=24)
    halo = halo.toPandas().sort_values(["series", "period"]).reset_index(drop=True)
    assert len(halo) == len(glob)
    pd.testing.assert_frame_equal(glob[sorted(glob.columns)], halo[sorted(glob.columns)], check_exact=False, rtol=1e-12)


def test_union_merge_equals_full_outer(spark):
    a = spark.createDataFrame([("s", dt.date(2000, m, 1), float(m)) for m in (1, 2, 3)], "series string, period date, a double")
    b = spark.createDataFrame([("s", dt.date(2000, m, 1), float(m)) for m in (2, 3, 4)], "series string, period date, b double")
    c = spark.createDataFrame([("t", dt.date(2000, 1, 1), 9.0)], "series string, period date, c double")
    u = panel.merge_sources([a, b, c], ["series", "period"])
    j = panel.merge_sources_join([a, b, c], ["series", "period"])
    cols = ["series", "period", "a", "b", "c"]
    assert sorted(map(tuple, u.select(cols).collect())) == sorted(map(tuple, j.select(cols).collect()))


def test_grid_equals_reindex(spark):
    rows = [("s", dt.date(2000, 1, 1), 1.0), ("s", dt.date(2000, 5, 1), 5.0), ("s", dt.date(2000, 6, 1), 6.0),
            ("t", dt.date(1999, 12, 1), 2.0), ("u", dt.date(2001, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "series string, period date, x double")
    g = panel.regular_grid(df, "series", "period").drop("is_inserted")
    r = panel.reindex(df, "series", "period")
    assert sorted(map(tuple, g.collect())) == sorted(map(tuple, r.select(g.columns).collect()))
    assert g.count() == 8


def test_hourly_and_daily_grid(spark):
    ts = [dt.datetime(2024, 1, 1, h) for h in (0, 3, 4)]
    df = spark.createDataFrame([("u", t, 1.0) for t in ts], "series string, period timestamp, x double")
    g = panel.regular_grid(df, "series", "period", "hour").orderBy("period").collect()
    assert [r.period.hour for r in g] == [0, 1, 2, 3, 4] and [r.is_inserted for r in g] == [False, True, True, False, False]
    d = spark.createDataFrame([("e", dt.date(2024, 1, 1), 1.0), ("e", dt.date(2024, 1, 4), 1.0)], "series string, period date, x double")
    assert panel.regular_grid(d, "series", "period", "day").count() == 4


def test_limited_fill_matches_pandas(spark):
    vals = [1.0, None, None, None, None, None, None, None, 2.0, None, 3.0, None, None]
    df = spark.createDataFrame([("s", d, v) for d, v in zip(months(len(vals)), vals)], "series string, period date, x double")
    got = [r.x for r in panel.ffill(df, ["x"], "series", "period", limit=3).orderBy("period").collect()]
    exp = pd.Series(vals, dtype="float64").ffill(limit=3).tolist()
    assert [None if pd.isna(e) else e for e in exp] == got
    whole = [r.x for r in panel.ffill(df, ["x"], "series", "period", limit=3, whole_gap_only=True).orderBy("period").collect()]
    assert whole == [1.0, None, None, None, None, None, None, None, 2.0, 2.0, 3.0, 3.0, 3.0]
    unb = [r.x for r in panel.ffill(df, ["x"], "series", "period").orderBy("period").collect()]
    assert unb == pd.Series(vals, dtype="float64").ffill().tolist()


def test_clean_pipeline(spark):
    rows = [("s", dt.datetime(1979, 12, 5), "1.0"), ("s", dt.datetime(1980, 1, 15), "2.0"),
            ("s", dt.datetime(1980, 4, 2), "bad"), ("s", dt.datetime(1980, 9, 9), "4.0")]
    df = spark.createDataFrame(rows, "series string, period timestamp, x string")
    out = panel.clean(df, "series", "period", start="1980-01", max_gap=3).orderBy("period").collect()
    assert [r.period for r in out][0] == dt.date(1980, 1, 1) and len(out) == 9
    assert [r.x for r in out] == [2.0, 2.0, 2.0, 2.0, None, None, None, None, 4.0]


def test_padded_range(spark):
    df = long_series(spark, 120, gaps=False)
    full = features.build_features(df, ["x"], "series", "period", calendar=False)
    trimmed = panel.padded_range(df, "period", "1905-01", "1906-12", 6, 0,
                                 lambda d: features.build_features(d, ["x"], "series", "period", calendar=False))
    want = panel.filter_time_range(full, "period", "1905-01", "1906-12")
    assert sorted(map(tuple, trimmed.collect())) == sorted(map(tuple, want.select(trimmed.columns).collect()))


def test_bucketed_grid_equals_grid(spark):
    rows = [("s", dt.date(2000, 1, 1), 1.0), ("s", dt.date(2000, 2, 1), 2.0), ("s", dt.date(2003, 7, 1), 3.0),
            ("s", dt.date(2003, 8, 1), 4.0), ("t", dt.date(1999, 11, 1), 5.0), ("t", dt.date(2001, 1, 1), 6.0),
            ("u", dt.date(2002, 2, 1), 7.0)]
    df = spark.createDataFrame(rows, "series string, period date, x double")
    a = panel.regular_grid(df, "series", "period")
    for b in (1, 5, 12):
        g = panel.regular_grid_bucketed(df, "series", "period", b)
        assert sorted(map(tuple, g.collect())) == sorted(map(tuple, a.select(g.columns).collect()))
    ts = [dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 2, 5)]
    h = spark.createDataFrame([("u", t, 1.0) for t in ts], "series string, period timestamp_ntz, x double")
    assert panel.regular_grid_bucketed(h, "series", "period", 6, "hour").count() == 30


def test_standardize_by_join(spark):
    df = long_series(spark, 60)
    a = panel.standardize(df, ["x"], "series").orderBy("series", "period").collect()
    b = panel.standardize_by_join(df, ["x"], "series").orderBy("series", "period").collect()
    for r, s in zip(a, b):
        assert (r.x is None and s.x is None) or abs(r.x - s.x) < 1e-12


def test_outlier_date_guard(spark):
    import pytest
    rows = [("s", dt.date(2000, 1, 1), 1.0), ("s", dt.date(2000, 3, 1), 2.0), ("s", dt.date(2999, 1, 1), 3.0)]
    df = spark.createDataFrame(rows, "series string, period date, x double")
    assert panel.regular_grid(df.limit(2), "series", "period", max_gap_periods=24).count() == 3
    with pytest.raises(Exception, match="outlier"):
        panel.regular_grid(df, "series", "period", max_gap_periods=24).count()


def test_ffill_bucketed_equals_unbounded(spark):
    df = long_series(spark, 300)
    a = panel.ffill(df, ["x"], "series", "period").orderBy("series", "period").collect()
    for b in (1, 7, 40):
        got = panel.ffill_bucketed(df, ["x"], "series", "period", b).orderBy("series", "period").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in a]


def test_correlation_fast_path(spark):
    from panelcast.operators import analysis
    rng = np.random.default_rng(11)
    a = rng.normal(0, 1, 200)
    rows = [(float(x), float(2 * x + rng.normal()), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    slow = {(r.col_a, r.col_b): r.corr for r in analysis.correlation_matrix(df, ["a", "b", "c"]).collect()}
    fast = {(r.col_a, r.col_b): r.corr for r in analysis.correlation_matrix(df, ["a", "b", "c"], complete_rows=True).collect()}
    assert slow.keys() == fast.keys() and all(abs(slow[k] - fast[k]) < 1e-9 for k in slow)


def test_correlations_with_gaps_by_masks(spark):
    """Masked Gram matrices against pandas' pairwise-complete correlations: gaps, a far-off mean, a constant, a column without values."""
    from panelcast.operators import analysis
    rng = np.random.default_rng(3)
    n = 300
    base = rng.normal(0, 1, n)
    pdf = pd.DataFrame({"a": base, "b": 1e6 + base + rng.normal(0, 1, n), "c": -base * 1e-3 + rng.normal(0, 1e-3, n),
                        "same": np.full(n, 0.1), "none": np.full(n, np.nan)})
    for i, c in enumerate(["a", "b", "c"]):
        pdf.loc[rng.random(n) < 0.2 + 0.2 * i, c] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double, none double")
    got = {(r.col_a, r.col_b): r.corr for r in analysis.masked_correlations(df, list(pdf.columns)).collect()}
    assert len(got) == 15
    want = pdf.corr(min_periods=2)
    for (a, b), v in got.items():
        if {"same", "none"} & {a, b}:
            assert v is None
        else:
            assert abs(v - want.loc[a, b]) < 1e-9, (a, b)
    empty = analysis.masked_correlations(df.limit(0), ["a", "b"]).collect()
    assert [r.corr for r in empty] == [None, None, None]
