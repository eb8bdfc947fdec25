"""Leakage cases: lag0 / lag-1 names, a future value under an innocent name, disordered and
duplicated keys, a target copied into the features, and a broken target shift."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from panelcast.operators import quality
from panelcast.operators.features import build_features
from panelcast.operators.labels import label
from panelcast.plans import pipelines as PL
from test_labels import months


def frame(spark, n=50):
    rng = np.random.default_rng(3)
    rows = [("s", d, float(v)) for d, v in zip(months(n), rng.normal(0, 1, n))]
    return spark.createDataFrame(rows, "series string, period date, x double")


def test_future_lag_names():
    assert quality.future_lag_names(["x_lag1", "x_lag0", "x_lag-1", "y", "x_lag12"]) == ["x_lag0", "x_lag-1"]


def test_value_scan_finds_future_copy(spark):
    from pyspark.sql import Window
    w = Window.partitionBy("series").orderBy("period")
    df = build_features(frame(spark), ["x"], "series", "period").withColumn("x_trend", F.lead("x", 2).over(w))
    res = {(r.feature, r.k): (r.n_compared, r.n_equal) for r in
           quality.value_leak_scan(df, {"x": ["x_lag1", "x_trend", "x_rm3"]}, "series", "period", 3).collect()}
    n, e = res[("x_trend", 2)]
    assert n > 0 and n == e                     # equals lead(x, 2) on every row: a leak
    assert res[("x_lag1", 1)][1] == 0           # a true lag never equals a future value


def test_key_check_duplicates_and_gaps(spark):
    rows = [("s", dt.date(2000, 1, 1), 1.0), ("s", dt.date(2000, 1, 1), 2.0), ("s", dt.date(2000, 4, 1), 3.0)]
    df = spark.createDataFrame(rows, "series string, period date, x double")
    r = quality.key_check(df, "series", "period").collect()[0]
    assert (r.n_rows, r.n_periods, r.n_duplicates, r.n_missing_periods) == (3, 2, 1, 2)


def test_input_order_shuffled(spark):
    rows = [(i, d) for i, d in enumerate(months(10))]
    rows[3], rows[7] = (3, rows[7][1]), (7, rows[3][1])
    df = spark.createDataFrame([("s", i, d) for i, d in rows], "series string, line long, period date")
    r = quality.input_order_check(df, ["series"], "line", "period").collect()[0]
    assert r.n_out_of_order > 0


def test_target_copy_detected(spark):
    df = label(frame(spark), "x", "series", "period")
    df = df.withColumn("sneaky", F.col("nino34_t1")).withColumn("fine", F.col("x"))
    res = {r.feature: r for r in quality.target_copy_scan(df, ["sneaky", "fine"], ["nino34_t1"]).collect()}
    assert res["sneaky"].n_compared > 0 and res["sneaky"].n_mismatch == 0
    assert res["fine"].n_mismatch > 0


def test_target_shift(spark):
    df = label(frame(spark), "x", "series", "period")
    ok = quality.target_shift_check(df, "series", "period").collect()
    assert all(r.n_mismatch == 0 and r.n_checked > 0 for r in ok)
    from pyspark.sql import Window
    bad = df.withColumn("enso_t1", F.lag("enso_t1", 1).over(Window.partitionBy("series").orderBy("period")))
    assert any(r.n_mismatch > 0 for r in quality.target_shift_check(bad, "series", "period", horizons=(1,)).collect())


def test_lag_alignment(spark):
    df = build_features(frame(spark), ["x"], "series", "period")
    assert all(r.n_mismatch == 0 for r in quality.lag_alignment(df, "x", "series", "period").collect())
    bad = df.withColumn("x_lag3", F.col("x_lag1"))
    res = {r.lag: r.n_mismatch for r in quality.lag_alignment(bad, "x", "series", "period").collect()}
    assert res[3] > 0 and res[1] == 0


def test_leakage_report_gate(spark):
    df = build_features(label(frame(spark), "x", "series", "period"), ["x"], "series", "period")
    feats = [c for c in df.columns if c.startswith("x_") or c.startswith("month")]
    targets = ["enso_phase", "enso_t1", "enso_t3", "enso_t6", "nino34_t1", "nino34_t3", "nino34_t6"]
    rep = quality.leakage_report(df, "series", "period", feats, targets, lag_bases=["x"])
    assert all(r.passed for r in rep.collect())
    quality.assert_passed(rep)
    bad = df.withColumn("x_lag0", F.col("x")).withColumn("copy", F.col("nino34_t3"))
    rep2 = {r.check: r.passed for r in quality.leakage_report(bad, "series", "period", feats + ["x_lag0", "copy", "enso_t1"],
                                                              targets, lag_bases=["x"]).collect()}
    assert not rep2["no_future_lags"] and not rep2["no_targets_in_features"] and not rep2["no_target_copies"]


def test_report_on_fixture(spark):
    df = PL.build_dataset(spark, "/root/testdata/sf0.001")
    feats = [c for c in df.columns if c.startswith(("anom_", "orders_", "month"))]
    rep = {r.check: r for r in quality.leakage_report(df, PL.SERIES_A, "period", feats,
                                                      ["enso_phase", *PL.TARGETS, *PL.VALUE_TARGETS],
                                                      lag_bases=["anom", "orders"]).collect()}
    assert rep["key_unique"].passed and rep["grid_gapless"].passed and rep["target_shift_correct"].passed
    assert rep["lag_alignment_anom"].passed and rep["no_target_copies"].passed


def test_gate_refuses_gapped_panel(spark):
    import pytest
    df = frame(spark).filter(~F.col("period").isin(months(50)[10], months(50)[11]))   # two absent months
    ds = build_features(label(df, "x", "series", "period"), ["x"], "series", "period")
    rep = {r.check: r for r in quality.leakage_report(ds, "series", "period", ["x_lag1"], ["enso_t1"]).collect()}
    assert not rep["grid_gapless"].passed and rep["grid_gapless"].n_bad == 2
    with pytest.raises(AssertionError, match="grid_gapless"):
        quality.assert_passed(quality.leakage_report(ds, "series", "period", ["x_lag1"], ["enso_t1"]))


def test_gate_finds_leaks_by_value(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from panelcast.plans import pipelines as PL
    ds = PL.build_dataset(spark, "/root/testdata/sf0.001")
    w = Window.partitionBy("nation", "segment").orderBy("period")
    planted = ds.withColumn("calm_name", F.lead("anom", 1).over(w)).withColumn("label_copy", F.col("enso_t1"))
    rep = {r["check"]: r for r in quality.leakage_report(planted, ["nation", "segment"], "period", ["anom_lag1", "calm_name", "label_copy"],
                                                         ["enso_t1", "enso_t3"], lag_bases=["anom"]).collect()}
    assert not rep["no_future_lags"].passed and rep["no_future_lags"].detail == "calm_name"
    assert not rep["no_target_copies"].passed and rep["no_target_copies"].detail == "label_copy"
    clean = {r["check"]: r.passed for r in quality.leakage_report(ds, ["nation", "segment"], "period", ["anom_lag1"], ["enso_t1"], lag_bases=["anom"]).collect()}
    assert clean["no_future_lags"] and clean["no_target_copies"]


def test_file_order_across_blocks_and_files(spark, tmp_path):
    """Disorder inside a block, at the edge of a block and at the edge of a file; other series and rows without time do not count."""
    d = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    one = [("a", d(0)), ("b", d(9)), ("a", d(2)), ("a", d(1)),      # late inside the block
           ("a", d(0)), ("b", d(10)), ("b", None), ("b", d(3)),     # a is late at the edge; b follows a row without time
           ("a", d(5)), ("b", d(4)), (None, d(7)), ("b", d(11))]
    two = [("b", d(6)), ("a", d(5)), (None, d(6)), ("a", d(8))]     # b and the series without a name are late at the edge of the file
    for name, rows in (("x1", one), ("x2", two)):
        spark.createDataFrame(rows, "series string, period date").coalesce(1).write.parquet(str(tmp_path / name))
    import glob
    import shutil
    (tmp_path / "all").mkdir()
    for name in ("x1", "x2"):
        shutil.copy(glob.glob(str(tmp_path / name / "*.parquet"))[0], tmp_path / "all" / f"{name}.parquet")
    for block_rows in (1, 4, 5, 100):
        got = {r.file: (r.n_rows, r.n_out_of_order) for r in
               quality.file_order_check(spark, str(tmp_path / "all"), ["series"], "period", block_rows).collect()}
        assert got == {"x1.parquet": (12, 2), "x2.parquet": (4, 2)}, block_rows
