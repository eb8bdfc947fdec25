"""End-to-end entry points on the smallest tables: build (with the leakage gate) -> train and
evaluate -> export bundle, each writing its outputs."""
from pyspark.sql import functions as F

from panelcast.operators import models, panel
from panelcast.plans import pipelines as PL
from panelcast.sources import tables


def test_build_train_export(spark, tmp_path):
    p = tables.panel_a(spark, "/root/testdata/sf0.001")
    p = panel.standardize(p.withColumn("anom", F.col("revenue")), ["anom"], PL.SERIES_A)
    ds_path, out = str(tmp_path / "dataset"), str(tmp_path / "out")
    ds = PL.run_build(p.select(*PL.SERIES_A, "period", "anom"), PL.SERIES_A, "period", "anom", ds_path)
    assert {"anom_lag1", "enso_t3", "nino34_t6", "crosses_spring_t6"} <= set(ds.columns)
    assert spark.read.parquet(ds_path).count() == ds.count()
    m = PL.run_training(spark, ds_path, PL.SERIES_A, "period", out, "1998-12", "2000-01", "1999-01", "1999-12",
                        kinds=("logistic", "boosted"), params={"boosted": {"n_estimators": 3}})
    got = {(r.target, r.model) for r in m.collect()}
    assert {("enso_t1", "logistic"), ("enso_t1", "persistence"), ("enso_t6", "climatology")} <= got
    assert spark.read.json(out + "/metrics").count() == len(got)
    reg = {(r.target, r.model): r for r in spark.read.json(out + "/regression_metrics").collect()}
    assert {t for t, _ in reg} == {"nino34_t1", "nino34_t3", "nino34_t6"} and len(reg) == 6
    assert all(r.skill == 0 for (_, m), r in reg.items() if m == "persistence")
    assert spark.read.json(out + "/beats_baseline").count() == 3
    for path in ("enso_t3/logistic", "enso_t3/boosted", "nino34_t6/boosted_value"):
        assert models.load_model(f"{out}/models/{path}") is not None
    ex = PL.run_export(spark, ds_path, "period", out + "/bundle", "2000-01", drop=["is_inserted"])
    assert spark.read.parquet(out + "/bundle/data").count() == ex.count()
    assert spark.read.json(out + "/bundle/metadata").collect()[0].n_features > 10


def test_routed_by_length_planted_long_series(spark):
    """One long series among short ones, one of them without a key: each goes its way, and no row differs from the plain path."""
    import datetime as dt

    from pyspark.sql import functions as F

    from panelcast.operators import halo, panel
    day = lambda m: dt.date(1900 + m // 12, m % 12 + 1, 1)
    rows = [("long", day(m), float(m % 17)) for m in range(0, 900) if m % 5] + [
        (s, day(m), float(m)) for s in ("s1", "s2", None) for m in range(20) if m % 3]
    rows += [(None, day(500), 1.0)]                                     # the series without a key is long too
    df = spark.createDataFrame(rows, "series string, period date, x double")
    seen = {}

    def plain(p):
        seen["plain"] = sorted(str(r[0]) for r in p.select("series").distinct().collect())
        return panel.ffill(panel.regular_grid(p, ["series"], "period", "month"), ["x"], ["series"], "period", limit=3).select("series", "period", "x")

    def bucketed(p):
        seen["bucketed"] = sorted(str(r[0]) for r in p.select("series").distinct().collect())
        g = panel.regular_grid_bucketed(p, ["series"], "period", 24, "month")
        return halo.with_halo(g, ["series"], "period", lambda d, k: panel.ffill(d, ["x"], k, "period", limit=3), 3, 0, 24).select("series", "period", "x")

    got = halo.route_by_length(df, ["series"], "period", plain, bucketed, max_periods=100)
    key = lambda r: (str(r.series), r.period, r.x is None, r.x or 0.0)
    routed = sorted(map(key, got.collect()))
    assert seen == {"plain": ["s1", "s2"], "bucketed": ["None", "long"]}
    assert routed == sorted(map(key, plain(df).collect()))
    none_long = halo.route_by_length(df, ["series"], "period", plain, bucketed, max_periods=10_000)
    assert sorted(map(key, none_long.collect())) == routed
    assert got.filter(F.col("series") == "long").count() == 899
