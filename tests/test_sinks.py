"""Sinks: parquet partitioned by split round trip, CSV dictionary, JSON metrics and their merge."""
import datetime as dt
import json
import os

from panelcast.operators import evaluate, export
from panelcast.sources import sinks


def test_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s", dt.date(2000, m, 1), float(m), "train" if m < 6 else "test") for m in range(1, 13)],
                               "series string, period date, x double, split string")
    p = str(tmp_path / "export")
    sinks.write_parquet(df, p, partition_by=["split"], sort_within=["series", "period"])
    assert sorted(x for x in os.listdir(p) if x.startswith("split=")) == ["split=test", "split=train"]
    back = spark.read.parquet(p)
    assert back.count() == 12 and back.filter("split = 'train'").count() == 5


def test_csv_dictionary(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None), (None, "a")], "x double, y string")
    dd = export.data_dictionary(df, {"x": "the x"})
    p = str(tmp_path / "dd")
    sinks.write_csv(dd, p, single_file=True)
    back = {r["column"]: r for r in spark.read.option("header", True).csv(p).collect()}
    assert back["x"].n_missing == "1" and back["x"].description == "the x" and back["y"].dtype == "string"


def test_json_metrics_and_merge(spark, tmp_path):
    d = tmp_path / "metrics"
    d.mkdir()
    (d / "a_run1.json").write_text(json.dumps([{"target": "enso_t1", "model": "m", "f1_macro": 0.5},
                                               {"target": "enso_t3", "model": "m", "f1_macro": 0.4}]))
    (d / "b_run2.json").write_text(json.dumps([{"target": "enso_t1", "model": "m", "f1_macro": 0.9}]))
    got = {r.target: r.f1_macro for r in sinks.read_metrics(spark, str(d), arrays=True).collect()}
    assert got == {"enso_t1": 0.9, "enso_t3": 0.4}


def test_metrics_round_trip_with_several_part_files(spark, tmp_path):
    rows = [(f"t{i % 3}", f"m{i}", float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "target string, model string, f1_macro double")
    sinks.write_json(df.repartition(3), str(tmp_path / "metrics" / "run1"))
    assert sinks.read_metrics(spark, str(tmp_path / "metrics")).count() == 12
    sinks.write_json(df.filter("target = 't1'").repartition(2), str(tmp_path / "metrics" / "run2"))
    got = sinks.read_metrics(spark, str(tmp_path / "metrics"))
    assert sorted(map(tuple, got.select("target", "model", "f1_macro").collect())) == sorted(rows)
    sinks.write_json(df.filter("model = 'm0'"), str(tmp_path / "metrics" / "run3"))
    assert sinks.read_metrics(spark, str(tmp_path / "metrics")).filter("target = 't0'").count() == 1


def test_json_sink_nested(spark, tmp_path):
    rows = [("t", "m", "La Niña", "La Niña")] * 3 + [("t", "m", "Neutral", "La Niña")]
    pred = spark.createDataFrame(rows, "target string, model string, y_true string, y_pred string")
    m = evaluate.classification_metrics(pred, with_matrix=True)
    p = str(tmp_path / "json")
    sinks.write_json(m, p)
    back = spark.read.json(p).collect()[0]
    assert back.confusion_matrix[0][0] == 3 and back.confusion_matrix[1][0] == 1


def test_export_bundle(spark, tmp_path):
    from panelcast.plans import pipelines as PL
    ds = PL.build_dataset(spark, "/root/testdata/sf0.001")
    ex = export.export_frame(ds, "period", "2000-01", PL.TARGETS, drop=["revenue", "n_orders"],
                             renames={"anom": "revenue_anom"})
    p = str(tmp_path / "bundle")
    export.write_bundle(ex, p, "period", n_features=20)
    data = spark.read.parquet(p + "/data")
    assert data.count() == ex.count() and {r.split for r in data.select("split").distinct().collect()} == {"train", "test"}
    assert "revenue" not in data.columns and "revenue_anom_lag1" in data.columns and "enso_t1_int" in data.columns
    dd = spark.read.option("header", True).csv(p + "/data_dictionary")
    assert dd.count() == len(ex.columns) - 1
    meta = spark.read.json(p + "/metadata").collect()[0]
    assert meta.n_train + meta.n_test == ex.count() and meta.label_map["Neutral"] == 1
    from panelcast.operators import splits
    assert splits.train(ex).count() == meta.n_train and splits.test(ex).count() == meta.n_test
