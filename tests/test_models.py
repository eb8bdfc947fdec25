"""Models: logistic regression beats climatology on a planted signal, boosted one-vs-rest gives
normalised probabilities, exact linear attribution, save/load round trip, class weights."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS
from panelcast.operators import baselines, evaluate, models


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    n = 600
    x1, x2 = rng.normal(0, 1, n), rng.normal(0, 1, n)
    y = np.where(x1 > 0.6, LABELS[2], np.where(x1 < -0.6, LABELS[0], LABELS[1]))
    split = np.where(np.arange(n) < 450, "train", "test")
    rows = [(int(i), float(a), float(b), str(c), str(s)) for i, a, b, c, s in zip(range(n), x1, x2, y, split)]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, y string, split string")


def test_logistic_beats_climatology(planted):
    train, test = planted.filter("split = 'train'"), planted.filter("split = 'test'")
    m = models.fit_classifier(train, ["x1", "x2"], "y", "logistic")
    pred = m.transform(test).select(F.lit("y").alias("target"), F.lit("logistic").alias("model"),
                                    F.col("y").alias("y_true"), "y_pred")
    clim = baselines.climatology(train.select(F.lit("y").alias("target"), F.col("y").alias("y_true")),
                                 test.select(F.lit("y").alias("target"), F.col("y").alias("y_true")))
    got = {r.model: r.f1_macro for r in evaluate.classification_metrics(pred.unionByName(clim.select(pred.columns))).collect()}
    assert got["logistic"] > 0.8 > got["climatology"]
    p = models.class_probabilities(m, test, LABELS)
    s = p.select((F.col("p_la_nina") + F.col("p_neutral") + F.col("p_el_nino")).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in s)


def test_boosted_one_vs_rest(planted):
    train, test = planted.filter("split = 'train'"), planted.filter("split = 'test'")
    m = models.fit_classifier(train, ["x1", "x2"], "y", "boosted", {"n_estimators": 10})
    p = models.class_probabilities(m, test, LABELS).collect()
    assert all(abs(r.p_la_nina + r.p_neutral + r.p_el_nino - 1) < 1e-9 for r in p)
    assert sum(r.y_pred == r.y for r in p) / len(p) > 0.8


def test_forest_and_importance(planted):
    m = models.fit_classifier(planted.filter("split = 'train'"), ["x1", "x2"], "y", "forest", {"n_estimators": 20})
    imp = {r.feature: r.importance for r in models.tree_importance(m, ["x1", "x2"]).collect()}
    assert imp["x1"] > imp["x2"]
    perm = {r.feature: r.importance for r in
            models.permutation_importance(m, planted.filter("split = 'test'"), ["x1", "x2"], "y", ["id"]).collect()}
    assert perm["x1"] > 0.2 and abs(perm["x2"]) < 0.1
    assert perm["x1"] > perm["x2"]


def test_linear_attribution_closed_form(spark):
    xs = [1.0, 2.0, 3.0, 6.0]
    df = spark.createDataFrame([(x, 2 * x) for x in xs], "a double, b double")
    got = {r.feature: r.importance for r in models.linear_attribution(df, {"a": 0.5, "b": -1.0}).collect()}
    mu = sum(xs) / 4
    assert abs(got["a"] - np.mean([abs(0.5 * (x - mu)) for x in xs])) < 1e-12
    assert abs(got["b"] - np.mean([abs(-1.0 * (2 * x - 2 * mu)) for x in xs])) < 1e-12


def test_save_load(planted, tmp_path):
    m = models.fit_classifier(planted.filter("split = 'train'"), ["x1", "x2"], "y", "logistic")
    models.save_model(m, str(tmp_path / "m"))
    back = models.load_model(str(tmp_path / "m"))
    a = [r.y_pred for r in m.transform(planted).orderBy("id").collect()]
    b = [r.y_pred for r in back.transform(planted).orderBy("id").collect()]
    assert a == b


def test_class_weights_and_encoding(planted):
    w = models.class_weights(planted, "y")
    per = {r.y: r.weight for r in w.select("y", "weight").distinct().collect()}
    counts = {r.y: r["count"] for r in planted.groupBy("y").count().collect()}
    for c, n in counts.items():
        assert abs(per[c] - 600 / (3 * n)) < 1e-12
    idx = models.label_index(planted, "y").fit(planted)
    assert idx.labels == sorted(LABELS)


def test_align_features(planted):
    m = models.fit_classifier(planted.filter("split = 'train'"), ["x1", "x2"], "y", "logistic")
    scored = m.transform(models.align_features(planted.select("id", "x1", "y"), ["x1", "x2"]))
    assert scored.count() == 600 and "y_pred" in scored.columns


def test_align_features_casts_and_fills(spark):
    out = models.align_features(spark.createDataFrame([(1, "a")], "x2 int, y string"), ["x1", "x2"])
    assert dict(out.dtypes) == {"x1": "double", "x2": "double", "y": "string"}


def test_weights_leave_validation_rows_out(planted):
    marked = planted.withColumn("is_val", F.col("split") == "test")
    per = {r.y: r.weight for r in models.class_weights(marked, "y", val_col="is_val").select("y", "weight").distinct().collect()}
    counts = {r.y: r["count"] for r in planted.filter("split = 'train'").groupBy("y").count().collect()}
    assert all(abs(per[c] - 450 / (3 * n)) < 1e-12 for c, n in counts.items())


def test_boosted_stops_early_and_survives_saving(planted, tmp_path):
    marked = planted.withColumn("is_val", F.col("split") == "test").withColumn("x3", F.rand(1))
    noise = marked.withColumn("x1", F.rand(2))  # nothing to learn: the validation error soon stops falling
    m = models.fit_classifier(noise, ["x1", "x3"], "y", "boosted", {"n_estimators": 40}, val_col="is_val")
    assert all(n < 40 for n in m.trees().values())
    free = models.fit_classifier(noise.filter("NOT is_val"), ["x1", "x3"], "y", "boosted", {"n_estimators": 12})
    assert all(n == 12 for n in free.trees().values())
    models.save_model(free, str(tmp_path / "b"))
    back = models.load_model(str(tmp_path / "b"))
    a, b = ([(r.y_pred, r.probs) for r in x.transform(planted.withColumn("x3", F.col("x2"))).orderBy("id").collect()] for x in (free, back))
    assert a == b and back.trees() == free.trees()


def test_dense_ids(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    out, n = models.dense_ids(df, ["id"], "k", bucket_rows=50)
    assert n == 1000 and sorted(r.k for r in out.collect()) == list(range(1000))


def test_best_round_by_hand():
    assert models.best_round([5, 4, 3, 3, 4, 2], 3) == (6, False)        # lower within three rounds
    assert models.best_round([5, 4, 3, 3, 4, 4, 2], 3) == (3, True)      # three rounds brought nothing: 2 is never seen
    assert models.best_round([1], 50) == (1, False)
    assert models.best_round([2, 2, 2], 2) == (1, True)                  # a tie is not better


def _valued(spark, n=400):
    rng = np.random.default_rng(11)
    x1, x2 = rng.normal(0, 1, n), rng.normal(0, 1, n)
    y = np.sin(2 * x1) + rng.normal(0, 0.8, n)
    rows = [(float(a), float(b), float(c), "high" if c > 0 else "low", bool(i % 4 == 0)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "x1 double, x2 double, y double, side string, is_val boolean").coalesce(1)


def test_patience_of_a_regressor_against_a_hand_run_curve(spark):
    df = _valued(spark)
    shape = {"learning_rate": 0.5, "max_depth": 3, "min_child_samples": 5}
    full = models.fit_regressor(df.filter("NOT is_val"), ["x1", "x2"], "y", {**shape, "n_estimators": 16})
    val = df.filter("is_val").collect()
    # the curve by hand: predictions of every tree added up round by round
    gbt = full.stages[-1]
    rows = full.stages[0].transform(df.filter("is_val"))
    per_tree = [np.array([r.prediction for r in t.transform(rows).select(F.col("y_pred").alias("prediction")).collect()])
                for t in gbt.trees]
    margins = np.cumsum([w * p for w, p in zip(gbt.treeWeights, per_tree)], axis=0)
    curve = [float(np.mean((m - np.array([r.y for r in val])) ** 2)) for m in margins]
    assert np.allclose(models.validation_curve(gbt, rows.withColumnRenamed("y", gbt.getLabelCol())), curve)
    patience = 4
    best, ended = models.best_round(curve, patience)
    assert ended and best < 12                                           # the data are noisy: it overfits early
    got = models.fit_regressor(df, ["x1", "x2"], "y", {**shape, "n_estimators": 16, "patience": patience}, val_col="is_val")
    assert got.stages[-1].getNumTrees == best
    pred = np.array([r.y_pred for r in got.transform(df.filter("is_val")).collect()])
    assert np.allclose(pred, margins[best - 1])


def test_patience_of_classes_and_saved_model(spark, tmp_path):
    df = _valued(spark)
    shape = {"learning_rate": 0.5, "max_depth": 2, "min_child_samples": 5, "n_estimators": 12, "patience": 3}
    m = models.fit_classifier(df, ["x1", "x2"], "side", "boosted", shape, val_col="is_val")
    for c, n in m.trees().items():
        assert n == models.best_round(m.curves[c], 3)[0]
    models.save_model(m, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert again.trees() == m.trees()
    assert [tuple(r.probs) for r in again.transform(df).collect()] == [tuple(r.probs) for r in m.transform(df).collect()]
