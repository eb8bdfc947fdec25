"""Queries for evaluation (E), baselines and model helpers (M) over predictions of panel A."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS, label_to_int
from panelcast.operators import baselines, evaluate, models, splits
from panelcast.plans import oracle as O
from panelcast.plans import pipelines as PL
from panelcast.plans.catalog import register

K = ["nation", "segment"]
T = "period"
BY = ["target", "model"]
PRED_SQL = O.with_(*O.predictions_a_sql())
REG_SQL = O.with_(*O.regression_predictions_a_sql())
METRIC_COLS = ["accuracy", "f1_macro", "f1_la_nina", "f1_neutral", "f1_el_nino"]


def preds(spark, sf):
    return PL.predictions_a(spark, sf)


# ----------------------------------------------------------------------------- E
@register("e1_valid_pairs", sql=PRED_SQL + """SELECT nation, segment, period, target, model, y_true, y_pred FROM preds
WHERE y_true IS NOT NULL AND y_pred IS NOT NULL""")
def e1_valid_pairs(spark, sf):
    return evaluate.valid_pairs(preds(spark, sf)).select(*K, T, "target", "model", "y_true", "y_pred")


@register("e2_classification", sql=PRED_SQL + O.metrics_sql("preds", BY))
def e2_classification(spark, sf):
    return evaluate.classification_metrics(preds(spark, sf), BY)


@register("e3_compare_models", sql=PRED_SQL + O.metrics_sql("(SELECT * FROM preds WHERE target = 'enso_t3') p", ["model"]))
def e3_compare_models(spark, sf):
    return evaluate.classification_metrics(preds(spark, sf).filter(F.col("target") == "enso_t3"), ["model"])


E4_SRC = ("(SELECT * FROM (SELECT *, CASE WHEN crosses THEN 'crosses_spring' WHEN NOT crosses THEN 'no_spring_barrier' END"
          " AS stratum FROM preds) s WHERE stratum IS NOT NULL) p")
E4_DELTA = O.rint_sql("max(CASE WHEN stratum = 'no_spring_barrier' THEN f1_macro END) OVER (PARTITION BY target, model)"
                      " - max(CASE WHEN stratum = 'crosses_spring' THEN f1_macro END) OVER (PARTITION BY target, model)", 4)
E4_SQL = PRED_SQL + f"SELECT *, {E4_DELTA} AS delta_f1 FROM ({O.metrics_sql(E4_SRC, ['target', 'model', 'stratum'])}) m"


@register("e4_spring_strata", sql=E4_SQL)
def e4_spring_strata(spark, sf):
    return evaluate.by_barrier(preds(spark, sf), "crosses", BY)


E5_SQL = PRED_SQL + f"""SELECT g.target, g.model, g.month,
  CASE WHEN coalesce(m.n, 0) >= 3 THEN m.f1_macro END AS f1_macro,
  CAST(CASE WHEN coalesce(m.n, 0) >= 3 THEN coalesce(m.n, 0) ELSE 0 END AS BIGINT) AS n,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_raw
FROM (SELECT DISTINCT target, model, CAST(unnest(range(1, 13)) AS INTEGER) AS month FROM preds
      WHERE y_true IS NOT NULL AND y_pred IS NOT NULL) g
LEFT JOIN ({O.metrics_sql("(SELECT *, CAST(month(period) AS INTEGER) AS mon FROM preds) p", ["target", "model", "mon"])}) m
  ON g.target = m.target AND g.model = m.model AND g.month = m.mon"""


@register("e5_init_month", sql=E5_SQL)
def e5_init_month(spark, sf):
    return evaluate.by_init_month(preds(spark, sf), T, BY)


ALL_SRC = """(SELECT target, model, y_true, y_pred, 'all' AS part, CAST(NULL AS VARCHAR) AS stratum, CAST(NULL AS INTEGER) AS month FROM preds
UNION ALL SELECT target, model, y_true, y_pred, 'barrier', CASE WHEN crosses THEN 'crosses_spring' ELSE 'no_spring_barrier' END, NULL
  FROM preds WHERE crosses IS NOT NULL
UNION ALL SELECT target, model, y_true, y_pred, 'month', NULL, CAST(month(period) AS INTEGER) FROM preds) p"""
ALL_SQL = PRED_SQL + f"""SELECT * REPLACE (CASE WHEN part <> 'month' OR n >= 3 THEN f1_macro END AS f1_macro),
  {E4_DELTA.replace("target, model)", "target, model, part)")} AS delta_f1
FROM ({O.metrics_sql(ALL_SRC, ['target', 'model', 'part', 'stratum', 'month'])}) m"""


@register("e5_all_strata", sql=ALL_SQL)
def e5_all_strata(spark, sf):
    """Overall, by barrier and by init month (E2, E4, E5) from one aggregate of the predictions."""
    return evaluate.all_strata(preds(spark, sf), T, "crosses", BY)


@register("e6_tidy_sorted", sql=PRED_SQL + O.metrics_sql("preds", BY) + " ORDER BY target, f1_macro DESC, model")
def e6_tidy_sorted(spark, sf):
    return evaluate.order_metrics(evaluate.classification_metrics(preds(spark, sf), BY))


E7_INNER = """SELECT target, model, {rmse} AS rmse, {mae} AS mae, count(*) AS n FROM regpreds
WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1, 2""".format(
    rmse=O.rint_sql("sqrt(avg((y_pred - y_true) * (y_pred - y_true)))", 4), mae=O.rint_sql("avg(abs(y_pred - y_true))", 4))


@register("e7_regression", sql=REG_SQL + E7_INNER)
def e7_regression(spark, sf):
    return evaluate.regression_metrics(PL.regression_predictions_a(spark, sf), BY)


@register("e8_skill", sql=REG_SQL + f"""SELECT target, model, rmse, mae, n, CASE WHEN ref > 0 THEN {O.rint_sql('1 - rmse / ref', 4)} END AS skill
FROM (SELECT *, max(CASE WHEN model = 'persistence' THEN rmse END) OVER (PARTITION BY target) AS ref FROM ({E7_INNER}) r) s""")
def e8_skill(spark, sf):
    return evaluate.skill_score(evaluate.regression_metrics(PL.regression_predictions_a(spark, sf), BY))


@register("e9_beats_baseline", sql=PRED_SQL + f"""SELECT coalesce(b.target, s.target) AS target, b.model AS best_model,
  b.f1_macro AS best_f1_macro, s.baseline_f1_macro, b.f1_macro > s.baseline_f1_macro AS beats_baseline
FROM (SELECT target, model, f1_macro FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY f1_macro DESC, model) AS r
      FROM ({O.metrics_sql("preds", BY)}) m WHERE model NOT IN ('climatology')) x WHERE r = 1) b
FULL OUTER JOIN (SELECT target, max(f1_macro) AS baseline_f1_macro FROM ({O.metrics_sql("preds", BY)}) m2
      WHERE model IN ('climatology') GROUP BY 1) s ON b.target = s.target""")
def e9_beats_baseline(spark, sf):
    m = evaluate.classification_metrics(preds(spark, sf), BY)
    return evaluate.beats_baseline(m, baselines=("climatology",))


@register("e10_normalized_confusion", sql=PRED_SQL + """SELECT target, model, y_true, y_pred, n,
  n / greatest(sum(n) OVER (PARTITION BY target, model, y_true), 1) AS share
FROM (SELECT target, model, y_true, y_pred, count(*) AS n FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL
      GROUP BY 1, 2, 3, 4) c""", r6=["share"])
def e10_normalized_confusion(spark, sf):
    return evaluate.normalized_confusion(preds(spark, sf), BY)


@register("e11_lead_time", sql=PRED_SQL + f"""SELECT CAST(regexp_extract(target, 't([0-9]+)$', 1) AS INTEGER) AS lead,
  max(CASE WHEN model = 'climatology' THEN f1_macro END) AS climatology,
  max(CASE WHEN model = 'persistence' THEN f1_macro END) AS persistence
FROM ({O.metrics_sql("preds", BY)}) m GROUP BY 1""")
def e11_lead_time(spark, sf):
    m = evaluate.classification_metrics(preds(spark, sf), BY)
    return evaluate.lead_time_table(m, ["climatology", "persistence"])


@register("e12_residual_regime", sql=REG_SQL + """SELECT target, model, init_in_growth_phase,
  {me} AS mean_error, {rmse} AS rmse, count(*) AS n FROM regpreds
WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1, 2, 3""".format(
    me=O.rint_sql("avg(y_pred - y_true)", 4), rmse=O.rint_sql("sqrt(avg((y_pred - y_true) * (y_pred - y_true)))", 4)))
def e12_residual_regime(spark, sf):
    return evaluate.residual_by_regime(PL.regression_predictions_a(spark, sf), "init_in_growth_phase", BY)


@register("e13_uncertainty_band", sql=REG_SQL + f"""SELECT f.nation, f.segment, f.period, f.target, f.model, f.y_pred, r.rmse,
  f.y_pred - r.rmse AS lower, f.y_pred + r.rmse AS upper
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nation, segment, target, model ORDER BY period DESC) AS nth
  FROM regpreds) n WHERE nth = 1) f
LEFT JOIN ({E7_INNER}) r ON f.target = r.target AND f.model = r.model""", r6=["y_pred", "lower", "upper"])
def e13_uncertainty_band(spark, sf):
    from panelcast.session import materialize
    rp = materialize(PL.regression_predictions_a(spark, sf))   # read three times below
    reg = evaluate.regression_metrics(rp, BY)
    # the latest forecast of every series, target and model
    fc = rp.groupBy(*K, "target", "model").agg(F.max_by(F.struct(T, "y_pred"), T).alias("f")).select(*K, "target", "model", "f.*")
    return evaluate.uncertainty_band(fc, reg)


# ----------------------------------------------------------------------------- M (SQL-checkable)
@register("m1_label_encoding", sql=O.with_(*O.chain_a("labelled_a")) + """SELECT y AS label,
  CAST(dense_rank() OVER (ORDER BY y) - 1 AS DOUBLE) AS label_idx
FROM (SELECT DISTINCT enso_t1 AS y FROM labelled_a WHERE enso_t1 IS NOT NULL AND period <= DATE '1998-12-01') d""")
def m1_label_encoding(spark, sf):
    df = PL.labelled_a(spark, sf).filter((F.col(T) <= F.lit("1998-12-01").cast("date")) & F.col("enso_t1").isNotNull())
    d = df.select(F.col("enso_t1").alias("label")).distinct()
    return models.label_index(d, "label").fit(d).transform(d)


M2_COLS = ["anom", "orders", "anom_lag1"]


@register("m2_standard_scaling", sql=O.with_(*O.chain_a("features_a")) + "SELECT nation, segment, period, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}_scaled" for c in M2_COLS)
    + " FROM features_a WHERE period <= DATE '1998-12-01' AND " + " AND ".join(f"{c} IS NOT NULL" for c in M2_COLS),
    r6=[f"{c}_scaled" for c in M2_COLS])
def m2_standard_scaling(spark, sf):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = PL.build_dataset(spark, sf).filter(F.col(T) <= F.lit("1998-12-01").cast("date")).dropna(subset=M2_COLS)
    v = VectorAssembler(inputCols=M2_COLS, outputCol="v").transform(df)
    s = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(v).transform(v)
    arr = vector_to_array("s")
    return s.select(*K, T, *[arr[i].alias(f"{c}_scaled") for i, c in enumerate(M2_COLS)])


@register("m3_class_weights", sql=PRED_SQL + """SELECT target, y_true, n, CAST(sum(n) OVER (PARTITION BY target) AS DOUBLE)
  / (count(*) OVER (PARTITION BY target) * n) AS weight
FROM (SELECT target, y_true, count(*) AS n FROM long_a WHERE split = 'train' AND y_true IS NOT NULL GROUP BY 1, 2) c""", r6=["weight"])
def m3_class_weights(spark, sf):
    df = splits.time_split(PL.labelled_a(spark, sf), T, **PL.SPLIT_A).filter(F.col("split") == "train")
    long = baselines.long_targets(df, K, T, PL.TARGETS).filter(F.col("y_true").isNotNull())
    counts = long.groupBy("target", "y_true").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy("target")   # at most k classes per target
    return counts.select("*", (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))).alias("weight"))


@register("m11_climatology", sql=PRED_SQL + """SELECT nation, segment, period, target, y_true, y_pred FROM preds
WHERE model = 'climatology'""")
def m11_climatology(spark, sf):
    return preds(spark, sf).filter(F.col("model") == "climatology").select(*K, T, "target", "y_true", "y_pred")


@register("m12_persistence", sql=PRED_SQL + """SELECT nation, segment, period, target, y_true, y_pred FROM preds
WHERE model = 'persistence'""")
def m12_persistence(spark, sf):
    return preds(spark, sf).filter(F.col("model") == "persistence").select(*K, T, "target", "y_true", "y_pred")


@register("m13_persistence_value", sql=REG_SQL + """SELECT nation, segment, period, target, y_true, y_pred FROM regpreds
WHERE model = 'persistence'""", r6=["y_pred"])
def m13_persistence_value(spark, sf):
    rp = PL.regression_predictions_a(spark, sf)
    return rp.filter(F.col("model") == "persistence").select(*K, T, "target", "y_true", "y_pred")


ATTR_W = {"anom": 0.8, "anom_lag1": -0.3, "anom_diff1": 0.5, "orders": 0.01}


@register("m15_linear_attribution", sql=O.with_(*O.chain_a("features_a")) + " UNION ALL ".join(
    f"SELECT {O.q(c)} AS feature, avg(abs({w} * ({c} - (SELECT avg({c}) FROM features_a)))) AS importance FROM features_a"
    for c, w in ATTR_W.items()), r6=["importance"])
def m15_linear_attribution(spark, sf):
    from panelcast.session import materialize
    return models.linear_attribution(materialize(PL.build_dataset(spark, sf)), ATTR_W)  # two passes: means, contributions


@register("m17_ceiling_flag", sql=REG_SQL + """SELECT nation, segment, period, target, y_pred, y_pred > 0.85 * 1.0 AS near_ceiling
FROM regpreds WHERE model = 'persistence'""", r6=["y_pred"])
def m17_ceiling_flag(spark, sf):
    rp = PL.regression_predictions_a(spark, sf).filter(F.col("model") == "persistence").select(*K, T, "target", "y_pred")
    return models.ceiling_flag(rp, "y_pred", 1.0)


# ----------------------------------------------------------------------------- M (rows-only: fitted models)
FEATS_ML = ["anom", "anom_lag1", "anom_lag3", "anom_lag6", "anom_rm3", "anom_rstd3", "anom_diff1",
            "orders", "orders_rm3", "month_sin", "month_cos"]


def _split_features(spark, sf):
    from panelcast.session import materialize
    df = splits.time_split(PL.build_dataset(spark, sf), T, **PL.SPLIT_A)
    # every fit (and every optimiser pass inside it) reads this table: materialise it once
    return materialize(df.withColumn("is_val", F.col("split") == "val"))


def _fit_predict(spark, sf, kinds, targets=PL.TARGETS):
    """(materialised table, fitted models, long predictions of the test rows) for ``kinds`` and all targets."""
    df = _split_features(spark, sf)
    fitted = models.fit_classifiers(df, FEATS_ML, targets, kinds)
    return df, fitted, models.train_and_evaluate(df, K, T, FEATS_ML, targets, kinds, fitted=fitted)


def _metrics_of(spark, sf, kind):
    return evaluate.classification_metrics(_fit_predict(spark, sf, [kind])[2].filter(F.col("model") == kind), BY)


def _probabilities(df, fitted):
    """(series, period, target, model, y_true, y_pred, p_...) of the test rows for every fitted classifier."""
    out = []
    for (t, kind), m in fitted.items():
        p = models.class_probabilities(m, models.fill_test_features(
            df.filter((F.col("split") == "test") & F.col(t).isNotNull()), FEATS_ML, K, T), LABELS)
        out.append(p.select(*K, T, F.lit(t).alias("target"), F.lit(kind).alias("model"), F.col(t).alias("y_true"), "y_pred",
                            *[c if c in p.columns else F.lit(0.0).alias(c) for c in P_COLS]))
    return models._union(out)


P_COLS = ["p_la_nina", "p_neutral", "p_el_nino"]


@register("m4_logistic")
def m4_logistic(spark, sf):
    return _metrics_of(spark, sf, "logistic")


@register("m5_forest")
def m5_forest(spark, sf):
    return _metrics_of(spark, sf, "forest")


@register("m6_boosted_ovr")
def m6_boosted_ovr(spark, sf):
    df = _split_features(spark, sf)
    return _probabilities(df, models.fit_classifiers(df, FEATS_ML, PL.TARGETS, ["boosted"])).drop("model")


@register("m7_boosted_regressor")
def m7_boosted_regressor(spark, sf):
    df = _split_features(spark, sf)
    return evaluate.skill_score(evaluate.regression_metrics(
        models.train_and_evaluate_values(df, K, T, FEATS_ML, PL.VALUE_TARGETS, "anom"), BY))


@register("m7_patience")
def m7_patience(spark, sf):
    """The value regressors stopped after 10 rounds without a lower validation error, cut to their best round (quarter the rounds of
    :data:`models.PATIENCE` at four times the learning rate, since every round is some jobs)."""
    df = _split_features(spark, sf)
    fitted = models.fit_regressors(df, FEATS_ML, PL.VALUE_TARGETS, params={"patience": 10, "learning_rate": 0.2})
    scores = evaluate.skill_score(evaluate.regression_metrics(
        models.train_and_evaluate_values(df, K, T, FEATS_ML, PL.VALUE_TARGETS, "anom", fitted=fitted), BY))
    rounds = F.create_map(*[x for t, m in fitted.items() for x in (F.lit(t), F.lit(m.stages[-1].getNumTrees))])
    return scores.select("*", F.when(F.col("model") == "boosted", rounds[F.col("target")]).alias("n_rounds"))


@register("m9_class_probabilities")
def m9_class_probabilities(spark, sf):
    df = _split_features(spark, sf)
    return _probabilities(df, models.fit_classifiers(df, FEATS_ML, PL.TARGETS, ["logistic"])).drop("model", "y_true")


@register("m9_probability_rules", sql=PRED_SQL + """SELECT target, model, count(*) AS n, count(*) AS n_known, count(*) AS n_sum_one,
  count(*) AS n_largest FROM long_a, (SELECT unnest(['logistic', 'forest', 'boosted']) AS model) k
WHERE split = 'test' AND y_true IS NOT NULL GROUP BY 1, 2""")
def m9_probability_rules(spark, sf):
    """Every test row with a target is scored once by every model; its class is a known one and the one of the
    largest probability; the probabilities add up to 1."""
    df = _split_features(spark, sf)
    p = _probabilities(df, models.fit_classifiers(df, FEATS_ML, PL.TARGETS))
    own = F.element_at(F.create_map(*[x for c, l in zip(P_COLS, LABELS) for x in (F.lit(l), F.col(c))]), F.col("y_pred"))
    return p.groupBy("target", "model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y_pred").isin(list(LABELS))).alias("n_known"),
        F.count_if(F.abs(sum((F.col(c) for c in P_COLS), F.lit(0.0)) - 1) < 1e-9).alias("n_sum_one"),
        F.count_if(own == F.greatest(*P_COLS)).alias("n_largest"))


@register("m10_saved_models", sql=PRED_SQL + """SELECT target, model, count(*) AS n, count(*) AS n_equal
FROM long_a, (SELECT unnest(['logistic', 'forest']) AS model) k
WHERE split = 'test' AND y_true IS NOT NULL GROUP BY 1, 2""")
def m10_saved_models(spark, sf):
    """Predictions before save and after load, the columns of the scored rows turned round in between."""
    import uuid

    from panelcast.session import checkpoint_dir
    df, fitted, before = _fit_predict(spark, sf, ["logistic", "forest"])
    folder = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    back = {}
    for i, (k, m) in enumerate(fitted.items()):
        models.save_model(m, f"{folder}/{i}")
        back[k] = models.load_model(f"{folder}/{i}")
    turned = df.select(*reversed(df.columns))
    after = models.train_and_evaluate(turned, K, T, FEATS_ML, PL.TARGETS, ["logistic", "forest"], fitted=back)
    key = [*K, T, "target", "model"]
    both = before.select(*key, "y_pred").join(after.select(*key, F.col("y_pred").alias("again")), key)
    return both.filter(F.col("model").isin("logistic", "forest")).groupBy("target", "model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y_pred") == F.col("again")).alias("n_equal"))


@register("m14_train_evaluate")
def m14_train_evaluate(spark, sf):
    return evaluate.order_metrics(evaluate.classification_metrics(_fit_predict(spark, sf, models.KINDS)[2], BY))


@register("m15_tree_importance")
def m15_tree_importance(spark, sf):
    fitted = models.fit_classifiers(_split_features(spark, sf), FEATS_ML, PL.TARGETS, ["forest"])
    return models._union([models.tree_importance(m, FEATS_ML).withColumn("target", F.lit(t)) for (t, _), m in fitted.items()])


@register("m15_permutation_importance")
def m15_permutation_importance(spark, sf):
    df = _split_features(spark, sf)
    out = []
    for (t, _), m in models.fit_classifiers(df, FEATS_ML, PL.TARGETS, ["forest"]).items():
        test = models.fill_test_features(df.filter((F.col("split") == "test") & F.col(t).isNotNull()), FEATS_ML, K, T)
        out.append(models.permutation_importance(m, test, FEATS_ML, t, [*K, T]).withColumn("target", F.lit(t)))
    return models._union(out)


@register("m16_forecast")
def m16_forecast(spark, sf):
    """Latest row per series -> for every target and model the class and its probabilities, and the value forecast
    of that lead with a band of one RMSE (of the test rows) and the ceiling flag."""
    df = _split_features(spark, sf)
    fitted = models.fit_classifiers(df, FEATS_ML, PL.TARGETS)
    values = models.fit_regressors(df, FEATS_ML, PL.VALUE_TARGETS)
    rmse = evaluate.regression_metrics(models.train_and_evaluate_values(
        df, K, T, FEATS_ML, PL.VALUE_TARGETS, "anom", fitted=values).filter(F.col("model") == "boosted"), ["target"])
    latest = df.groupBy(*K).agg(F.max_by(F.struct(T, *FEATS_ML), T).alias("r")).select(*K, "r.*")
    cur = models.fill_test_features(models.align_features(latest, FEATS_ML), FEATS_ML, K, T)
    out = []
    for t, v in zip(PL.TARGETS, PL.VALUE_TARGETS):
        scored = values[v].transform(cur).withColumnRenamed("y_pred", "value").drop("features")
        for kind in models.KINDS:
            p = models.class_probabilities(fitted[t, kind], scored, LABELS)
            out.append(p.select(*K, T, F.lit(t).alias("target"), F.lit(kind).alias("model"), F.lit(v).alias("value_target"),
                                F.col("y_pred").alias("forecast"), label_to_int("y_pred").alias("forecast_int"),
                                *[c if c in p.columns else F.lit(0.0).alias(c) for c in P_COLS], "value"))
    band = evaluate.uncertainty_band(models._union(out), rmse.withColumnRenamed("target", "value_target"), ["value_target"], "value")
    return models.ceiling_flag(band, "value", 1.0).drop("value_target")


@register("w11_top1", sql=PRED_SQL + f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY f1_macro DESC, model) AS r
FROM ({O.metrics_sql("preds", BY)}) m) x WHERE r = 1""")
def w11_top1(spark, sf):
    return evaluate.top_model(evaluate.classification_metrics(preds(spark, sf), BY))
