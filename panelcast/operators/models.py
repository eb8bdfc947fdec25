"""Distributed models with ``pyspark.ml``.

Each fit is one distributed ``Pipeline.fit``; the per-target / per-model loop runs on the
driver (at most targets x models fits).  Boosted models stop early on validation rows, which
count neither for class weights nor for any split of a tree.  Class weights come from a label-count table with
one row per class (size bound: number of classes) joined by broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.operators.panel import Series, keys_of

# model settings of the reference configuration (fixed values)
LOGISTIC = {"C": 1.0, "max_iter": 1000}
FOREST = {"n_estimators": 300, "max_depth": 6, "min_samples_leaf": 10}
BOOSTED = {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 5, "min_child_samples": 20}
#: Rounds without a better validation loss that end boosting, where a model is fitted with ``{"patience": PATIENCE}`` (fixed value).
PATIENCE = 50
#: Without patience, boosting ends at the first round that lowers the validation error by less than this share of it.
VALIDATION_TOL = 0.001


def label_index(df: DataFrame, label: str, out: str = "label_idx") -> StringIndexer:
    """M1: alphabetical label encoding (first letters E < L < N give El Niño 0, La Niña 1, Neutral 2)."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error")


def class_weights(df: DataFrame, label: str, out: str = "weight", val_col: str | None = None) -> DataFrame:
    """M3: 'balanced' weights n / (k * n_c) as a column, counted over the rows that are not ``val_col``.
    A class that only validation rows have weighs 1.  The counts table has one row per class
    (size bound: number of classes), so its window and the broadcast join are tiny."""
    fit_rows = df if val_col is None else df.filter(~F.col(val_col))
    counts = fit_rows.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    w = Window.partitionBy()
    weights = counts.select(label, (F.sum("__nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("__nc"))).alias("__w"))
    return df.join(F.broadcast(weights), label, "left").withColumn(out, F.coalesce("__w", F.lit(1.0))).drop("__w")


def _assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def fit_classifier(train: DataFrame, features: Sequence[str], label: str, kind: str = "logistic",
                   params: dict | None = None, weighted: bool = True, seed: int = 42,
                   val_col: str | None = None) -> PipelineModel | "OneVsRestBoosted":
    """M4 / M5 / M6 / M8: fit a classifier pipeline (assembler, scaler for logistic, model, decoder)."""
    p = dict({"logistic": LOGISTIC, "forest": FOREST, "boosted": BOOSTED}[kind])
    p.update(params or {})
    if kind != "boosted" and val_col is not None:
        train, val_col = train.filter(~F.col(val_col)), None  # only boosting has a use for validation rows
    data = class_weights(train, label, val_col=val_col) if weighted else train.withColumn("weight", F.lit(1.0))
    if kind == "boosted":
        return OneVsRestBoosted(features, label, p, seed, val_col).fit(data)
    indexer = label_index(data, label).fit(data)
    stages = [indexer, _assembler(features, "raw_features" if kind == "logistic" else "features")]
    if kind == "logistic":
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
        # sklearn sums the weighted loss with penalty 1/(2C); Spark averages it: regParam = 1 / (C * sum(w))
        sw = data.agg(F.sum("weight")).first()[0]
        est = LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight", family="multinomial",
                                 regParam=1.0 / (p["C"] * sw), elasticNetParam=0.0, standardization=False,
                                 maxIter=int(p["max_iter"]))
    else:
        est = RandomForestClassifier(featuresCol="features", labelCol="label_idx", weightCol="weight",
                                     numTrees=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                                     minInstancesPerNode=int(p["min_samples_leaf"]), seed=seed)
    stages += [est, IndexToString(inputCol="prediction", outputCol="y_pred", labels=indexer.labels)]
    return Pipeline(stages=stages).fit(data)


def best_round(curve: Sequence[float], patience: int) -> tuple[int, bool]:
    """(number of rounds to keep, whether the search is over) for a validation loss by round: the first lowest
    round seen before ``patience`` rounds in a row brought nothing lower."""
    best = 0
    for i, loss in enumerate(curve):
        if loss < curve[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model, n: int):
    """A boosted model that holds only the first ``n`` trees of ``model``, with all its settings."""
    java = model._java_obj
    if n >= java.getNumTrees():
        return model
    gateway = SparkSession.getActiveSession().sparkContext._gateway
    trees, weights = java.trees(), java.treeWeights()
    some = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    some_weights = gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        some[i], some_weights[i] = trees[i], weights[i]
    kind = gateway.jvm.org.apache.spark.ml
    if isinstance(model, GBTClassificationModel):
        cut = kind.classification.GBTClassificationModel(java.uid(), some, some_weights, java.numFeatures(), 2)
    else:
        cut = kind.regression.GBTRegressionModel(java.uid(), some, some_weights, java.numFeatures())
    return type(model)(cut.copy(java.extractParamMap()))


def validation_curve(model, rows: DataFrame) -> list[float]:
    """Loss of the first 1, 2, ... trees on ``rows`` (assembled), as the model's own loss counts it: squared error, or
    twice the log loss."""
    if isinstance(model, GBTClassificationModel):
        return list(model.evaluateEachIteration(rows))
    return list(model.evaluateEachIteration(rows, "squared"))


def fit_patiently(gbt, rows: DataFrame, val_col: str, patience: int):
    """M6 / M7: the boosted model cut to the best round of its validation curve, where boosting ends after
    ``patience`` rounds without a lower loss.  -> (model, curve).

    Spark's own early stopping ends at the first weak round, so the trees are grown without it, on the rows that are not
    ``val_col``: twice the patience first, then twice as many each time until the curve has ended or ``maxIter`` is reached.  A
    round depends on the rounds before it only, so a longer fit begins with the trees of the shorter one, and all fits
    together grow at most four times the rounds that the curve needs."""
    fit_rows, val_rows = rows.filter(~F.col(val_col)).cache(), rows.filter(F.col(val_col)).cache()
    most = gbt.getMaxIter()
    n = min(most, 2 * patience)
    try:
        while True:
            model = gbt.copy({gbt.maxIter: n}).fit(fit_rows)
            curve = validation_curve(model, val_rows)
            best, ended = best_round(curve, patience)
            if ended or n >= most:
                return first_trees(model, best), curve
            n = min(most, 2 * n)
    finally:
        fit_rows.unpersist()
        val_rows.unpersist()


class OneVsRestBoosted:
    """M6 / M9: Spark's GBT is binary; one boosted model per class, probabilities renormalised,
    class = argmax.  ``val_col`` (boolean) enables early stopping on a validation set."""

    def __init__(self, features, label, params, seed=42, val_col=None):
        self.features, self.label, self.params, self.seed, self.val_col = list(features), label, params, seed, val_col
        self.models: dict[str, PipelineModel] = {}
        self.curves: dict[str, list[float]] = {}
        self.classes: list[str] = []

    def fit(self, data: DataFrame) -> "OneVsRestBoosted":
        fit_rows = data if self.val_col is None else data.filter(~F.col(self.val_col))
        self.classes = sorted(r[0] for r in fit_rows.select(self.label).distinct().collect())  # k classes
        for c in self.classes:
            d = data.withColumn("__y", (F.col(self.label) == c).cast("double"))
            gbt = GBTClassifier(featuresCol="features", labelCol="__y", weightCol="weight",
                                maxIter=int(self.params["n_estimators"]), stepSize=float(self.params["learning_rate"]),
                                maxDepth=int(self.params["max_depth"]),
                                minInstancesPerNode=int(self.params["min_child_samples"]), seed=self.seed)
            gbt.setProbabilityCol(f"__p_{len(self.models)}").setRawPredictionCol(f"__r_{len(self.models)}") \
               .setPredictionCol(f"__h_{len(self.models)}")
            self.models[c], self.curves[c] = _boost(gbt, d, self.features, self.params, self.val_col)
        return self

    def trees(self) -> dict[str, int]:
        """Number of boosting rounds of each class."""
        return {c: m.stages[-1].getNumTrees for c, m in self.models.items()}

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for i, c in enumerate(self.classes):
            out = self.models[c].stages[-1].transform(self.models[c].stages[0].transform(out)).drop("features")
            out = out.withColumn(f"__q{i}", vector_to_array(F.col(f"__p_{i}"))[1]).drop(f"__p_{i}", f"__r_{i}", f"__h_{i}")
        total = sum((F.col(f"__q{i}") for i in range(len(self.classes))), F.lit(0.0))
        probs = F.array(*[F.col(f"__q{i}") / total for i in range(len(self.classes))])
        out = out.withColumn("probs", probs)
        best = F.array_position(out["probs"], F.array_max(out["probs"])) - 1
        names = F.array(*[F.lit(c) for c in self.classes])
        return out.withColumn("y_pred", names[best.cast("int")]).drop(*[f"__q{i}" for i in range(len(self.classes))])


def class_probabilities(model, df: DataFrame, classes: Sequence[str] | None = None) -> DataFrame:
    """M9: one probability column per class name, ``p_<class>`` (decoded order of the indexer)."""
    out = model.transform(df)
    if isinstance(model, OneVsRestBoosted):
        labels = model.classes
        arr = F.col("probs")
    else:
        labels = model.stages[0].labels
        arr = vector_to_array(F.col("probability"))
    names = {c: "p_" + c.lower().replace(" ", "_").replace("ñ", "n") for c in (classes or labels)}
    return out.select("*", *[arr[labels.index(c)].alias(names[c]) for c in (classes or labels) if c in labels])


def fit_regressor(train: DataFrame, features: Sequence[str], label: str, params: dict | None = None,
                  val_col: str | None = None, seed: int = 42) -> PipelineModel:
    """M7: boosted regression trees, early stopping on the validation rows (not the test set): after ``params["patience"]`` rounds
    without a lower validation error, cut to the best round, or else by the tolerance."""
    p = dict(BOOSTED)
    p.update(params or {})
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred", maxIter=int(p["n_estimators"]),
                       stepSize=float(p["learning_rate"]), maxDepth=int(p["max_depth"]),
                       minInstancesPerNode=int(p["min_child_samples"]), seed=seed)
    return _boost(gbt, train, features, p, val_col)[0]


def _boost(gbt, rows: DataFrame, features: Sequence[str], params: dict, val_col: str | None) -> tuple[PipelineModel, list[float]]:
    """(fitted pipeline, validation curve): stopped by patience if ``params`` names one, else by Spark's tolerance;
    without validation rows all rounds are grown.  The curve is empty unless patience stopped it."""
    assembler = _assembler(features)
    if val_col and params.get("patience"):
        label, weight = gbt.getLabelCol(), gbt.getWeightCol() if gbt.isDefined(gbt.weightCol) else None
        flat = assembler.transform(rows).select("features", label, val_col, *([weight] if weight else []))
        model, curve = fit_patiently(gbt, flat, val_col, int(params["patience"]))
        return PipelineModel(stages=[assembler, model]), curve
    if val_col:
        gbt.setValidationIndicatorCol(val_col)
        gbt._set(validationTol=float(params.get("validation_tol", VALIDATION_TOL)))
    return Pipeline(stages=[assembler, gbt]).fit(rows), []


BOOSTED_KIND = "one-vs-rest boosted trees"


def save_model(model: PipelineModel | OneVsRestBoosted, path: str) -> None:
    """Persist (the feature list lives in the assembler stage).  Boosted classifiers are a folder per
    class and a ``metadata`` folder like that of Spark's own models."""
    if not isinstance(model, OneVsRestBoosted):
        model.write().overwrite().save(path)
        return
    for i, c in enumerate(model.classes):
        model.models[c].write().overwrite().save(f"{path}/class_{i}")
    meta = {"class": BOOSTED_KIND, "features": model.features, "label": model.label, "params": model.params,
            "seed": model.seed, "val_col": model.val_col, "classes": model.classes}
    SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "value string").write.mode(
        "overwrite").text(f"{path}/metadata")


def load_model(path: str) -> PipelineModel | OneVsRestBoosted:
    """The model that :func:`save_model` wrote, of either kind."""
    meta = json.loads(SparkSession.getActiveSession().read.text(f"{path}/metadata").first()[0])
    if meta["class"] != BOOSTED_KIND:
        return PipelineModel.load(path)
    m = OneVsRestBoosted(meta["features"], meta["label"], meta["params"], meta["seed"], meta["val_col"])
    m.classes = meta["classes"]
    m.models = {c: PipelineModel.load(f"{path}/class_{i}") for i, c in enumerate(m.classes)}
    return m


def align_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """M8: score a frame that lacks some training features: absent columns become 0.0 (as the
    forecast step does), present ones are cast to DOUBLE; feature order comes from the model."""
    have, wanted = set(df.columns), set(features)
    return df.select(*[F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns],
                     *[F.lit(0.0).alias(c) for c in features if c not in have])


def fill_test_features(test: DataFrame, features: Sequence[str], series: Series, time: str) -> DataFrame:
    """W8 + P12 for test rows: forward fill inside the test rows only, then 0."""
    w = Window.partitionBy(*keys_of(series)).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    feats = set(features)
    return test.select(*[F.coalesce(F.last(c, True).over(w), F.lit(0.0)).cast("double").alias(c) if c in feats
                         else F.col(c) for c in test.columns])


KINDS = ("logistic", "forest", "boosted")


def _fit_rows(df: DataFrame, features: Sequence[str], target: str, split: str) -> DataFrame:
    """Train and validation rows (boolean ``is_val``) with the target and all features."""
    rows = df.filter(F.col(split).isin("train", "val") & F.col(target).isNotNull()).dropna("any", subset=list(features))
    return rows.withColumn("is_val", F.col(split) == "val")


def _test_rows(df: DataFrame, series: Series, time: str, features: Sequence[str], target: str, split: str) -> DataFrame:
    """Test rows: those without the target leave first, then features are filled inside the rest."""
    return fill_test_features(df.filter((F.col(split) == "test") & F.col(target).isNotNull()), features, series, time)


def _with_doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in df.columns])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def _val_col(rows: DataFrame) -> str | None:
    """Early stopping needs validation rows."""
    return None if rows.filter("is_val").isEmpty() else "is_val"


def fit_classifiers(df: DataFrame, features: Sequence[str], targets: Sequence[str], kinds: Sequence[str] = KINDS,
                    split: str = "split", params: dict | None = None) -> dict:
    """{(target, kind): fitted classifier}; boosted trees stop early on the validation rows, if there are any."""
    df, out = _with_doubles(df, features), {}
    for t in targets:
        rows = _fit_rows(df, features, t, split)
        val = _val_col(rows)
        train = rows.filter(~F.col("is_val"))
        for kind in kinds:
            boosted = kind == "boosted" and val is not None
            out[t, kind] = fit_classifier(rows if boosted else train, features, t, kind, (params or {}).get(kind),
                                          val_col=val if boosted else None)
    return out


def fit_regressors(df: DataFrame, features: Sequence[str], targets: Sequence[str], split: str = "split",
                   params: dict | None = None) -> dict:
    """{target: fitted boosted regressor}, stopped early on the validation rows, if there are any."""
    df, out = _with_doubles(df, features), {}
    for t in targets:
        rows = _fit_rows(df, features, t, split)
        val = _val_col(rows)
        out[t] = fit_regressor(rows if val else rows.filter(~F.col("is_val")), features, t, params, val)
    return out


def train_and_evaluate(df: DataFrame, series: Series, time: str, features: Sequence[str], targets: Sequence[str],
                       kinds: Sequence[str] = KINDS, phase_col: str = "enso_phase",
                       split: str = "split", params: dict | None = None, fitted: dict | None = None) -> DataFrame:
    """For each target fit every model on train rows (complete features), predict the test
    rows (features filled within the test split), and return the long predictions including
    the climatology and persistence baselines.  ``fitted`` takes the models of :func:`fit_classifiers`
    instead of fitting them here."""
    from panelcast.operators import baselines

    keys = keys_of(series)
    fitted = fitted or fit_classifiers(df, features, targets, kinds, split, params)
    df = _with_doubles(df, features)
    out = []
    for t in targets:
        test = _test_rows(df, keys, time, features, t, split)
        cols = [*keys, time, F.lit(t).alias("target")]
        for kind in kinds:
            out.append(fitted[t, kind].transform(test).select(*cols, F.lit(kind).alias("model"), F.col(t).alias("y_true"), "y_pred"))
        base = test.select(*cols, F.col(t).alias("y_true"), F.col(phase_col))
        train = _fit_rows(df, features, t, split).filter(~F.col("is_val"))
        tl = train.select(F.lit(t).alias("target"), F.col(t).alias("y_true"))
        clim = baselines.climatology(tl, base.drop(phase_col))
        out.append(clim.select(*keys, time, "target", "model", "y_true", "y_pred"))
        out.append(base.select(*keys, time, "target", F.lit("persistence").alias("model"), "y_true",
                               F.col(phase_col).alias("y_pred")))
    return _union(out)


def train_and_evaluate_values(df: DataFrame, series: Series, time: str, features: Sequence[str], targets: Sequence[str],
                              value: str, split: str = "split", params: dict | None = None,
                              fitted: dict | None = None) -> DataFrame:
    """Regression half of M14: the boosted regressor and the persistence of ``value`` (filled inside the
    test rows) for each value target, as long predictions of the test rows."""
    keys = keys_of(series)
    fitted = fitted or fit_regressors(df, features, targets, split, params)
    df = _with_doubles(df, [*features, value])
    out = []
    for t in targets:
        test = _test_rows(df, keys, time, [*dict.fromkeys([*features, value])], t, split)
        both = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("y_pred"))
                                   for n, c in (("boosted", "y_pred"), ("persistence", value))]))
        out.append(fitted[t].transform(test).select(*keys, time, F.lit(t).alias("target"), F.col(t).alias("y_true"),
                                                    both.alias("m")).select(*keys, time, "target", "y_true", "m.*"))
    return _union(out)


def linear_attribution(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """M15(a): exact attribution of a linear score, mean |w_i * (x_i - mean x_i)| per feature.
    Two aggregates: the column means (one row), then the mean absolute contributions."""
    m = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(weights)]).first()
    row = df.agg(*[F.avg(F.abs(F.lit(float(w)) * (F.col(c) - F.lit(m[f"m_{i}"])))).alias(f"a_{i}")
                   for i, (c, w) in enumerate(weights.items())])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a_{i}").alias("importance"))
                                          for i, c in enumerate(weights)])).alias("s")).select("s.*")


def dense_ids(df: DataFrame, order: Sequence[str], out: str, bucket_rows: int = 10_000) -> tuple[DataFrame, int]:
    """(``df`` with ids 0..n-1 in the order of a hash of the columns ``order``, n).

    Rows are numbered inside buckets of the hash, whose number grows with the rows, and the number of rows before
    a bucket comes from a table with one row per bucket: no window holds all rows."""
    from panelcast.session import materialize

    n = df.count()
    buckets = n // bucket_rows + 1
    h = df.withColumn("__h", F.xxhash64(*order)).withColumn(
        "__b", F.floor(F.pmod(F.col("__h"), F.lit(2 ** 32)) * buckets / 2 ** 32).cast("int"))
    h = materialize(h)
    sums = h.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__from", F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.row_number().over(Window.partitionBy("__b").orderBy("__h", *order))
    ids = h.withColumn("__k", place).join(sums.select("__b", "__from"), "__b")
    return ids.withColumn(out, F.coalesce("__from", F.lit(0)) + F.col("__k") - 1).drop("__h", "__b", "__k", "__from"), n


def permutation_importance(model, test: DataFrame, features: Sequence[str], label: str,
                           keys: Sequence[str], seed: int = 42) -> DataFrame:
    """M15(b): drop in macro F1 when one feature is shuffled across the test rows (feature, importance).

    Rows get dense ids in the order of a hash of their ``keys``; feature j takes its value from the row
    ``shift_j`` places further on (round the end), a rule that is the same at every size.  All features are
    scored in one plan: the rows once per feature, joined to their donors by id."""
    from panelcast.operators.evaluate import classification_metrics
    from panelcast.session import materialize

    t, n = dense_ids(test, keys, "__id")
    t = materialize(t)
    shifts = [1 + (seed * 7919 + j * 104_729) % max(1, n - 1) for j in range(len(features))]
    which = F.explode(F.array(F.struct(F.lit("").alias("feature"), F.lit(0).alias("shift")),
                              *[F.struct(F.lit(f).alias("feature"), F.lit(s).alias("shift")) for f, s in zip(features, shifts)]))
    rows = t.withColumn("__w", which).withColumn("__donor", (F.col("__id") + F.col("__w.shift")) % max(1, n))
    donors = t.select(F.col("__id").alias("__donor"), F.struct(*features).alias("__d"))
    swapped = rows.join(donors, "__donor").select(
        F.col(label), F.col("__w.feature").alias("feature"),
        *[F.when(F.col("__w.feature") == f, F.col(f"__d.`{f}`")).otherwise(F.col(f)).alias(f) for f in features])
    pred = model.transform(swapped).select("feature", F.col(label).alias("y_true"), "y_pred")
    f1 = classification_metrics(pred, ["feature"], decimals=12).select("feature", "f1_macro")
    # one row per feature, and one (the empty name) for the rows as they are
    whole = F.max(F.when(F.col("feature") == "", F.col("f1_macro"))).over(Window.partitionBy())
    return f1.select("feature", (whole - F.col("f1_macro")).alias("importance")).filter("feature != ''")


def tree_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M15(c): impurity importances of a fitted forest."""
    est = [s for s in model.stages if hasattr(s, "featureImportances")][0]
    imp = est.featureImportances.toArray().tolist()
    return SparkSession.getActiveSession().createDataFrame(
        sorted(zip(features, map(float, imp)), key=lambda r: -r[1]), "feature string, importance double")


def ceiling_flag(df: DataFrame, value: str, ceiling: float, share: float = 0.85) -> DataFrame:
    """Forecast above ``share`` x ceiling."""
    return df.select("*", (F.col(value) > share * ceiling).alias("near_ceiling"))

