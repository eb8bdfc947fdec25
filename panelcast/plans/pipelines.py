"""End-to-end plans: build a labelled feature panel, score baselines, the flagship query.

Plan shape of :func:`build_dataset` (see ``bench.py`` / ``explain``): scan → (join) →
partial aggregate → exchange(series, period) → final aggregate → exchange(series) →
window passes (grid, fill, moments, smoothing, targets, features) without further exchanges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators import baselines, evaluate, features, labels, panel, splits
from panelcast.sources import tables

# Fixture panel A: (nation, segment) x month.
SERIES_A = ("nation", "segment")
TIME = "period"
BASE_A = ("anom", "orders")
HORIZONS = (1, 3, 6)
TARGETS = tuple(f"enso_t{h}" for h in HORIZONS)
SPLIT_A = {"train_end": "1998-12", "val_start": "1999-01", "val_end": "1999-12", "test_start": "2000-01"}


def prepared_a(spark: SparkSession, sf_dir: str, max_gap: int = 3) -> DataFrame:
    """PANEL_A → C1 grid → W7 fill (limit ``max_gap``) → standardised revenue ``anom`` + ``orders``."""
    return prepare(tables.panel_a(spark, sf_dir), max_gap)


def prepare(p: DataFrame, max_gap: int = 3) -> DataFrame:
    g = panel.regular_grid(p, SERIES_A, TIME, "month")
    f = panel.ffill(g, ["revenue", "n_orders"], SERIES_A, TIME, limit=max_gap)
    f = f.withColumn("orders", F.col("n_orders").cast("double"))
    return panel.standardize(f.withColumn("anom", F.col("revenue")), ["anom"], SERIES_A)


def labelled_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label(prepared_a(spark, sf_dir), "anom", SERIES_A, TIME, HORIZONS)


def build_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1: sources → clean → label → features, one lazy plan."""
    return features.build_features(labelled_a(spark, sf_dir), list(BASE_A), SERIES_A, TIME, horizons=HORIZONS)


def build_dataset_routed(spark: SparkSession, sf_dir: str, max_periods: int = 100_000, bucket: int = 10_000) -> DataFrame:
    """Entry 1 for panels of mixed lengths: series of up to ``max_periods`` by :func:`build_dataset`'s plan, longer ones in time
    buckets, from one read of the facts.  Same rows and values as :func:`build_dataset`."""
    from panelcast.operators.halo import route_by_length

    def plain(p):
        lab = labels.label(prepare(p), "anom", SERIES_A, TIME, HORIZONS)
        return features.build_features(lab, list(BASE_A), SERIES_A, TIME, horizons=HORIZONS).select(*build_dataset_columns())

    return route_by_length(tables.panel_a(spark, sf_dir), SERIES_A, TIME, plain, lambda p: dataset_in_buckets(p, bucket), max_periods)


def predictions_a(spark: SparkSession, sf_dir: str, models: Sequence[str] = ("climatology", "persistence")) -> DataFrame:
    """Long predictions ``(nation, segment, period, target, y_true, y_pred, model, crosses, split)``
    of the naive baselines on the test split."""
    from panelcast.session import materialize
    # the labelled panel feeds both the training counts and the test rows: materialise it once
    needed = labelled_a(spark, sf_dir).select(*SERIES_A, TIME, "enso_phase", *TARGETS)  # prune before writing
    df = splits.time_split(materialize(needed), TIME, **SPLIT_A)
    df = df.withColumn("month", F.month(TIME).cast("int"))
    long = baselines.long_targets(df, SERIES_A, TIME, TARGETS, carry=["split", "enso_phase", "month"])
    long = long.withColumn("crosses", _crosses_for_target("target", "month"))
    test = long.filter(F.col("split") == "test")
    out = []
    if "persistence" in models:
        out.append(baselines.persistence(test, "enso_phase"))
    if "climatology" in models:
        out.append(baselines.climatology(long.filter(F.col("split") == "train"), test))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def _crosses_for_target(target: str, month: str):
    from panelcast.functions.scalar import crosses_barrier, lead_from_name
    return crosses_barrier(F.col(month), lead_from_name(target))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ⨝ customer → monthly panel → grid → fill → standardise → label → persistence and
    climatology baselines → accuracy / macro F1 per horizon."""
    return evaluate.classification_metrics(predictions_a(spark, sf_dir), ["target", "model"])


VALUE_TARGETS = tuple(f"nino34_t{h}" for h in HORIZONS)


def regression_predictions_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long value forecasts on the test split: persistence of the current anomaly (M13) and of
    its 3-period mean (smoothed variant, D11).  Per target, rows without the target leave
    first; the predictor is then filled forward inside the remaining test rows, then 0."""
    df = build_dataset(spark, sf_dir).filter(F.col(TIME) >= F.lit("2000-01-01").cast("date"))
    cells = [F.struct(F.lit(t).alias("target"), F.col(t).alias("y_true")) for t in VALUE_TARGETS]
    long = df.select(*SERIES_A, TIME, "init_in_growth_phase", "anom", "anom_rm3",
                     F.explode(F.array(*cells)).alias("c")).select("*", "c.*").drop("c")
    long = long.filter(F.col("y_true").isNotNull())
    w = panel.over([*SERIES_A, "target"], TIME, (None, 0))
    preds = long.selectExpr(*SERIES_A, TIME, "init_in_growth_phase", "target", "y_true",
                            f"coalesce(last(anom, true) {w}, 0.0) AS persistence",
                            f"coalesce(last(anom_rm3, true) {w}, 0.0) AS persistence_smoothed")
    models = ("persistence", "persistence_smoothed")
    return preds.selectExpr(*SERIES_A, TIME, "init_in_growth_phase", "target", "y_true",
                            f"stack({len(models)}, " + ", ".join(f"'{m}', {m}" for m in models) + ") AS (model, y_pred)")


def labelled_panel(df: DataFrame, series, value: str, count: str, unit: str = "month",
                   horizons=HORIZONS, max_gap: int = 3) -> DataFrame:
    """Generic chain for any panel: grid -> limited fill -> standardised ``anom`` -> targets."""
    g = panel.regular_grid(df, series, TIME, unit)
    f = panel.ffill(g, [value, count], series, TIME, limit=max_gap)
    f = panel.standardize(f.withColumn("anom", F.col(value)), ["anom"], series)
    return labels.label(f, "anom", series, TIME, horizons)


def build_dataset_bucketed(spark: SparkSession, sf_dir: str, bucket: int = 24, max_gap: int = 3) -> DataFrame:
    """Entry 1 for skewed panels: no step holds a whole series in one task.

    grid by time buckets -> limited fill in halo buckets (reach back ``max_gap``) -> moments by
    group + join -> targets and features in halo buckets (back: lag 6; ahead: lead 6 of a
    3-row mean).  Same rows and values as :func:`build_dataset`.
    """
    return dataset_in_buckets(tables.panel_a(spark, sf_dir), bucket, max_gap)


def dataset_in_buckets(p: DataFrame, bucket: int, max_gap: int = 3) -> DataFrame:
    from panelcast.operators.halo import with_halo
    from panelcast.session import materialize

    p = materialize(p)  # read by the grid, its summary of buckets and the moments: the facts are read once
    g = panel.regular_grid_bucketed(p, SERIES_A, TIME, bucket, "month")
    f = with_halo(g, SERIES_A, TIME, lambda d, k: panel.ffill(d, ["revenue", "n_orders"], k, TIME, limit=max_gap),
                  reach_back=max_gap, reach_ahead=0, bucket=bucket)
    f = f.selectExpr("*", "CAST(n_orders AS DOUBLE) AS orders", "revenue AS anom")
    f = panel.standardize_by_join(f, ["anom"], SERIES_A)

    def targets_and_features(d, k):
        lab = labels.label(d, "anom", k, TIME, HORIZONS)
        return features.build_features(lab, list(BASE_A), k, TIME, horizons=HORIZONS)

    out = with_halo(f, SERIES_A, TIME, targets_and_features, reach_back=6, reach_ahead=6, bucket=bucket)
    return out.select(*build_dataset_columns())


def build_dataset_columns() -> list[str]:
    from panelcast.plans.oracle import FEATURES_A_COLS
    return list(FEATURES_A_COLS)


# --------------------------------------------------------------------------- end-to-end entry points
def run_build(df: DataFrame, series, time: str, value: str, out_path: str, base: Sequence[str] | None = None,
              start=None, end=None, max_gap: int = 3, unit: str = "month", horizons=HORIZONS) -> DataFrame:
    """Entry 1 (build dataset) for any panel: clean (P1, P2, C1, W7) -> label (C3) -> features (C4)
    -> leakage gate (Q8, raises on failure) -> parquet (S10).  The gate and the write read one
    materialised table.  Returns the written dataset."""
    from panelcast.operators import quality
    from panelcast.session import materialize
    from panelcast.sources.sinks import write_parquet

    keys = panel.keys_of(series)
    cleaned = panel.clean(df, keys, time, start=start, end=end, max_gap=max_gap, unit=unit)
    lab = labels.label(cleaned, value, keys, time, horizons)
    bases = list(base) if base is not None else [value]
    ds = materialize(features.build_features(lab, bases, keys, time, horizons=horizons))
    roles = labels.target_columns(horizons)
    targets = roles["phase"] + roles["class"] + roles["value"]
    feats = features.feature_columns(ds, targets, keys, time)
    quality.assert_passed(quality.leakage_report(ds, keys, time, feats, targets, horizons=horizons,
                                                 lag_bases=bases, unit=unit))
    write_parquet(ds, out_path, sort_within=[*keys, time])
    return ds


def run_training(spark: SparkSession, dataset_path: str, series, time: str, out_dir: str, train_end, test_start,
                 val_start=None, val_end=None, kinds=("logistic", "forest", "boosted"), horizons=HORIZONS,
                 value: str = "anom", params: dict | None = None) -> DataFrame:
    """Entry 2 (train and evaluate): split (L1) -> per target fit every model on train rows and
    score the test rows against climatology and persistence (M14) -> tidy metrics sorted (E2, E6)
    -> beats-baseline table (E9) -> JSON sinks (S12).  For the value targets: boosted regressors
    against the persistence of ``value``, RMSE, MAE and skill (E7, E8).  Below ``out_dir``: ``metrics``,
    ``beats_baseline``, ``regression_metrics`` and ``models/<target>/<kind>`` (M10).  Returns the tidy metrics."""
    from panelcast.operators import models
    from panelcast.session import materialize
    from panelcast.sources.sinks import write_json

    keys, out, params = panel.keys_of(series), out_dir.rstrip("/"), params or {}
    ds = spark.read.parquet(dataset_path)
    if value not in ds.columns:
        raise ValueError(f"no column {value!r}: name the value that was labelled")
    roles = labels.target_columns(horizons)
    feats = features.feature_columns(ds, roles["phase"] + roles["class"] + roles["value"], keys, time,
                                     numeric_only=True)
    df = materialize(splits.time_split(ds, time, train_end, test_start, val_start, val_end))
    fitted = models.fit_classifiers(df, feats, roles["class"], kinds, params=params)
    preds = materialize(models.train_and_evaluate(df, keys, time, feats, roles["class"], kinds, fitted=fitted))
    metrics = materialize(evaluate.classification_metrics(preds, ["target", "model"], with_matrix=True))
    metrics = evaluate.order_metrics(metrics)
    write_json(metrics, f"{out}/metrics")
    write_json(evaluate.beats_baseline(metrics), f"{out}/beats_baseline")
    values = models.fit_regressors(df, feats, roles["value"], params=params.get("boosted"))
    reg = models.train_and_evaluate_values(df, keys, time, feats, roles["value"], value, fitted=values)
    write_json(evaluate.skill_score(evaluate.regression_metrics(reg)), f"{out}/regression_metrics")
    for (t, kind), m in {**fitted, **{(t, "boosted_value"): m for t, m in values.items()}}.items():
        models.save_model(m, f"{out}/models/{t}/{kind}")
    return metrics


def run_export(spark: SparkSession, dataset_path: str, time: str, out_dir: str, test_start, horizons=HORIZONS,
               drop: Sequence[str] = (), renames: dict | None = None) -> DataFrame:
    """Entry 3 (export): P5 -> P6 -> F8 -> P10 -> L3 -> bundle."""
    from panelcast.operators import export

    ds = spark.read.parquet(dataset_path)
    targets = labels.target_columns(horizons)["class"]
    ex = export.export_frame(ds, time, test_start, targets, drop=drop, renames=renames)
    skip = {time, "split", "enso_phase", *targets, *[f"{t}_int" for t in targets],
            *labels.target_columns(horizons)["value"]}
    n_features = len([f.name for f in ex.schema if f.name not in skip and f.dataType.simpleString() != "string"])
    export.write_bundle(ex, out_dir, time, n_features)
    return ex
