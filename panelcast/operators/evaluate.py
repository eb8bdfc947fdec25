"""Skill scores over a long predictions table.

Input layout: ``(…keys, target, model, y_true, y_pred)`` for classes, or numeric
``y_true``/``y_pred`` for values.  Each metric family is ONE grouped aggregate with
conditional counts (partial aggregation shrinks it to ≤ 9 counters per group before the
shuffle); everything after that works on a result bounded by targets × models × strata.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import LABELS, lead_from_name, round_half_even

BASELINES = ("climatology", "persistence")


def valid_pairs(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Keep rows where both truth and prediction are present."""
    return pred.filter(F.col(y_true).isNotNull() & F.col(y_pred).isNotNull())


def _cell(a: str, b: str, y_true: str, y_pred: str) -> Column:
    return F.count_if((F.col(y_true) == a) & (F.col(y_pred) == b))


def confusion_counts(pred: DataFrame, by: Sequence[str], labels: Sequence[str] = LABELS,
                     y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One aggregate: n, n_correct and the k x k confusion cells ``c_i_j`` (row = truth)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(y_true) == F.col(y_pred)).alias("n_correct")]
    for i, a in enumerate(labels):
        for j, b in enumerate(labels):
            aggs.append(_cell(a, b, y_true, y_pred).alias(f"c_{i}_{j}"))
    return valid_pairs(pred, y_true, y_pred).groupBy(*by).agg(*aggs)


def _f1(i: int, k: int) -> Column:
    tp = F.col(f"c_{i}_{i}")
    row = sum((F.col(f"c_{i}_{j}") for j in range(k)), F.lit(0))
    col = sum((F.col(f"c_{j}_{i}") for j in range(k)), F.lit(0))
    return F.when(row + col > 0, 2.0 * tp / (row + col)).otherwise(F.lit(0.0))


def metrics_from_counts(counts: DataFrame, by: Sequence[str], labels: Sequence[str] = LABELS,
                        class_names: Sequence[str] = ("f1_la_nina", "f1_neutral", "f1_el_nino"),
                        decimals: int = 4, with_matrix: bool = False) -> DataFrame:
    """E2 algebra: accuracy, macro F1 and per-class F1 over the fixed labels (zero_division=0)."""
    k = len(labels)
    f1s = [_f1(i, k) for i in range(k)]
    out = [F.col(c) for c in by]
    out.append(round_half_even(F.col("n_correct") / F.col("n"), decimals).alias("accuracy"))
    out.append(round_half_even(sum(f1s, F.lit(0.0)) / float(k), decimals).alias("f1_macro"))
    out += [round_half_even(f, decimals).alias(name) for f, name in zip(f1s, class_names)]
    out.append(F.col("n"))
    if with_matrix:
        out.append(F.array(*[F.array(*[F.col(f"c_{i}_{j}") for j in range(k)]) for i in range(k)])
                   .alias("confusion_matrix"))
    return counts.select(*out)


def classification_metrics(pred: DataFrame, by: Sequence[str] = ("target", "model"),
                           labels: Sequence[str] = LABELS, y_true: str = "y_true", y_pred: str = "y_pred",
                           decimals: int = 4, with_matrix: bool = False) -> DataFrame:
    """Tidy rows (by…, accuracy, f1_macro, f1 per class, n)."""
    by = list(by)
    return metrics_from_counts(confusion_counts(pred, by, labels, y_true, y_pred), by, labels,
                               decimals=decimals, with_matrix=with_matrix)


def by_barrier(pred: DataFrame, flag: str, by: Sequence[str] = ("target", "model"),
               labels: Sequence[str] = LABELS, decimals: int = 4) -> DataFrame:
    """Metrics for flag true ('crosses_spring') and false ('no_spring_barrier'),
    plus ``delta_f1`` = F1(no) - F1(yes) from the rounded F1s (NULL unless both exist)."""
    by = list(by)
    strat = pred.withColumn("stratum", F.when(F.col(flag), F.lit("crosses_spring"))
                            .when(~F.col(flag), F.lit("no_spring_barrier")))
    strat = strat.filter(F.col("stratum").isNotNull())
    m = classification_metrics(strat, by + ["stratum"], labels, decimals=decimals)
    w = Window.partitionBy(*by)
    no = F.max(F.when(F.col("stratum") == "no_spring_barrier", F.col("f1_macro"))).over(w)
    yes = F.max(F.when(F.col("stratum") == "crosses_spring", F.col("f1_macro"))).over(w)
    return m.select("*", round_half_even(no - yes, decimals).alias("delta_f1"))


def by_init_month(pred: DataFrame, time: str, by: Sequence[str] = ("target", "model"),
                  labels: Sequence[str] = LABELS, min_samples: int = 3, decimals: int = 4) -> DataFrame:
    """E5: macro F1 for each calendar month 1..12 of the init period; fewer than
    ``min_samples`` pairs -> f1 NULL and n = 0 (real count in ``n_raw``)."""
    by = list(by)
    counts = confusion_counts(pred.withColumn("month", F.month(time).cast("int")), by + ["month"], labels)
    m = metrics_from_counts(counts, by + ["month"], labels, decimals=decimals)
    # at most 12 rows a group become one map, from which all 12 months are read: no join, no second pass
    entry = F.struct("month", F.struct("f1_macro", F.col("n").cast("bigint").alias("n")))
    # pairs without time are in no month
    per = m.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.when(F.col("month").isNotNull(), entry))).alias("__m"))
    j = per.select(*by, "__m", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).select(
        *by, "month", F.try_element_at("__m", F.col("month")).alias("__c"))
    n_raw = F.coalesce(F.col("__c.n"), F.lit(0).cast("bigint"))
    return j.select(*by, "month",
                    F.when(n_raw >= min_samples, F.col("__c.f1_macro")).alias("f1_macro"),
                    F.when(n_raw >= min_samples, n_raw).otherwise(F.lit(0)).cast("bigint").alias("n"),
                    n_raw.alias("n_raw"))


def all_strata(pred: DataFrame, time: str, flag: str, by: Sequence[str] = ("target", "model"), labels: Sequence[str] = LABELS,
               min_samples: int = 3, decimals: int = 4) -> DataFrame:
    """E2 + E4 + E5 in one pass: the scores of each group over all pairs (part ``all``), by barrier flag (``barrier``, column ``stratum``)
    and by calendar month of the init period (``month``).

    The predictions are counted once, by group, flag and month (at most 36 rows of counters a group); GROUPING SETS add
    these counters up.  Pairs without a flag are in no stratum, pairs without time in no month.  ``delta_f1`` as in :func:`by_barrier`;
    a month with fewer than ``min_samples`` pairs has no F1, and ``n`` is its real count."""
    by, k = list(by), len(labels)
    rows = pred.select(*by, "y_true", "y_pred", F.month(time).cast("int").alias("month"),
                       F.when(F.col(flag), "crosses_spring").when(~F.col(flag), "no_spring_barrier").alias("stratum"))
    counts = confusion_counts(rows, [*by, "stratum", "month"], labels)
    cells = ["n", "n_correct", *[f"c_{i}_{j}" for i in range(k) for j in range(k)]]
    sums = counts.groupingSets([[*by], [*by, "stratum"], [*by, "month"]], *by, "stratum", "month").agg(
        *[F.sum(c).alias(c) for c in cells], F.grouping("stratum").alias("__s"), F.grouping("month").alias("__m"))
    part = F.when(F.col("__s") + F.col("__m") == 2, "all").when(F.col("__m") == 1, "barrier").otherwise("month")
    sums = sums.withColumn("part", part).filter(
        (F.col("part") == "all") | ((F.col("part") == "barrier") & F.col("stratum").isNotNull())
        | ((F.col("part") == "month") & F.col("month").isNotNull()))
    keys = [*by, "part", "stratum", "month"]
    m = metrics_from_counts(sums, keys, labels, decimals=decimals)
    f1 = F.when((F.col("part") != "month") | (F.col("n") >= min_samples), F.col("f1_macro"))
    w = Window.partitionBy(*by, "part")
    no = F.max(F.when(F.col("stratum") == "no_spring_barrier", F.col("f1_macro"))).over(w)
    yes = F.max(F.when(F.col("stratum") == "crosses_spring", F.col("f1_macro"))).over(w)
    return m.select(*[f1.alias(c) if c == "f1_macro" else F.col(c) for c in m.columns], round_half_even(no - yes, decimals).alias("delta_f1"))


def normalized_confusion(pred: DataFrame, by: Sequence[str] = ("target", "model"),
                         y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Share of each (truth, prediction) cell in its truth row (row sum clipped at 1)."""
    by = list(by)
    cells = valid_pairs(pred, y_true, y_pred).groupBy(*by, y_true, y_pred).agg(F.count(F.lit(1)).alias("n"))
    row = F.sum("n").over(Window.partitionBy(*by, y_true))
    return cells.select("*", (F.col("n") / F.greatest(row, F.lit(1))).alias("share"))


def regression_metrics(pred: DataFrame, by: Sequence[str] = ("target", "model"),
                       y_true: str = "y_true", y_pred: str = "y_pred", decimals: int = 4) -> DataFrame:
    """RMSE and MAE of value forecasts, rounded; n = valid pairs."""
    e = F.col(y_pred) - F.col(y_true)
    return (valid_pairs(pred, y_true, y_pred).groupBy(*by)
            .agg(round_half_even(F.sqrt(F.avg(e * e)), decimals).alias("rmse"),
                 round_half_even(F.avg(F.abs(e)), decimals).alias("mae"),
                 F.count(F.lit(1)).alias("n")))


def skill_score(reg: DataFrame, reference_model: str = "persistence", by: Sequence[str] = ("target",),
                decimals: int = 4) -> DataFrame:
    """1 - RMSE / RMSE(reference model) per group; NULL when the reference RMSE is 0 or absent."""
    w = Window.partitionBy(*by)
    ref = F.max(F.when(F.col("model") == reference_model, F.col("rmse"))).over(w)
    return reg.select("*", F.when(ref > 0, round_half_even(1 - F.col("rmse") / ref, decimals)).alias("skill"))


def beats_baseline(metrics: DataFrame, baselines: Sequence[str] = BASELINES, metric: str = "f1_macro") -> DataFrame:
    """E9 (+ W11): best non-baseline model per target against the best baseline."""
    is_base = F.col("model").isin(list(baselines))
    # highest score first, then the smallest name; one entry per model of a target
    top = F.array_max(F.collect_list(F.when(~is_base, F.col(metric))))
    first = F.array_min(F.collect_list(F.when(~is_base, F.struct((-F.col(metric)).alias("s"), "model"))))
    per = metrics.groupBy("target").agg(first["model"].alias("best_model"), top.alias("best_" + metric),
                                        F.max(F.when(is_base, F.col(metric))).alias("baseline_" + metric))
    return per.select("*", (F.col("best_" + metric) > F.col("baseline_" + metric)).alias("beats_baseline"))


def top_model(metrics: DataFrame, metric: str = "f1_macro") -> DataFrame:
    """Top-1 model per target (ties broken by model name)."""
    w = Window.partitionBy("target").orderBy(F.col(metric).desc(), F.col("model").asc())
    return metrics.select("*", F.row_number().over(w).alias("__r")).filter("__r = 1").drop("__r")


def order_metrics(metrics: DataFrame) -> DataFrame:
    """Order by target ascending, macro F1 descending."""
    return metrics.orderBy(F.col("target").asc(), F.col("f1_macro").desc(), F.col("model").asc())


def lead_time_table(metrics: DataFrame, models: Sequence[str], metric: str = "f1_macro") -> DataFrame:
    """One row per lead (from the target name), one column per model."""
    t = metrics.select(lead_from_name("target").alias("lead"), "model", metric).filter(F.col("lead").isNotNull())
    return t.groupBy("lead").pivot("model", list(models)).agg(F.first(metric))


def residual_by_regime(pred: DataFrame, flag: str, by: Sequence[str] = ("target",),
                       y_true: str = "y_true", y_pred: str = "y_pred", decimals: int = 4) -> DataFrame:
    """Mean error, RMSE and count per regime flag."""
    e = F.col(y_pred) - F.col(y_true)
    return (valid_pairs(pred, y_true, y_pred).groupBy(*by, flag)
            .agg(round_half_even(F.avg(e), decimals).alias("mean_error"),
                 round_half_even(F.sqrt(F.avg(e * e)), decimals).alias("rmse"),
                 F.count(F.lit(1)).alias("n")))


def uncertainty_band(forecast: DataFrame, reg: DataFrame, on: Sequence[str] = ("target", "model"),
                     value: str = "y_pred") -> DataFrame:
    """Prediction ± RMSE (RMSE table has one row per target x model)."""
    r = reg.select(*on, "rmse")
    j = forecast.join(r, on=list(on), how="left")
    return j.select("*", (F.col(value) - F.col("rmse")).alias("lower"), (F.col(value) + F.col("rmse")).alias("upper"))
