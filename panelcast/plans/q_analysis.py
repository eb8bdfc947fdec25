"""Queries for aggregations and analysis (A1, A3-A9, A12, A13), analogue jobs
and the export bundle (X1-X3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import scalar as fx
from panelcast.operators import analysis, baselines, export, panel, splits
from panelcast.plans import oracle as O
from panelcast.plans import pipelines as PL
from panelcast.plans.catalog import register
from panelcast.plans.q_panel import RENAMES, _renamed
from panelcast.sources import tables

K = ["nation", "segment"]
T = "period"
LA, NE, EN = fx.LABELS


def _sql_a(upto, select, extra=None):
    return O.with_(*O.chain_a(upto), *(extra or [])) + select


# ----------------------------------------------------------------------------- A
@register("a1_daily_mean", sql="""SELECT event_type, CAST(ts AS DATE) AS period, avg(value) AS value,
  avg(CASE WHEN value >= 25.0 THEN sin(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END) AS phase_sin,
  avg(CASE WHEN value >= 25.0 THEN cos(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END) AS phase_cos,
  count(*) AS n
FROM events GROUP BY 1, 2""", r6=["value", "phase_sin", "phase_cos"])
def a1_daily_mean(spark, sf):
    e = tables.read_table(spark, sf, "events")
    e = e.select("event_type", "ts", "value", fx.cyclic_sin(F.col("user_id") % 8 + 1, "value", 25.0).alias("phase_sin"),
                 fx.cyclic_cos(F.col("user_id") % 8 + 1, "value", 25.0).alias("phase_cos"))
    return panel.rollup_mean(e, "event_type", "ts", ["value", "phase_sin", "phase_cos"], unit="day", out=T)


@register("a3_value_counts", sql=_sql_a("labelled_a", """SELECT enso_phase, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share
FROM (SELECT enso_phase, count(*) AS n FROM labelled_a WHERE enso_phase IS NOT NULL GROUP BY 1) c"""), r6=["share"])
def a3_value_counts(spark, sf):
    return analysis.value_counts(PL.labelled_a(spark, sf), "enso_phase")


@register("a4_modal_class", sql=O.with_(*O.predictions_a_sql()) + "SELECT * FROM modal")
def a4_modal_class(spark, sf):
    df = splits.time_split(PL.labelled_a(spark, sf), T, **PL.SPLIT_A).filter(F.col("split") == "train")
    return baselines.modal_class(baselines.long_targets(df, K, T, PL.TARGETS))


PCT = {LA: "la_nina_pct", NE: "neutral_pct", EN: "el_nino_pct"}


@register("a5_pivot_month", sql=_sql_a("labelled_a", "SELECT month, " + ", ".join(
    f"count_if(enso_phase = {O.q(lab)}) * 100.0 / count(*) AS {name}" for lab, name in PCT.items())
    + " FROM (SELECT CAST(month(period) AS INTEGER) AS month, enso_phase FROM labelled_a WHERE enso_phase IS NOT NULL) x GROUP BY 1"),
    r6=list(PCT.values()))
def a5_pivot_month(spark, sf):
    df = PL.labelled_a(spark, sf).withColumn("month", F.month(T).cast("int"))
    return analysis.pivot_share(df, "month", "enso_phase", list(PCT), list(PCT.values()))


CORR_FEATS = [c for c in O.DOUBLE_FEATURES_A if c not in ("month_sin", "month_cos")] + ["anom", "month_sin", "month_cos"]


@register("a6_corr_topk", sql=_sql_a("features_a", f"""SELECT feature, corr, abs(corr) AS abs_corr FROM (
  SELECT * FROM (SELECT {', '.join(f'corr({c}, y) AS {c}' for c in CORR_FEATS)}
    FROM (SELECT *, CAST({O.label_int_sql('enso_t1')} AS DOUBLE) AS y FROM features_a) f) a
  UNPIVOT (corr FOR feature IN ({', '.join(CORR_FEATS)}))) u
WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 10"""), r6=["corr", "abs_corr"])
def a6_corr_topk(spark, sf):
    df = PL.build_dataset(spark, sf)
    c = analysis.correlations(df, CORR_FEATS, fx.label_to_int("enso_t1"))
    return analysis.top_k(c, "abs_corr", 10, ["feature"])


MATRIX = CORR_FEATS  # every numeric feature
PAIRS = [(a, b) for i, a in enumerate(MATRIX) for b in MATRIX[i:]]


@register("a7_corr_matrix", sql=_sql_a("features_a", "SELECT s.col_a, s.col_b, s.corr FROM (SELECT unnest(l) AS s FROM (SELECT [" + ", ".join(
    f"{{'col_a': {O.q(a)}, 'col_b': {O.q(b)}, 'corr': corr({a}, {b})}}" for a, b in PAIRS) + "] AS l FROM features_a) x) y"),
    r6=["corr"])
def a7_corr_matrix(spark, sf):
    return analysis.correlation_matrix(PL.build_dataset(spark, sf), MATRIX)


@register("a8_pair_corr", sql=_sql_a("prepared_a", "SELECT nation, segment, corr(anom, orders) AS corr FROM prepared_a GROUP BY 1, 2"),
          r6=["corr"])
def a8_pair_corr(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.groupBy(*K).agg(F.corr("anom", "orders").alias("corr"))


@register("a9_extent", sql=_sql_a("prepared_a", f"""SELECT split, count(*) AS n, min(period) AS start, max(period) AS "end"
FROM (SELECT *, {O.SPLIT_SQL} AS split FROM prepared_a) s GROUP BY 1"""))
def a9_extent(spark, sf):
    df = splits.time_split(PL.prepared_a(spark, sf), T, **PL.SPLIT_A)
    return analysis.extents(df, T, ["split"])


@register("a13_shape_summary", sql=_sql_a("features_a", f"""SELECT count(*) AS n_rows, {len(O.FEATURES_A_COLS)} AS n_columns,
  {len(O.FEATURES_A_COLS) - len(O.LABEL_COLS) - 3} AS n_features, count(DISTINCT (nation, segment)) AS n_series FROM features_a"""))
def a13_shape_summary(spark, sf):
    df = PL.build_dataset(spark, sf)
    n_feat = len(df.columns) - len(O.LABEL_COLS) - 3
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  F.lit(n_feat).alias("n_features"), F.count_distinct(*K).alias("n_series"))


# ----------------------------------------------------------------------------- N / J5 / J6
def _by_year_sql(src: str, cols: dict[str, tuple[str, int]]) -> str:
    parts = ", ".join(f"max(CASE WHEN month(period) = {m} THEN {c} END) AS {n}" for n, (c, m) in cols.items())
    return f"SELECT nation, segment, CAST(year(period) AS INTEGER) AS year, {parts} FROM {src} GROUP BY 1, 2, 3"


AN_COLS = {"init_value": ("anom", 4), "prior_value": ("anom", 2)}
OUT_COLS = {"nov_value": ("anom", 11), "dec_value": ("anom", 12), "nov_phase": ("enso_phase", 11)}


def _analogue_sql(src: str, cols: dict) -> str:
    return f"""an AS (SELECT * EXCLUDE (cy) FROM (SELECT *, max(year) OVER (PARTITION BY nation, segment) AS cy
  FROM ({_by_year_sql(src, cols)}) y) z WHERE init_value BETWEEN 0.0 AND 0.5 AND prior_value < 0.0 AND year < cy)"""


@register("n1_analogue_search", sql=_sql_a("prepared_a", "SELECT * FROM an", [_analogue_sql("prepared_a", AN_COLS)]),
          r6=["init_value", "prior_value"])
def n1_analogue_search(spark, sf):
    return analysis.analogues(PL.prepared_a(spark, sf), K, T, "anom", month=4, lo=0.0, hi=0.5, prior_months=2)


@register("n2_analogue_outcomes", sql=_sql_a("labelled_a", "SELECT * FROM an", [_analogue_sql("labelled_a", {**AN_COLS, **OUT_COLS})]),
          r6=["init_value", "prior_value", "nov_value", "dec_value"])
def n2_analogue_outcomes(spark, sf):
    return analysis.analogues(PL.labelled_a(spark, sf), K, T, "anom", outcome=OUT_COLS)


@register("a12_analogue_ratio", sql=_sql_a("labelled_a", f"""SELECT nation, segment, count(*) AS n_analogues,
  count_if(nov_phase = {O.q(EN)}) AS n_high, CAST(count_if(nov_phase = {O.q(EN)}) AS DOUBLE) / count(*) AS high_ratio,
  avg(dec_value) AS mean_outcome, avg(CASE WHEN dec_value > 0 THEN dec_value END) AS mean_positive
FROM an GROUP BY 1, 2""", [_analogue_sql("labelled_a", {**AN_COLS, **OUT_COLS})]),
    r6=["high_ratio", "mean_outcome", "mean_positive"])
def a12_analogue_ratio(spark, sf):
    an = analysis.analogues(PL.labelled_a(spark, sf), K, T, "anom", outcome=OUT_COLS)
    return analysis.analogue_summary(an, K, "nov_phase", "dec_value")


@register("n3_trajectories", sql=_sql_a("prepared_a", """SELECT s.nation, s.segment, s.year, s.month_offset, s.period, p.anom
FROM (SELECT nation, segment, year, CAST(o AS INTEGER) AS month_offset,
             CAST(make_date(year, 4, 1) + to_months(CAST(o AS INTEGER)) AS DATE) AS period
      FROM an, range(0, 9) r(o)) s
LEFT JOIN prepared_a p ON s.nation = p.nation AND s.segment = p.segment AND s.period = p.period""",
    [_analogue_sql("prepared_a", AN_COLS)]), r6=["anom"])
def n3_trajectories(spark, sf):
    df = PL.prepared_a(spark, sf)
    an = analysis.analogues(df, K, T, "anom")
    return analysis.trajectories(an, df, K, T, "anom", 4, 12)


@register("n4_sign_agreement", sql=_sql_a("features_a", """SELECT nation, segment, anom, anom_diff1, sign(anom) = sign(anom_diff1) AS signs_agree
FROM (SELECT nation, segment, max_by(anom, CASE WHEN anom IS NOT NULL THEN period END) AS anom,
             max_by(anom_diff1, CASE WHEN anom_diff1 IS NOT NULL THEN period END) AS anom_diff1 FROM features_a GROUP BY 1, 2) s"""),
    r6=["anom", "anom_diff1"])
def n4_sign_agreement(spark, sf):
    return analysis.sign_agreement(PL.build_dataset(spark, sf), K, T, "anom", "anom_diff1")


@register("n5_exceedance", sql=_sql_a("prepared_a", """SELECT nation, segment, CAST(year(period) AS INTEGER) AS year,
  count_if(anom > 0.5) AS months_above, count_if(anom < -0.5) AS months_below, max(anom) AS peak, min(anom) AS trough
FROM prepared_a GROUP BY 1, 2, 3"""), r6=["peak", "trough"])
def n5_exceedance(spark, sf):
    return analysis.exceedance(PL.prepared_a(spark, sf), K, T, "anom")


@register("n1_analogue_all_months", sql=_sql_a("prepared_a", """SELECT p.nation, p.segment, CAST(year(p.period) AS INTEGER) AS year,
  CAST(month(p.period) AS INTEGER) AS month, p.anom AS init_value, e.anom AS prior_value
FROM (SELECT *, max(year(period)) OVER (PARTITION BY nation, segment) AS cy FROM prepared_a) p
JOIN prepared_a e ON e.nation = p.nation AND e.segment = p.segment AND CAST(e.period + INTERVAL 2 MONTH AS DATE) = p.period
WHERE p.anom BETWEEN 0.0 AND 0.5 AND e.anom < 0.0 AND year(p.period) < cy"""), r6=["init_value", "prior_value"])
def n1_analogue_all_months(spark, sf):
    return analysis.analogues(PL.prepared_a(spark, sf), K, T, "anom", month=None)


RUNS_SQL = """runs AS (SELECT nation, segment, side, min(period) AS start, max(period) AS "end", count(*) AS n_periods,
  CASE WHEN side = 'above' THEN max(anom) ELSE min(anom) END AS peak
FROM (SELECT *, sum(opens) OVER (PARTITION BY nation, segment ORDER BY period) AS run
      FROM (SELECT *, CASE WHEN side = lag(side) OVER w AND date_diff('month', lag(period) OVER w, period) = 1 THEN 0 ELSE 1 END AS opens
            FROM (SELECT *, CASE WHEN anom > 0.5 THEN 'above' WHEN anom < -0.5 THEN 'below' ELSE 'none' END AS side FROM prepared_a) s
            WINDOW w AS (PARTITION BY nation, segment ORDER BY period)) o) r
WHERE side <> 'none' GROUP BY nation, segment, run, side)"""
#: The busiest month of every order priority with the two months before and the three after it.
EVENTS_SQL = """ev AS (SELECT o_orderpriority AS event, CAST(m - INTERVAL 2 MONTH AS DATE) AS start, CAST(m + INTERVAL 3 MONTH AS DATE) AS "end"
FROM (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC, CAST(date_trunc('month', o_orderdate) AS DATE)) AS k
      FROM orders GROUP BY 1, 2) x WHERE k = 1)"""


def busy_months(spark, sf):
    o = tables.read_table(spark, sf, "orders")
    n = o.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy(F.col("o_orderpriority").alias("event")).agg(F.min_by("m", F.struct(-F.col("n"), "m")).alias("m"))
    return top.select("event", F.add_months("m", -2).alias("start"), F.add_months("m", 3).alias("end"))


@register("n5_exceedance_runs", sql=_sql_a("prepared_a", "SELECT * FROM runs", [RUNS_SQL]), r6=["peak"])
def n5_exceedance_runs(spark, sf):
    return analysis.exceedance_runs(PL.prepared_a(spark, sf), K, T, "anom")


@register("n5_event_join", sql=_sql_a("prepared_a", """SELECT r.*, e.event, e.start AS event_start, e."end" AS event_end,
  CAST(date_diff('month', greatest(r.start, e.start), least(r."end", e."end")) + 1 AS BIGINT) AS n_shared_months
FROM runs r JOIN ev e ON r.start <= e."end" AND e.start <= r."end\"""", [RUNS_SQL, EVENTS_SQL]), r6=["peak"])
def n5_event_join(spark, sf):
    runs = analysis.exceedance_runs(PL.prepared_a(spark, sf), K, T, "anom")
    return analysis.join_events(runs, busy_months(spark, sf), salts=4)


# ----------------------------------------------------------------------------- X
DROP = ["revenue", "n_orders"]
EXPORT_BASE = [c for c in O.FEATURES_A_COLS if c not in DROP]
EXPORT_COLS = [_renamed(c) for c in EXPORT_BASE] + [f"{t}_int" for t in O.TARGETS_A] + ["split"]
EXPORT_DOUBLES = [_renamed(c) for c in O.DOUBLES_A if c not in DROP]


def _export_sql() -> str:
    sel = [f"{c} AS {_renamed(c)}" for c in EXPORT_BASE] + [f"{O.label_int_sql(t)} AS {t}_int" for t in O.TARGETS_A]
    sel.append("CASE WHEN period < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split")
    where = " OR ".join(f"{t} IS NOT NULL" for t in O.TARGETS_A)
    return f"exported AS (SELECT {', '.join(sel)} FROM features_a WHERE {where})"


def export_a(spark, sf):
    return export.export_frame(PL.build_dataset(spark, sf), T, "2000-01", PL.TARGETS, drop=DROP, renames=RENAMES)


@register("x1_export", sql=_sql_a("features_a", "SELECT * FROM exported", [_export_sql()]), r6=EXPORT_DOUBLES)
def x1_export(spark, sf):
    return export_a(spark, sf)


DESCRIPTIONS = {"period": "Month the row stands for, given by its first day", "year": "Year of the row's period",
                "month": "Number of the month within its year", "month_sin": "Place in the yearly cycle, first coordinate",
                "month_cos": "Place in the yearly cycle, second coordinate",
                "revenue_anom": "Standardised monthly revenue of the series", "order_count": "Orders in the month",
                "enso_phase": "Class at time t", "split": "train / test"}
BASE_NAMES = {"revenue_anom": "Standardised revenue", "order_count": "Order count"}


def _dtype(c: str) -> str:
    if c in ("segment", "enso_phase", "split") or c in O.TARGETS_A:
        return "string"
    if c == "period":
        return "date"
    if c in ("nation", "month", "year") or c.endswith("_int"):
        return "int"
    if c in ("is_inserted", "init_in_growth_phase") or c.startswith("crosses_spring"):
        return "boolean"
    return "double"


def _x2_sql() -> str:
    rows = [f"SELECT {O.q(c)} AS \"column\", {O.q(_dtype(c))} AS dtype, count_if({c} IS NULL) AS n_missing, "
            f"{O.q(export.describe(c, DESCRIPTIONS, BASE_NAMES))} AS description FROM tr" for c in EXPORT_COLS]
    return _sql_a("features_a", " UNION ALL ".join(rows),
                  [_export_sql(), "tr AS (SELECT * FROM exported WHERE split = 'train')"])


@register("x2_data_dictionary", sql=_x2_sql())
def x2_data_dictionary(spark, sf):
    train = export_a(spark, sf).filter(F.col("split") == "train")
    return export.data_dictionary(train, DESCRIPTIONS, BASE_NAMES)


META_SKIP = set(K) | {T, "split", "enso_phase", *PL.TARGETS, *[f"{t}_int" for t in PL.TARGETS], *PL.VALUE_TARGETS}


@register("x3_metadata", sql=_sql_a("features_a", f"""SELECT min(CASE WHEN split = 'train' THEN period END) AS train_start,
  max(CASE WHEN split = 'train' THEN period END) AS train_end, min(CASE WHEN split = 'test' THEN period END) AS test_start,
  max(CASE WHEN split = 'test' THEN period END) AS test_end, count_if(split = 'train') AS n_train,
  count_if(split = 'test') AS n_test, {len([c for c in EXPORT_COLS if c not in META_SKIP])} AS n_features
FROM exported""", [_export_sql()]))
def x3_metadata(spark, sf):
    ex = export_a(spark, sf)
    n_feat = len([c for c in ex.columns if c not in META_SKIP])
    return export.metadata(ex, T, n_feat).drop("label_map")
