"""Queries for quality/leakage checks (Q), splits (L), set operations (U), sorts (T) and the
column audits (A2, A10, A11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import quality, splits
from panelcast.plans import oracle as O
from panelcast.plans import pipelines as PL
from panelcast.plans.catalog import register
from panelcast.plans.q_panel import FEATS_A, TARGET_COLS_A
from panelcast.sources import tables

K = ["nation", "segment"]
T = "period"


def _sql_a(upto, select, extra=None):
    return O.with_(*O.chain_a(upto), *(extra or [])) + select


def _one_row_unpivot_sql(src: str, items: list[tuple[str, str]], name: str, value: str, where: str = "") -> str:
    """SQL: one aggregate row turned into (name, value) rows."""
    parts = " UNION ALL ".join(f'SELECT {O.q(n)} AS "{name}", {e} AS {value} FROM {src}' for n, e in items)
    return f"SELECT * FROM ({parts}) u {where}"


# ----------------------------------------------------------------------------- Q
@register("q1_input_order", sql="""SELECT count(*) AS n_rows, count_if(coalesce(bad, false)) AS n_out_of_order FROM (
  SELECT o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS bad FROM orders) x""")
def q1_input_order(spark, sf):
    o = tables.read_table(spark, sf, "orders")
    return quality.input_order_check(o, ["o_custkey"], "o_orderkey", "o_orderdate")


@register("q1_file_order", sql="""SELECT count(*) AS n_rows, count_if(coalesce(bad, false)) AS n_out_of_order FROM (
  SELECT o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS bad FROM orders) x""")
def q1_file_order(spark, sf):
    """Orders of each customer as they lie in the files (which are written by order key), in blocks of 1,000 rows."""
    per_file = quality.file_order_check(spark, f"{sf}/orders.parquet", ["o_custkey"], "o_orderdate", block_rows=1_000)
    return per_file.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_out_of_order").alias("n_out_of_order"))


@register("q2_key_check", sql=O.with_(O.PANEL_A) + """SELECT nation, segment, count(*) AS n_rows, count(DISTINCT period) AS n_periods,
  count(*) - count(DISTINCT period) AS n_duplicates,
  CAST(date_diff('month', min(period), max(period)) + 1 - count(DISTINCT period) AS BIGINT) AS n_missing_periods,
  min(period) AS first, max(period) AS last
FROM panel_a GROUP BY 1, 2""")
def q2_key_check(spark, sf):
    return quality.key_check(tables.panel_a(spark, sf), K, T, "month")


LEAK_BASES = {"anom": [f for f in O.DOUBLE_FEATURES_A if f.startswith("anom_")],
              "orders": [f for f in O.DOUBLE_FEATURES_A if f.startswith("orders_")]}


def _q3_sql() -> str:
    leads = [(f"{b} AS {b}_l0" if k == 0 else f"lead({b}, {k}) OVER w AS {b}_l{k}")
             for b in LEAK_BASES for k in range(7)]
    rows = []
    for b, fs in LEAK_BASES.items():
        for f in fs:
            for k in range(7):
                both = f"{f} IS NOT NULL AND {b}_l{k} IS NOT NULL"
                rows.append(f"SELECT {O.q(f)} AS feature, {O.q(b)} AS base, {k} AS k, count_if({both}) AS n_compared, "
                            f"count_if({both} AND abs({f} - {b}_l{k}) < 1e-9) AS n_equal FROM lx")
    return _sql_a("features_a", " UNION ALL ".join(rows),
                  [f"lx AS (SELECT *, {', '.join(leads)} FROM features_a WINDOW w AS ({O.WA}))"])


@register("q3_future_lag_value", sql=_q3_sql())
def q3_future_lag_value(spark, sf):
    out = quality.value_leak_scan(PL.build_dataset(spark, sf), LEAK_BASES, K, T, max_k=6)
    return out.select("feature", "base", F.col("k").cast("int").alias("k"), "n_compared", "n_equal")


NUM_FEATS = [c for c in FEATS_A if c in O.DOUBLES_A or c in ("month", "year", "n_orders")]


def _q4_sql() -> str:
    rows = []
    for f in NUM_FEATS:
        for t in O.VALUE_TARGETS_A:
            both = f"{f} IS NOT NULL AND {t} IS NOT NULL"
            rows.append(f"SELECT {O.q(f)} AS feature, {O.q(t)} AS target, count_if({both}) AS n_compared, "
                        f"count_if({both} AND abs({f} - {t}) > 1e-9) AS n_mismatch FROM features_a")
    return _sql_a("features_a", " UNION ALL ".join(rows))


@register("q4_target_copy", sql=_q4_sql())
def q4_target_copy(spark, sf):
    return quality.target_copy_scan(PL.build_dataset(spark, sf), NUM_FEATS, list(O.VALUE_TARGETS_A))


def _q5_sql() -> str:
    rows = []
    for h in O.HORIZONS:
        both = f"enso_t{h} IS NOT NULL AND l{h} IS NOT NULL"
        rows.append(f"SELECT {h} AS horizon, count_if({both}) AS n_checked, count_if({both} AND enso_t{h} <> l{h}) AS n_mismatch FROM sx")
    lead = ", ".join(f"lead(enso_phase, {h}) OVER w AS l{h}" for h in O.HORIZONS)
    return _sql_a("labelled_a", " UNION ALL ".join(rows), [f"sx AS (SELECT *, {lead} FROM labelled_a WINDOW w AS ({O.WA}))"])


@register("q5_target_shift", sql=_q5_sql())
def q5_target_shift(spark, sf):
    return quality.target_shift_check(PL.labelled_a(spark, sf), K, T, "enso_phase", O.HORIZONS)


def _q6_sql() -> str:
    rows = []
    for L in (1, 3, 6):
        rows.append(f"""SELECT {L} AS lag, count_if(f.anom_lag{L} IS NOT NULL) AS n_compared,
  count_if(coalesce(abs(f.anom_lag{L} - p.anom) >= 1e-6 OR ((f.anom_lag{L} IS NULL) <> (p.anom IS NULL)), false)) AS n_mismatch
FROM features_a f LEFT JOIN features_a p ON f.nation = p.nation AND f.segment = p.segment
  AND f.period = CAST(p.period + INTERVAL {L} MONTH AS DATE)""")
    return _sql_a("features_a", " UNION ALL ".join(rows))


@register("q6_lag_alignment", sql=_q6_sql())
def q6_lag_alignment(spark, sf):
    return quality.lag_alignment(PL.build_dataset(spark, sf), "anom", K, T, (1, 3, 6)).drop("base")


@register("q7_split_integrity", sql=_sql_a("prepared_a", """SELECT nation, segment, last_train, first_test, n_overlap,
  coalesce(last_train < first_test, true) AS ordered FROM (
  SELECT nation, segment, max(CASE WHEN tr > 0 THEN period END) AS last_train, min(CASE WHEN te > 0 THEN period END) AS first_test,
         count_if(tr > 0 AND te > 0) AS n_overlap
  FROM (SELECT nation, segment, period, count_if(split = 'train') AS tr, count_if(split = 'test') AS te
        FROM (SELECT *, """ + O.SPLIT_SQL + """ AS split FROM prepared_a) s GROUP BY 1, 2, 3) k GROUP BY 1, 2) a"""))
def q7_split_integrity(spark, sf):
    df = splits.time_split(PL.prepared_a(spark, sf), T, **PL.SPLIT_A)
    return quality.split_integrity(df, K, T)


FEATURES_FOR_GATE = [c for c in FEATS_A]


def _q8_sql(leaks: str = "0, ''", names: str = "0, ''", copied: str = "") -> str:
    copies = " UNION ALL ".join(
        f"SELECT {O.q(f)} AS feature, count_if({f} IS NOT NULL AND {t} IS NOT NULL) AS c, "
        f"count_if({f} IS NOT NULL AND {t} IS NOT NULL AND abs({f} - {t}) > 1e-9) AS m FROM features_a"
        for f in NUM_FEATS for t in O.VALUE_TARGETS_A)
    shift = " + ".join(f"count_if(enso_t{h} IS NOT NULL AND l{h} IS NOT NULL AND enso_t{h} <> l{h})" for h in O.HORIZONS)
    lead = ", ".join(f"lead(enso_phase, {h}) OVER w AS l{h}" for h in O.HORIZONS)
    lag_rows = " UNION ALL ".join(
        f"""SELECT {O.q(b)} AS base, count_if(coalesce(abs(f.{b}_lag{L} - p.{b}) >= 1e-6 OR ((f.{b}_lag{L} IS NULL) <> (p.{b} IS NULL)), false)) AS n
FROM features_a f LEFT JOIN features_a p ON f.nation = p.nation AND f.segment = p.segment AND f.period = CAST(p.period + INTERVAL {L} MONTH AS DATE)"""
        for b in ("orders", "anom") for L in (1, 3, 6))
    return _sql_a("features_a", f"""SELECT "check", n_bad, n_bad = 0 AS passed, detail FROM (
SELECT 'key_unique' AS "check", CAST(coalesce(sum(n_rows - n_periods), 0) AS BIGINT) AS n_bad, 'duplicate (series, period) rows' AS detail FROM kc
UNION ALL SELECT 'grid_gapless', CAST(coalesce(sum(gap), 0) AS BIGINT), 'missing periods inside series spans' FROM kc
UNION ALL SELECT 'no_future_lags', {leaks}
UNION ALL SELECT 'no_targets_in_features', {names}
UNION ALL SELECT 'target_shift_correct', CAST({shift} AS BIGINT), 'rows where class target != lead(phase, L)' FROM sx
UNION ALL SELECT 'no_target_copies', count(*), coalesce(string_agg(feature, ', ' ORDER BY feature), '')
  FROM (SELECT feature FROM cp WHERE c > 0 AND m = 0 {copied}) copies
UNION ALL SELECT 'lag_alignment_' || base, CAST(sum(n) AS BIGINT), base || '_lagL != value at t-L' FROM la GROUP BY base) r""",
                  ["""kc AS (SELECT nation, segment, count(*) AS n_rows, count(DISTINCT period) AS n_periods,
  date_diff('month', min(period), max(period)) + 1 - count(DISTINCT period) AS gap FROM features_a GROUP BY 1, 2)""",
                   f"sx AS (SELECT *, {lead} FROM features_a WINDOW w AS ({O.WA}))",
                   f"cp AS ({copies})", f"la AS ({lag_rows})"])


@register("q8_leakage_report", sql=_q8_sql())
def q8_leakage_report(spark, sf):
    from panelcast.session import materialize
    df = materialize(PL.build_dataset(spark, sf))   # the gate fans out into several checks
    return quality.leakage_report(df, K, T, FEATURES_FOR_GATE, TARGET_COLS_A, lag_bases=["anom", "orders"])


#: What is planted: a value three months ahead, a copy of a class target, one of a value target, a target by name, a lag of no period.
PLANTED = _q8_sql("2, 'looks_harmless, other_lag0'", "1, 'enso_t1'", "UNION ALL SELECT 'class_copy' UNION ALL SELECT 'value_copy'")


@register("q8_leakage_planted", sql=PLANTED)
def q8_leakage_planted(spark, sf):
    from panelcast.operators.panel import over
    from panelcast.session import materialize
    df = PL.build_dataset(spark, sf)
    df = df.selectExpr("*", f"lead(anom, 3) {over(K, T)} AS looks_harmless", "enso_t3 AS class_copy", f"{O.VALUE_TARGETS_A[0]} AS value_copy",
                       "CAST(rand(7) AS DOUBLE) AS other_lag0")
    features = [*FEATURES_FOR_GATE, "looks_harmless", "class_copy", "value_copy", "enso_t1", "other_lag0"]
    return quality.leakage_report(materialize(df), K, T, features, TARGET_COLS_A, lag_bases=["anom", "orders"])


# ----------------------------------------------------------------------------- L
@register("l1_time_split", sql=_sql_a("prepared_a", f"SELECT nation, segment, period, {O.SPLIT_SQL} AS split FROM prepared_a"))
def l1_time_split(spark, sf):
    return splits.time_split(PL.prepared_a(spark, sf), T, **PL.SPLIT_A).select(*K, T, "split")


@register("l2_implicit_val", sql=_sql_a("panel_a", """SELECT nation, segment, period,
  CASE WHEN period <= DATE '1998-12-01' THEN 'train' WHEN period >= DATE '2000-01-01' THEN 'test'
       WHEN period > lt AND period < ft THEN 'val' END AS split
FROM (SELECT *, max(CASE WHEN period <= DATE '1998-12-01' THEN period END) OVER (PARTITION BY nation, segment) AS lt,
             min(CASE WHEN period >= DATE '2000-01-01' THEN period END) OVER (PARTITION BY nation, segment) AS ft
      FROM panel_a) x"""))
def l2_implicit_val(spark, sf):
    p = tables.panel_a(spark, sf)
    return splits.time_split(p, T, "1998-12", "2000-01", series=K).select(*K, T, "split")


@register("l3_export_split", sql=_sql_a("labelled_a", """SELECT nation, segment, period,
  CASE WHEN period < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM labelled_a"""))
def l3_export_split(spark, sf):
    return splits.export_split(PL.labelled_a(spark, sf), T, "2000-01").select(*K, T, "split")


@register("l4_walk_forward_folds", sql=_sql_a("prepared_a", """SELECT f.fold_id, CASE WHEN p.period < f.train_end THEN 'train' ELSE 'val' END AS role,
  count(*) AS n, min(p.period) AS start, max(p.period) AS "end"
FROM prepared_a p JOIN folds f ON p.period < f.val_end GROUP BY 1, 2""", ["""b AS (SELECT min(period) AS lo,
  date_diff('month', min(period), max(period)) + 1 AS span FROM prepared_a)""", """folds AS (
  SELECT CAST(k AS INTEGER) AS fold_id, CAST(lo + to_months(CAST(36 + 12 * k AS INTEGER)) AS DATE) AS train_end,
         CAST(lo + to_months(CAST(48 + 12 * k AS INTEGER)) AS DATE) AS val_end
  FROM b, range(0, CAST(floor((span - 36 - 12) / 12) + 1 AS BIGINT)) r(k))"""]))
def l4_walk_forward_folds(spark, sf):
    return splits.walk_forward_extents(PL.prepared_a(spark, sf), T, initial_years=3, step_months=12, horizon_months=12)


# ----------------------------------------------------------------------------- U
@register("u1_overlap_empty", sql=_sql_a("prepared_a", """SELECT count(*) AS n_overlap FROM (
  SELECT nation, segment, period FROM (SELECT *, """ + O.SPLIT_SQL + """ AS split FROM prepared_a) s WHERE split = 'train'
  INTERSECT
  SELECT nation, segment, period FROM (SELECT *, """ + O.SPLIT_SQL + """ AS split FROM prepared_a) s WHERE split = 'test') i"""))
def u1_overlap_empty(spark, sf):
    df = splits.time_split(PL.prepared_a(spark, sf), T, **PL.SPLIT_A)
    tr = df.filter(F.col("split") == "train").select(*K, T)
    te = df.filter(F.col("split") == "test").select(*K, T)
    return tr.intersect(te).agg(F.count(F.lit(1)).alias("n_overlap"))


@register("u3_union_history", sql=_sql_a("prepared_a", """SELECT nation, segment, period, split FROM (SELECT *, """ + O.SPLIT_SQL
                                         + """ AS split FROM prepared_a) s WHERE split IN ('train', 'test')"""))
def u3_union_history(spark, sf):
    df = splits.time_split(PL.prepared_a(spark, sf), T, **PL.SPLIT_A).select(*K, T, "split")
    return df.filter(F.col("split") == "train").unionByName(df.filter(F.col("split") == "test"))


# ----------------------------------------------------------------------------- T
@register("t1_sorted_export", sql=_sql_a("prepared_a", "SELECT nation, segment, period, anom FROM prepared_a"), r6=["anom"])
def t1_sorted_export(spark, sf):
    # sort inside partitions before a write: files come out clustered without a global sort
    return PL.prepared_a(spark, sf).select(*K, T, "anom").sortWithinPartitions(*K, T)


@register("t3_topk_abs", sql=_sql_a("prepared_a", """SELECT nation, segment, period, abs(anom) AS abs_anom FROM prepared_a
WHERE anom IS NOT NULL ORDER BY abs(anom) DESC, nation, segment, period LIMIT 10"""), r6=["abs_anom"])
def t3_topk_abs(spark, sf):
    from panelcast.operators.analysis import top_k
    df = PL.prepared_a(spark, sf).select(*K, T, F.abs("anom").alias("abs_anom"))
    return top_k(df, "abs_anom", 10, [*K, T])


GRID_VALUE_COLS = ["revenue", "n_orders"]


@register("t4_order_missing", sql=_sql_a("grid_a", _one_row_unpivot_sql(
    "(SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in GRID_VALUE_COLS) + " FROM grid_a) g",
    [(c, c) for c in GRID_VALUE_COLS], "column", "n_missing", "WHERE n_missing > 0 ORDER BY n_missing DESC")))
def t4_order_missing(spark, sf):
    from panelcast.operators.panel import regular_grid
    g = regular_grid(tables.panel_a(spark, sf), K, T)
    return quality.missing_counts(g, GRID_VALUE_COLS).orderBy(F.col("n_missing").desc(), "column")


@register("t5_full_shift_check", sql=_q5_sql())
def t5_full_shift_check(spark, sf):
    # every row, every horizon (not the first 20 non-missing rows)
    return quality.target_shift_check(PL.labelled_a(spark, sf), K, T, "enso_phase", O.HORIZONS)


# ----------------------------------------------------------------------------- A2 / A10 / A11
@register("a2_missing_counts", sql=_sql_a("features_a", _one_row_unpivot_sql(
    "(SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in O.FEATURES_A_COLS) + " FROM features_a) g",
    [(c, c) for c in O.FEATURES_A_COLS], "column", "n_missing", "WHERE n_missing > 0")))
def a2_missing_counts(spark, sf):
    return quality.missing_counts(PL.build_dataset(spark, sf))


QC_COLS = ["anom", "anom_lag1", "anom_rm3", "anom_diff1", "orders", "orders_rstd3"]


@register("a10_range_qc", sql=_sql_a("features_a", 'SELECT "column", max_abs, max_abs > 10.0 AS over_limit FROM (' + _one_row_unpivot_sql(
    "(SELECT " + ", ".join(f"CAST(max(abs({c})) AS DOUBLE) AS {c}" for c in QC_COLS) + " FROM features_a) g",
    [(c, c) for c in QC_COLS], "column", "max_abs") + ") z"), r6=["max_abs"])
def a10_range_qc(spark, sf):
    return quality.range_qc(PL.build_dataset(spark, sf), QC_COLS, 10.0)


AUDIT = ["o_orderstatus", "o_orderpriority", "total_text"]


@register("a11_numeric_audit", sql=_one_row_unpivot_sql(
    "(SELECT " + ", ".join(f"count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS {c}" for c in AUDIT)
    + " FROM (SELECT o_orderstatus, o_orderpriority, CAST(o_totalprice AS VARCHAR) AS total_text FROM orders) o) g",
    [(c, c) for c in AUDIT], "column", "n_non_numeric"))
def a11_numeric_audit(spark, sf):
    o = tables.read_table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("string").alias("total_text"))
    return quality.numeric_audit(o, AUDIT)

