"""Queries for sources (S), projections/filters (P), joins (J), composites (C), windows (W)
and scalar functions (F), each over panels derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import scalar as fx
from panelcast.operators import features, labels, panel, splits
from panelcast.plans import oracle as O
from panelcast.plans import pipelines as PL
from panelcast.plans.catalog import register
from panelcast.sources import tables, text

K = ["nation", "segment"]
T = "period"
MONTHS = text.MONTH_COLS


# ----------------------------------------------------------------------------- helpers
def wide_b(spark, sf):
    """Panel B pivoted to year x month with the -999.9 sentinel where a month is absent."""
    pb = tables.panel_b(spark, sf)
    return pb.groupBy("supplier", F.year(T).cast("int").alias("year")).agg(
        *[F.coalesce(F.max(F.when(F.month(T) == i + 1, F.col("qty"))), F.lit(-999.9)).alias(m)
          for i, m in enumerate(MONTHS)])


WIDE_B_SQL = O.PANEL_B + ",\nwide_b AS (SELECT supplier, CAST(year(period) AS INTEGER) AS year, " + ", ".join(
    f"coalesce(max(CASE WHEN month(period) = {i + 1} THEN qty END), -999.9) AS {m}" for i, m in enumerate(MONTHS)
) + " FROM panel_b GROUP BY 1, 2)"
MONTH_NO_SQL = "CASE mon " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MONTHS)) + " END"


def _sql_a(upto: str, select: str, extra: list[str] | None = None) -> str:
    return O.with_(*O.chain_a(upto), *(extra or [])) + select


# ----------------------------------------------------------------------------- S
@register("s4_wide_to_long", sql=f"""WITH {WIDE_B_SQL}
SELECT supplier, make_date(year, {MONTH_NO_SQL}, 1) AS period,
       CASE WHEN qty = -999.9 THEN NULL ELSE qty END AS qty
FROM wide_b UNPIVOT INCLUDE NULLS (qty FOR mon IN ({', '.join(MONTHS)}))""", r6=["qty"])
def s4_wide_to_long(spark, sf):
    return text.wide_to_long(wide_b(spark, sf), ["supplier"], "qty")


@register("s6_sentinel", sql=f"""WITH {WIDE_B_SQL}
SELECT supplier, year, {', '.join(f'CASE WHEN {m} = -999.9 THEN NULL ELSE {m} END AS {m}' for m in MONTHS)}
FROM wide_b""", r6=list(MONTHS))
def s6_sentinel(spark, sf):
    return text.replace_sentinels(wide_b(spark, sf), MONTHS, text.WIDE_SENTINELS)


@register("s8_registry", sql=O.with_(O.ORDERS_BY_NATION, O.LINES_BY_NATION, O.PANEL_C) + "SELECT * FROM panel_c")
def s8_registry(spark, sf):
    return text.registry({
        "orders": (lambda: tables.orders_by_nation(spark, sf), True),
        "lineitems": (lambda: tables.lineitems_by_nation(spark, sf), True),
        "events": (lambda: tables.panel_d(spark, sf), False),   # optional source, off by default
    }, on=["nation", T])


@register("s9_parquet_scan", sql="""SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date
FROM orders""")
def s9_parquet_scan(spark, sf):
    o = tables.read_table(spark, sf, "orders", explicit_schema=True)
    return o.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_date"))


# ----------------------------------------------------------------------------- P
@register("p1_time_range", sql=_sql_a("prepared_a", """SELECT nation, segment, period, revenue, anom FROM prepared_a
WHERE period >= DATE '1996-01-01' AND period <= DATE '2000-12-01'"""), r6=["anom"])
def p1_time_range(spark, sf):
    return panel.filter_time_range(PL.prepared_a(spark, sf), T, "1996-01", "2000-12").select(*K, T, "revenue", "anom")


@register("p2_coerce_numeric", sql=r"""SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS event_type,
       TRY_CAST(regexp_extract(props, ':\s*([^}]*)', 1) AS DOUBLE) AS k FROM events""")
def p2_coerce_numeric(spark, sf):
    e = tables.read_table(spark, sf, "events").select(
        "event_id", "event_type", F.regexp_extract("props", r":\s*([^}]*)", 1).alias("k"))
    return panel.coerce_numeric(e, ["event_type", "k"])


@register("p3_make_date", sql=O.with_(O.PANEL_B) + """SELECT supplier, CAST(year(period) AS INTEGER) AS y,
       CAST(month(period) AS INTEGER) AS m, make_date(year(period), month(period), 1) AS rebuilt FROM panel_b""")
def p3_make_date(spark, sf):
    b = tables.panel_b(spark, sf).select("supplier", F.year(T).cast("int").alias("y"), F.month(T).cast("int").alias("m"))
    return b.select("*", fx.make_month("y", "m").alias("rebuilt"))


@register("p4_month_trunc", sql="""SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
FROM lineitem""")
def p4_month_trunc(spark, sf):
    li = tables.read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fx.period_of("l_shipdate", "month").alias("ship_month"))


DROP_RAW = ["revenue", "n_orders"]


@register("p5_drop_raw", sql=_sql_a("features_a", "SELECT * EXCLUDE (revenue, n_orders) FROM features_a"),
          r6=[c for c in O.DOUBLES_A if c not in DROP_RAW])
def p5_drop_raw(spark, sf):
    from panelcast.operators.export import drop_columns
    return drop_columns(PL.build_dataset(spark, sf), DROP_RAW)


RENAMES = {"anom": "revenue_anom", "orders": "order_count"}


def _renamed(c: str) -> str:
    for old, new in RENAMES.items():
        if c == old or c.startswith(old + "_"):
            return new + c[len(old):]
    return c


@register("p6_prefix_rename", sql=_sql_a("features_a", "SELECT " + ", ".join(
    f"{c} AS {_renamed(c)}" for c in O.FEATURES_A_COLS) + " FROM features_a"),
    r6=[_renamed(c) for c in O.DOUBLES_A])
def p6_prefix_rename(spark, sf):
    from panelcast.operators.export import prefix_rename
    return prefix_rename(PL.build_dataset(spark, sf), RENAMES)


TARGET_COLS_A = ["enso_phase", *O.TARGETS_A, *O.VALUE_TARGETS_A]
FEATS_A = [c for c in O.FEATURES_A_COLS if c not in TARGET_COLS_A + K + [T]]
NUMERIC_FEATS_A = [c for c in FEATS_A if c not in ("is_inserted", "init_in_growth_phase")
                   and not c.startswith("crosses_spring")]


@register("p7_feature_columns", sql=_sql_a("features_a", f"SELECT nation, segment, period, {', '.join(FEATS_A)} FROM features_a"),
          r6=[c for c in O.DOUBLES_A if c in FEATS_A])
def p7_feature_columns(spark, sf):
    df = PL.build_dataset(spark, sf)
    return df.select(*K, T, *features.feature_columns(df, TARGET_COLS_A, K, T))


@register("p8_numeric_features", sql=_sql_a("features_a", f"SELECT nation, segment, period, {', '.join(NUMERIC_FEATS_A)} FROM features_a"),
          r6=[c for c in O.DOUBLES_A if c in NUMERIC_FEATS_A])
def p8_numeric_features(spark, sf):
    df = PL.build_dataset(spark, sf)
    return df.select(*K, T, *features.feature_columns(df, TARGET_COLS_A, K, T, numeric_only=True, include_bool=False))


TRAIN_SUBSET = ["anom", "anom_lag1", "anom_lag3", "anom_lag6", "anom_rm3", "anom_rstd3", "anom_diff1", "enso_t1"]


@register("p9_dropna_any", sql=_sql_a("features_a", "SELECT nation, segment, period FROM features_a WHERE period <= DATE '1998-12-01' AND "
                                      + " AND ".join(f"{c} IS NOT NULL" for c in TRAIN_SUBSET)))
def p9_dropna_any(spark, sf):
    df = PL.build_dataset(spark, sf).filter(F.col(T) <= F.lit("1998-12-01").cast("date"))
    return df.dropna("any", subset=TRAIN_SUBSET).select(*K, T)


@register("p10_dropna_all", sql=_sql_a("features_a", "SELECT nation, segment, period FROM features_a WHERE "
                                       + " OR ".join(f"{c} IS NOT NULL" for c in O.TARGETS_A)))
def p10_dropna_all(spark, sf):
    return PL.build_dataset(spark, sf).dropna("all", subset=list(O.TARGETS_A)).select(*K, T)


@register("p11_labelled_rows", sql=_sql_a("labelled_a", "SELECT nation, segment, period, enso_t3 FROM labelled_a "
                                          "WHERE period >= DATE '2000-01-01' AND enso_t3 IS NOT NULL"))
def p11_labelled_rows(spark, sf):
    df = PL.labelled_a(spark, sf).filter(F.col(T) >= F.lit("2000-01-01").cast("date"))
    return df.filter(F.col("enso_t3").isNotNull()).select(*K, T, "enso_t3")


FILL0 = ["anom_lag1", "anom_lag3", "anom_lag6", "anom_rm3", "anom_rstd3", "anom_diff1"]


@register("p12_fillna_zero", sql=_sql_a("features_a", "SELECT nation, segment, period, " + ", ".join(
    f"coalesce({c}, 0.0) AS {c}" for c in FILL0) + " FROM features_a"), r6=FILL0)
def p12_fillna_zero(spark, sf):
    return PL.build_dataset(spark, sf).fillna(0.0, subset=FILL0).select(*K, T, *FILL0)


@register("p13_month_filter", sql=_sql_a("prepared_a", "SELECT nation, segment, period, anom FROM prepared_a WHERE month(period) = 4"),
          r6=["anom"])
def p13_month_filter(spark, sf):
    return PL.prepared_a(spark, sf).filter(fx.in_months(F.month(T), [4])).select(*K, T, "anom")


@register("p14_between_compound", sql=_sql_a("prepared_a", """SELECT nation, segment, period FROM prepared_a
WHERE anom BETWEEN -0.5 AND 0.5 AND orders >= 5 AND year(period) < 2000"""))
def p14_between_compound(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.filter(F.col("anom").between(-0.5, 0.5) & (F.col("orders") >= 5) & (F.year(T) < 2000)).select(*K, T)


@register("p15_label_slice", sql=_sql_a("labelled_a", """SELECT nation, segment, period, anom, enso_phase FROM labelled_a
WHERE period BETWEEN DATE '1999-01-01' AND DATE '1999-06-01'"""), r6=["anom"])
def p15_label_slice(spark, sf):
    df = panel.filter_time_range(PL.labelled_a(spark, sf), T, "1999-01", "1999-06")
    return df.select(*K, T, "anom", "enso_phase")


# ----------------------------------------------------------------------------- J
@register("j1_full_outer_merge", sql=O.with_(O.ORDERS_BY_NATION, O.LINES_BY_NATION, O.PANEL_C) + "SELECT * FROM panel_c")
def j1_full_outer_merge(spark, sf):
    return panel.merge_sources([tables.orders_by_nation(spark, sf), tables.lineitems_by_nation(spark, sf)], ["nation", T])


@register("j2_reindex_grid", sql=_sql_a("grid_a", "SELECT nation, segment, period, revenue, n_orders FROM grid_a"))
def j2_reindex_grid(spark, sf):
    return panel.reindex(tables.panel_a(spark, sf), K, T, "month")


@register("j3_inner_nonnull", sql=O.with_(O.ORDERS_BY_NATION, O.LINES_BY_NATION) + """SELECT nation, period, o.order_revenue, l.ship_qty
FROM obn o JOIN lbn l USING (nation, period) WHERE o.order_revenue IS NOT NULL AND l.ship_qty IS NOT NULL""")
def j3_inner_nonnull(spark, sf):
    o = tables.orders_by_nation(spark, sf).select("nation", T, "order_revenue")
    li = tables.lineitems_by_nation(spark, sf).select("nation", T, "ship_qty")
    return o.join(li, ["nation", T], "inner").dropna(subset=["order_revenue", "ship_qty"])


@register("j4_shift_join", sql=O.with_(O.PANEL_A) + """SELECT p.nation, p.segment, p.period, p.revenue, q.revenue AS revenue_shift2
FROM panel_a p LEFT JOIN panel_a q ON p.nation = q.nation AND p.segment = q.segment
 AND p.period = CAST(q.period + INTERVAL 2 MONTH AS DATE)""")
def j4_shift_join(spark, sf):
    p = tables.panel_a(spark, sf).select(*K, T, "revenue")
    return panel.shift_join(p, ["revenue"], K, T, 2)


@register("j7_lookup_join", sql=_sql_a("labelled_a", """SELECT t.nation, t.segment, t.period, t.month, d.high_share
FROM (SELECT *, CAST(month(period) AS INTEGER) AS month FROM labelled_a WHERE period > DATE '1998-12-01') t
LEFT JOIN dim d USING (month)""", [f"""dim AS (SELECT CAST(month(period) AS INTEGER) AS month,
  CAST(count_if(enso_phase = {O.q(fx.LABELS[2])}) AS DOUBLE) / count(enso_phase) AS high_share
  FROM labelled_a WHERE period <= DATE '1998-12-01' GROUP BY 1)"""]), r6=["high_share"])
def j7_lookup_join(spark, sf):
    from panelcast.operators.analysis import month_lookup
    df = PL.labelled_a(spark, sf).withColumn("month", F.month(T).cast("int"))
    train = df.filter(F.col(T) <= F.lit("1998-12-01").cast("date"))
    dim = month_lookup(train, (F.count_if(F.col("enso_phase") == fx.LABELS[2]).cast("double")
                               / F.count("enso_phase")).alias("high_share"))
    later = df.filter(F.col(T) > F.lit("1998-12-01").cast("date")).select(*K, T, "month")   # all after the training period
    return later.join(F.broadcast(dim), "month", "left")   # dim: at most 12 rows


@register("j8_walk_forward", sql=_sql_a("prepared_a", """SELECT p.nation, p.segment, p.period, f.fold_id,
  CASE WHEN p.period < f.train_end THEN 'train' ELSE 'val' END AS role
FROM prepared_a p JOIN folds f ON p.period < f.val_end""", ["""b AS (SELECT min(period) AS lo, max(period) AS hi,
  date_diff('month', min(period), max(period)) + 1 AS span FROM prepared_a)""", """folds AS (
  SELECT CAST(k AS INTEGER) AS fold_id, CAST(lo + to_months(CAST(36 + 12 * k AS INTEGER)) AS DATE) AS train_end,
         CAST(lo + to_months(CAST(48 + 12 * k AS INTEGER)) AS DATE) AS val_end
  FROM b, range(0, CAST(floor((span - 36 - 12) / 12) + 1 AS BIGINT)) r(k))"""]))
def j8_walk_forward(spark, sf):
    from panelcast.session import materialize
    # the fold bounds (one scalar aggregate) and the folds read one materialised panel, not the raw facts twice
    f = splits.walk_forward(materialize(PL.prepared_a(spark, sf)), T, initial_years=3, step_months=12, horizon_months=12)
    return f.select(*K, T, "fold_id", "role")


# ----------------------------------------------------------------------------- C
@register("c1_grid", sql=_sql_a("grid_a", "SELECT * FROM grid_a"))
def c1_grid(spark, sf):
    return panel.regular_grid(tables.panel_a(spark, sf), K, T, "month")


C2_SQL = O.with_(O.PANEL_A, """panel_f AS (SELECT * FROM panel_a WHERE period >= DATE '1995-06-01' AND period <= DATE '2001-03-01')""",
                 O.GRID_A.replace("FROM panel_a", "FROM panel_f"), O.FILLED_A) + "SELECT * FROM filled_a"


@register("c2_clean", sql=C2_SQL)
def c2_clean(spark, sf):
    return panel.clean(tables.panel_a(spark, sf), K, T, start="1995-06", end="2001-03", max_gap=3)


LABEL_OUT = ["enso_phase", *[c for h in O.HORIZONS for c in (f"enso_t{h}", f"nino34_t{h}")]]


@register("c3_label", sql=_sql_a("labelled_a", f"SELECT nation, segment, period, anom, {', '.join(LABEL_OUT)} FROM labelled_a"),
          r6=["anom", *O.VALUE_TARGETS_A])
def c3_label(spark, sf):
    return PL.labelled_a(spark, sf).select(*K, T, "anom", *LABEL_OUT)


@register("c4_features", sql=_sql_a("features_a", "SELECT * FROM features_a"), r6=O.DOUBLES_A)
def c4_features(spark, sf):
    return PL.build_dataset(spark, sf)


SPRING = [f"crosses_spring_t{h}" for h in O.HORIZONS] + ["init_in_growth_phase"]


@register("c5_spring_features", sql=_sql_a("features_a", f"SELECT nation, segment, period, {', '.join(SPRING)} FROM features_a"))
def c5_spring_features(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *features.barrier_exprs(T, O.HORIZONS))


# ----------------------------------------------------------------------------- W
def _wsql(exprs: list[str], sizes=(3,), src="prepared_a", upto="prepared_a") -> str:
    return _sql_a(upto, f"SELECT nation, segment, period, {', '.join(exprs)} FROM {src} {O.windows_sql(sizes=sizes)}")


@register("w1_lags", sql=_wsql([f"lag({b}, {L}) OVER w AS {b}_lag{L}" for b in O.BASE_A for L in (1, 3, 6)]),
          r6=[f"{b}_lag{L}" for b in O.BASE_A for L in (1, 3, 6)])
def w1_lags(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *[e for b in O.BASE_A for e in features.lag_exprs(b, K, T, (1, 3, 6))])


RM = [f"CASE WHEN count({b}) OVER w{W} >= 2 THEN avg({b}) OVER w{W} END AS {b}_rm{W}" for b in O.BASE_A for W in (3, 6)]


@register("w2_rolling_mean", sql=_wsql(RM, sizes=(3, 6)), r6=[f"{b}_rm{W}" for b in O.BASE_A for W in (3, 6)])
def w2_rolling_mean(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *[e for b in O.BASE_A for e in features.rolling_mean_exprs(b, K, T, (3, 6))])


RS = [f"CASE WHEN count({b}) OVER w{W} >= 2 THEN stddev_samp({b}) OVER w{W} END AS {b}_rstd{W}" for b in O.BASE_A for W in (3, 6)]


@register("w3_rolling_std", sql=_wsql(RS, sizes=(3, 6)), r6=[f"{b}_rstd{W}" for b in O.BASE_A for W in (3, 6)])
def w3_rolling_std(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *[e for b in O.BASE_A for e in features.rolling_std_exprs(b, K, T, (3, 6))])


@register("w4_diff", sql=_wsql([f"{b} - lag({b}, {P}) OVER w AS {b}_diff{P}" for b in O.BASE_A for P in (1, 12)]),
          r6=[f"{b}_diff{P}" for b in O.BASE_A for P in (1, 12)])
def w4_diff(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *[e for b in O.BASE_A for e in features.diff_exprs(b, K, T, (1, 12))])


@register("w5_smooth", sql=_sql_a("labelled_a", "SELECT nation, segment, period, sm AS anom_smooth FROM smooth_a"),
          r6=["anom_smooth"])
def w5_smooth(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, labels.smooth("anom", K, T, 3, 2).alias("anom_smooth"))


@register("w6_lead_target", sql=_sql_a("labelled_a", "SELECT nation, segment, period, " + ", ".join(
    f"lead(sm, {h}) OVER w AS anom_lead{h}" for h in O.HORIZONS) + " FROM smooth_a " + O.windows_sql(sizes=())),
    r6=[f"anom_lead{h}" for h in O.HORIZONS])
def w6_lead_target(spark, sf):
    df = PL.prepared_a(spark, sf)
    s = df.select(*K, T, labels.smooth("anom", K, T).alias("__sm"))
    w = panel.ordered(K, T)
    return s.select(*K, T, *[F.lead("__sm", h).over(w).alias(f"anom_lead{h}") for h in O.HORIZONS])


@register("w7_ffill_limit", sql=_sql_a("filled_a", "SELECT * FROM filled_a"))
def w7_ffill_limit(spark, sf):
    g = panel.regular_grid(tables.panel_a(spark, sf), K, T, "month")
    return panel.ffill(g, ["revenue", "n_orders"], K, T, limit=3)


@register("w8_ffill_unbounded", sql=_sql_a("grid_a", """SELECT nation, segment, period,
  last_value(revenue IGNORE NULLS) OVER (PARTITION BY nation, segment ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS revenue
FROM grid_a WHERE period >= DATE '2000-01-01'"""))
def w8_ffill_unbounded(spark, sf):
    g = panel.regular_grid(tables.panel_a(spark, sf), K, T, "month").filter(F.col(T) >= F.lit("2000-01-01").cast("date"))
    return panel.ffill(g.select(*K, T, "revenue"), ["revenue"], K, T, limit=None)


@register("w9_current_state", sql=_sql_a("grid_a", """SELECT nation, segment, max(period) AS period,
  max_by(revenue, CASE WHEN revenue IS NOT NULL THEN period END) AS revenue,
  max_by(n_orders, CASE WHEN n_orders IS NOT NULL THEN period END) AS n_orders
FROM grid_a WHERE period <= DATE '2000-06-01' GROUP BY 1, 2"""))
def w9_current_state(spark, sf):
    g = panel.regular_grid(tables.panel_a(spark, sf), K, T, "month")
    return panel.current_state(g, ["revenue", "n_orders"], K, T, at="2000-06")


@register("w10_latest_valid", sql=_sql_a("grid_a", """SELECT nation, segment,
  max_by(revenue, CASE WHEN revenue IS NOT NULL THEN period END) AS revenue,
  max(CASE WHEN revenue IS NOT NULL THEN period END) AS revenue_period
FROM grid_a GROUP BY 1, 2"""))
def w10_latest_valid(spark, sf):
    g = panel.regular_grid(tables.panel_a(spark, sf), K, T, "month")
    return panel.latest_valid(g, ["revenue"], K, T)


# ----------------------------------------------------------------------------- F
@register("f1_phase", sql=_sql_a("prepared_a", f"SELECT nation, segment, period, {O.phase_sql('anom')} AS anom_phase FROM prepared_a"))
def f1_phase(spark, sf):
    return PL.prepared_a(spark, sf).select(*K, T, fx.phase_label("anom").alias("anom_phase"))


@register("f2_month_sincos", sql=_sql_a("prepared_a", """SELECT nation, segment, period,
  sin(2 * pi() * CAST(month(period) AS DOUBLE) / 12.0) AS month_sin, cos(2 * pi() * CAST(month(period) AS DOUBLE) / 12.0) AS month_cos
FROM prepared_a"""), r6=["month_sin", "month_cos"])
def f2_month_sincos(spark, sf):
    m = F.month(T)
    return PL.prepared_a(spark, sf).select(*K, T, fx.month_sin(m).alias("month_sin"), fx.month_cos(m).alias("month_cos"))


@register("f3_month_year", sql=_sql_a("prepared_a", """SELECT nation, segment, period, CAST(month(period) AS INTEGER) AS month,
  CAST(year(period) AS INTEGER) AS year FROM prepared_a"""))
def f3_month_year(spark, sf):
    return PL.prepared_a(spark, sf).select(*K, T, F.month(T).cast("int").alias("month"), F.year(T).cast("int").alias("year"))


F4_H = (1, 2, 3, 6, 9, 12)
F4_SQL_DYN = "CASE h " + " ".join(
    f"WHEN {h} THEN month(period) IN ({', '.join(map(str, fx.crossing_months(h)))})" for h in range(1, 13)) + " END"


@register("f4_crosses_spring", sql=_sql_a("prepared_a", "SELECT nation, segment, period, h, " + ", ".join(
    f"month(period) IN ({', '.join(map(str, fx.crossing_months(h)))}) AS crosses_t{h}" for h in F4_H)
    + f", {F4_SQL_DYN} AS crosses_h FROM (SELECT *, CAST(nation % 12 + 1 AS INTEGER) AS h FROM prepared_a) p"))
def f4_crosses_spring(spark, sf):
    df = PL.prepared_a(spark, sf).select(*K, T, (F.pmod(F.col("nation"), F.lit(12)) + 1).cast("int").alias("h"))
    m = F.month(T)
    return df.select(*K, T, "h", *[fx.crosses_barrier(m, h).alias(f"crosses_t{h}") for h in F4_H],
                     fx.crosses_barrier(m, F.col("h")).alias("crosses_h"))


@register("f5_growth_phase", sql=_sql_a("prepared_a", """SELECT nation, segment, period,
  month(period) IN (6, 7, 8, 9, 10, 11) AS init_in_growth_phase FROM prepared_a"""))
def f5_growth_phase(spark, sf):
    return PL.prepared_a(spark, sf).select(*K, T, fx.in_months(F.month(T)).alias("init_in_growth_phase"))


@register("f6_round2", sql=_sql_a("prepared_a", f"SELECT nation, segment, period, {O.rint_sql('anom', 2)} AS anom_r2 FROM prepared_a"))
def f6_round2(spark, sf):
    return PL.prepared_a(spark, sf).select(*K, T, fx.round_half_even("anom", 2).alias("anom_r2"))


@register("f7_cyclic_phase", sql="""SELECT event_id, CAST(user_id % 8 + 1 AS INTEGER) AS phase,
  CASE WHEN value >= 25.0 THEN sin(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END AS phase_sin,
  CASE WHEN value >= 25.0 THEN cos(2 * pi() * (CAST(user_id % 8 + 1 AS DOUBLE) - 1.0) / 8.0) ELSE 0.0 END AS phase_cos
FROM events""", r6=["phase_sin", "phase_cos"])
def f7_cyclic_phase(spark, sf):
    e = tables.read_table(spark, sf, "events").select("event_id", "value", (F.col("user_id") % 8 + 1).cast("int").alias("phase"))
    return e.select("event_id", "phase", fx.cyclic_sin("phase", "value", 25.0).alias("phase_sin"),
                    fx.cyclic_cos("phase", "value", 25.0).alias("phase_cos"))


@register("f8_label_int", sql=_sql_a("labelled_a", "SELECT nation, segment, period, " + ", ".join(
    f"{O.label_int_sql(t)} AS {t}_int" for t in O.TARGETS_A) + " FROM labelled_a"))
def f8_label_int(spark, sf):
    return PL.labelled_a(spark, sf).select(*K, T, *[fx.label_to_int(t).alias(f"{t}_int") for t in O.TARGETS_A])


@register("f10_lead_from_name", sql=O.with_(*O.predictions_a_sql()) + """SELECT DISTINCT target, model,
  CAST(regexp_extract(target, 't([0-9]+)$', 1) AS INTEGER) AS lead FROM preds""")
def f10_lead_from_name(spark, sf):
    return PL.predictions_a(spark, sf).select("target", "model").distinct().select(
        "target", "model", fx.lead_from_name("target").alias("lead"))


@register("f12_add_months", sql=_sql_a("prepared_a", """SELECT nation, segment, period,
  CAST(period + INTERVAL 1 MONTH AS DATE) AS period_p1, CAST(period + INTERVAL 3 MONTH AS DATE) AS period_p3,
  CAST(period + INTERVAL 6 MONTH AS DATE) AS period_p6, CAST(period - INTERVAL 12 MONTH AS DATE) AS period_m12 FROM prepared_a"""))
def f12_add_months(spark, sf):
    df = PL.prepared_a(spark, sf)
    return df.select(*K, T, *[fx.add_periods(T, k).alias(n) for k, n in
                              ((1, "period_p1"), (3, "period_p3"), (6, "period_p6"), (-12, "period_m12"))])


# ----------------------------------------------------------------------------- larger panels (scale)
LAB_B = ["supplier", "period", "qty", "n_lines", "is_inserted", "anom", *LABEL_OUT]


@register("c3_label_supplier", sql=O.with_(O.PANEL_B, *O.generic_chain("panel_b", ["supplier"], "qty", "n_lines"))
          + f"SELECT {', '.join(LAB_B)} FROM g_labelled", r6=["anom", *O.VALUE_TARGETS_A])
def c3_label_supplier(spark, sf):
    return PL.labelled_panel(tables.panel_b(spark, sf), "supplier", "qty", "n_lines").select(*LAB_B)


@register("w7_ffill_hourly", sql=O.with_(O.PANEL_E, *O.generic_chain("panel_e", ["user_id"], "sum_value", "n_events", "hour")[:4])
          + "SELECT * FROM g_filled")
def w7_ffill_hourly(spark, sf):
    g = panel.regular_grid(tables.panel_e(spark, sf), "user_id", T, "hour")
    return panel.ffill(g, ["sum_value", "n_events"], "user_id", T, limit=3)


@register("c1_grid_daily", sql=O.with_("""panel_d AS (SELECT event_type, CAST(ts AS DATE) AS period, avg(value) AS avg_value,
  count(*) AS n_events FROM events GROUP BY 1, 2)""", *O.generic_chain("panel_d", ["event_type"], "avg_value", "n_events", "day")[:3])
          + "SELECT * FROM g_grid", r6=["avg_value"])
def c1_grid_daily(spark, sf):
    return panel.regular_grid(tables.panel_d(spark, sf), "event_type", T, "day")


@register("c4_features_bucketed", sql=_sql_a("features_a", "SELECT * FROM features_a"), r6=O.DOUBLES_A)
def c4_features_bucketed(spark, sf):
    """Same result as c4_features through the skew-safe path (time buckets + halo rows)."""
    return PL.build_dataset_bucketed(spark, sf, bucket=12)


@register("c4_features_routed", sql=_sql_a("features_a", "SELECT * FROM features_a"), r6=O.DOUBLES_A)
def c4_features_routed(spark, sf):
    """Same result as c4_features: series of over 78 months in buckets, the others by the plain plan, one read of the facts."""
    return PL.build_dataset_routed(spark, sf, max_periods=78, bucket=12)


@register("w8_ffill_unbounded_bucketed", sql=_sql_a("grid_a", """SELECT nation, segment, period,
  last_value(revenue IGNORE NULLS) OVER (PARTITION BY nation, segment ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS revenue
FROM grid_a WHERE period >= DATE '2000-01-01'"""))
def w8_ffill_unbounded_bucketed(spark, sf):
    """Same result as w8_ffill_unbounded through the skew-safe carry (buckets of 6 months)."""
    g = panel.regular_grid(tables.panel_a(spark, sf), K, T, "month").filter(F.col(T) >= F.lit("2000-01-01").cast("date"))
    return panel.ffill_bucketed(g.select(*K, T, "revenue"), ["revenue"], K, T, bucket=6)


GAPPED_FEATS = [f"{b}_{s}" for b in ("revenue",) for s in ("lag1", "lag3", "lag6", "rm3", "rstd3", "diff1")]


GAPPED_SQL = _sql_a("grid_a", f"""SELECT nation, segment, period, {', '.join(GAPPED_FEATS)} FROM (
  SELECT nation, segment, period, is_inserted, {', '.join(O.feature_sql(['revenue'], calendar=False))}
  FROM grid_a {O.windows_sql()}) g WHERE NOT is_inserted""")


@register("c4_features_gapped", sql=GAPPED_SQL, r6=GAPPED_FEATS)
def c4_features_gapped(spark, sf):
    """Features on the ungridded panel with RANGE frames equal grid-then-features on observed rows."""
    p = tables.panel_a(spark, sf).select(*K, T, "revenue")
    out = features.build_features(p, ["revenue"], K, T, calendar=False, gapped="month")
    return out.select(*K, T, *GAPPED_FEATS)


@register("c1_grid_hourly_bucketed", sql=O.with_(O.PANEL_E, *O.generic_chain("panel_e", ["user_id"], "sum_value", "n_events", "hour")[:3])
          + "SELECT * FROM g_grid")
def c1_grid_hourly_bucketed(spark, sf):
    """Hourly grid through the skew-safe bucketed builder (24-hour buckets); equals the plain grid."""
    return panel.regular_grid_bucketed(tables.panel_e(spark, sf), "user_id", T, 24, "hour")
