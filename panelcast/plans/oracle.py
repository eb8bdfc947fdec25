"""DuckDB SQL for the correctness oracle: the same pipelines written independently in SQL.

The grid here is a calendar spine + LEFT JOIN (the Spark side uses one window pass), merges
are FULL OUTER JOINs (Spark side: union + group), folds are a non-equi join (Spark side:
per-row fold ids).  CTE text is assembled from small builders so the long feature lists
stay in step with the parameters used on the Spark side.
"""

from __future__ import annotations

from collections.abc import Sequence

from panelcast.functions.scalar import BARRIER_MONTHS, GROWTH_MONTHS, LABELS, crossing_months

KA = "nation, segment"
WA = "PARTITION BY nation, segment ORDER BY period"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def phase_sql(x: str, lo: float = -0.5, hi: float = 0.5) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) > {hi} THEN {q(LABELS[2])} "
            f"WHEN ({x}) < {lo} THEN {q(LABELS[0])} ELSE {q(LABELS[1])} END")


def rint_sql(x: str, d: int) -> str:
    s = 10 ** d
    return f"(round_even(({x}) * {s}.0, 0) / {s}.0)"


def label_int_sql(x: str) -> str:
    return f"CAST(CASE ({x}) WHEN {q(LABELS[0])} THEN 0 WHEN {q(LABELS[1])} THEN 1 WHEN {q(LABELS[2])} THEN 2 END AS INTEGER)"


PANEL_A = """panel_a AS (
  SELECT c.c_nationkey AS nation, c.c_mktsegment AS segment,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3)"""

PANEL_B = """panel_b AS (
  SELECT l_suppkey AS supplier, CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty, COUNT(*) AS n_lines
  FROM lineitem GROUP BY 1, 2)"""

ORDERS_BY_NATION = """obn AS (
  SELECT c.c_nationkey AS nation, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_revenue, COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)"""

LINES_BY_NATION = """lbn AS (
  SELECT s.s_nationkey AS nation, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS period,
         CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS ship_qty, COUNT(*) AS n_lines
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2)"""

PANEL_C = """panel_c AS (
  SELECT nation, period, o.order_revenue, o.n_orders, l.ship_qty, l.n_lines
  FROM obn o FULL OUTER JOIN lbn l USING (nation, period))"""

GRID_A = """bounds_a AS (SELECT nation, segment, min(period) AS lo, max(period) AS hi FROM panel_a GROUP BY 1, 2),
spine_a AS (SELECT nation, segment, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM bounds_a),
grid_a AS (
  SELECT s.nation, s.segment, s.period, p.revenue, p.n_orders, p.period IS NULL AS is_inserted
  FROM spine_a s LEFT JOIN panel_a p ON s.nation = p.nation AND s.segment = p.segment AND s.period = p.period)"""

FILLED_A = f"""filled_a AS (
  SELECT nation, segment, period, is_inserted,
         last_value(revenue IGNORE NULLS) OVER w AS revenue,
         last_value(n_orders IGNORE NULLS) OVER w AS n_orders
  FROM grid_a WINDOW w AS ({WA} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""

PREPARED_A = """prepared_a AS (
  SELECT nation, segment, period, revenue, n_orders, is_inserted, CAST(n_orders AS DOUBLE) AS orders,
         CASE WHEN stddev_samp(revenue) OVER ws > 0
              THEN (revenue - avg(revenue) OVER ws) / stddev_samp(revenue) OVER ws END AS anom
  FROM filled_a WINDOW ws AS (PARTITION BY nation, segment))"""

PREP_COLS = ["nation", "segment", "period", "revenue", "n_orders", "is_inserted", "orders", "anom"]
HORIZONS = (1, 3, 6)


def labelled_a_sql(horizons: Sequence[int] = HORIZONS) -> str:
    parts = [f"{phase_sql('sm')} AS enso_phase"]
    for h in horizons:
        parts.append(f"{phase_sql(f'lead(sm, {h}) OVER w')} AS enso_t{h}")
        parts.append(f"{rint_sql(f'lead(sm, {h}) OVER w', 2)} AS nino34_t{h}")
    return f"""smooth_a AS (
  SELECT *, CASE WHEN count(anom) OVER w3 >= 2 THEN avg(anom) OVER w3 END AS sm
  FROM prepared_a WINDOW w3 AS ({WA} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
labelled_a AS (
  SELECT {', '.join(PREP_COLS)}, {', '.join(parts)}
  FROM smooth_a WINDOW w AS ({WA}))"""


def feature_sql(base: Sequence[str], lags=(1, 3, 6), mean=(3,), std=(3,), diff=(1,),
                horizons=HORIZONS, calendar=True, time="period") -> list[str]:
    out = []
    for b in base:
        out += [f"lag({b}, {L}) OVER w AS {b}_lag{L}" for L in lags]
        for W in mean:
            out.append(f"CASE WHEN count({b}) OVER w{W} >= 2 THEN avg({b}) OVER w{W} END AS {b}_rm{W}")
        for W in std:
            out.append(f"CASE WHEN count({b}) OVER w{W} >= 2 THEN stddev_samp({b}) OVER w{W} END AS {b}_rstd{W}")
        out += [f"{b} - lag({b}, {P}) OVER w AS {b}_diff{P}" for P in diff]
    if calendar:
        m = f"month({time})"
        out += [f"sin(2 * pi() * CAST({m} AS DOUBLE) / 12.0) AS month_sin",
                f"cos(2 * pi() * CAST({m} AS DOUBLE) / 12.0) AS month_cos",
                f"CAST({m} AS INTEGER) AS month", f"CAST(year({time}) AS INTEGER) AS year"]
        for h in horizons:
            out.append(f"{m} IN ({', '.join(map(str, crossing_months(h, BARRIER_MONTHS)))}) AS crosses_spring_t{h}")
        out.append(f"{m} IN ({', '.join(map(str, GROWTH_MONTHS))}) AS init_in_growth_phase")
    return out


def windows_sql(partition: str = "nation, segment", time: str = "period", sizes=(3,)) -> str:
    ws = [f"w AS (PARTITION BY {partition} ORDER BY {time})"]
    ws += [f"w{W} AS (PARTITION BY {partition} ORDER BY {time} ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW)"
           for W in sizes]
    return "WINDOW " + ", ".join(ws)


BASE_A = ("anom", "orders")


def features_a_sql() -> str:
    return f"""features_a AS (
  SELECT *, {', '.join(feature_sql(BASE_A))}
  FROM labelled_a {windows_sql()})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def chain_a(upto: str) -> list[str]:
    """CTEs of the panel-A pipeline up to a stage name."""
    stages = [("panel_a", PANEL_A), ("grid_a", GRID_A), ("filled_a", FILLED_A), ("prepared_a", PREPARED_A),
              ("labelled_a", labelled_a_sql()), ("features_a", features_a_sql())]
    out = []
    for name, text in stages:
        out.append(text)
        if name == upto:
            return out
    raise KeyError(upto)


TARGETS_A = tuple(f"enso_t{h}" for h in HORIZONS)
VALUE_TARGETS_A = tuple(f"nino34_t{h}" for h in HORIZONS)
SPLIT_SQL = ("CASE WHEN period <= DATE '1998-12-01' THEN 'train' WHEN period >= DATE '2000-01-01' THEN 'test' "
             "WHEN period BETWEEN DATE '1999-01-01' AND DATE '1999-12-01' THEN 'val' END")


def predictions_a_sql() -> list[str]:
    """CTEs ending in ``preds`` = persistence + climatology rows on the test split (panel A)."""
    unions = " UNION ALL ".join(
        f"SELECT nation, segment, period, split, enso_phase, month, {q(t)} AS target, {t} AS y_true FROM split_a"
        for t in TARGETS_A)
    crosses = " ".join(
        f"WHEN {q(f'enso_t{h}')} THEN month IN ({', '.join(map(str, crossing_months(h)))})" for h in HORIZONS)
    order = f"CASE y_true WHEN {q(LABELS[0])} THEN 1 WHEN {q(LABELS[1])} THEN 2 WHEN {q(LABELS[2])} THEN 3 ELSE 1000000 END"
    return chain_a("labelled_a") + [
        f"split_a AS (SELECT *, {SPLIT_SQL} AS split, CAST(month(period) AS INTEGER) AS month FROM labelled_a)",
        f"long_a AS (SELECT *, CASE target {crosses} END AS crosses FROM ({unions}) u)",
        "test_a AS (SELECT * FROM long_a WHERE split = 'test')",
        f"""modal AS (
  SELECT target, y_true AS modal_class, n AS modal_n FROM (
    SELECT target, y_true, n, row_number() OVER (PARTITION BY target ORDER BY n DESC, {order}, y_true) AS r
    FROM (SELECT target, y_true, count(*) AS n FROM long_a WHERE split = 'train' AND y_true IS NOT NULL GROUP BY 1, 2) c
  ) WHERE r = 1)""",
        """preds AS (
  SELECT *, 'persistence' AS model, enso_phase AS y_pred FROM test_a
  UNION ALL
  SELECT t.*, 'climatology' AS model, m.modal_class AS y_pred FROM test_a t LEFT JOIN modal m USING (target))""",
    ]


def counts_sql(src: str, by: Sequence[str]) -> str:
    cells = []
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            cells.append(f"count_if(y_true = {q(a)} AND y_pred = {q(b)}) AS c_{i}_{j}")
    return (f"SELECT {', '.join(by)}, count(*) AS n, count_if(y_true = y_pred) AS n_correct, {', '.join(cells)} "
            f"FROM {src} WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY {', '.join(by)}")


def f1_sql(i: int) -> str:
    row = " + ".join(f"c_{i}_{j}" for j in range(3))
    col = " + ".join(f"c_{j}_{i}" for j in range(3))
    return f"(CASE WHEN ({row}) + ({col}) > 0 THEN 2.0 * c_{i}_{i} / (({row}) + ({col})) ELSE 0.0 END)"


def metrics_select(by: Sequence[str]) -> str:
    f1s = [f1_sql(i) for i in range(3)]
    names = ("f1_la_nina", "f1_neutral", "f1_el_nino")
    cols = list(by) + [f"{rint_sql('CAST(n_correct AS DOUBLE) / n', 4)} AS accuracy",
                       f"{rint_sql('(' + ' + '.join(f1s) + ') / 3.0', 4)} AS f1_macro"]
    cols += [f"{rint_sql(f, 4)} AS {nm}" for f, nm in zip(f1s, names)]
    cols.append("n")
    return ", ".join(cols)


def metrics_sql(src: str, by: Sequence[str]) -> str:
    return f"SELECT {metrics_select(by)} FROM ({counts_sql(src, by)}) cc"


# column lists of the panel-A stages (used to generate select lists in the oracle)
LABEL_COLS = ["enso_phase"] + [c for h in HORIZONS for c in (f"enso_t{h}", f"nino34_t{h}")]


def feature_names(base: Sequence[str] = BASE_A, lags=(1, 3, 6), mean=(3,), std=(3,), diff=(1,),
                  horizons=HORIZONS) -> list[str]:
    out = []
    for b in base:
        out += [f"{b}_lag{L}" for L in lags] + [f"{b}_rm{W}" for W in mean] + [f"{b}_rstd{W}" for W in std]
        out += [f"{b}_diff{P}" for P in diff]
    out += ["month_sin", "month_cos", "month", "year"] + [f"crosses_spring_t{h}" for h in horizons]
    return out + ["init_in_growth_phase"]


FEATURES_A_COLS = PREP_COLS + LABEL_COLS + feature_names()
DOUBLE_FEATURES_A = [c for c in feature_names() if not c.startswith(("month", "year", "crosses", "init"))] + \
    ["month_sin", "month_cos"]
DOUBLES_A = ["revenue", "orders", "anom"] + [f"nino34_t{h}" for h in HORIZONS] + DOUBLE_FEATURES_A


def regression_predictions_a_sql() -> list[str]:
    """CTEs ending in ``regpreds`` (see pipelines.regression_predictions_a)."""
    w = "(PARTITION BY nation, segment, target ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    unions = " UNION ALL ".join(
        f"SELECT nation, segment, period, init_in_growth_phase, anom, anom_rm3, {q(t)} AS target, {t} AS y_true FROM features_a "
        f"WHERE period >= DATE '2000-01-01' AND {t} IS NOT NULL" for t in VALUE_TARGETS_A)
    models = " UNION ALL ".join(
        f"SELECT nation, segment, period, init_in_growth_phase, target, {q(m)} AS model, y_true, {m} AS y_pred FROM rtest"
        for m in ("persistence", "persistence_smoothed"))
    return chain_a("features_a") + [
        f"""rtest AS (SELECT *, coalesce(last_value(anom IGNORE NULLS) OVER {w}, 0.0) AS persistence,
  coalesce(last_value(anom_rm3 IGNORE NULLS) OVER {w}, 0.0) AS persistence_smoothed FROM ({unions}) u)""",
        f"regpreds AS ({models})"]


PANEL_E = """panel_e AS (
  SELECT user_id, date_trunc('hour', ts) AS period, count(*) AS n_events,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
  FROM events GROUP BY 1, 2)"""


def generic_chain(src: str, keys: Sequence[str], value: str, count: str, unit: str = "month",
                  horizons: Sequence[int] = HORIZONS, max_gap: int = 3) -> list[str]:
    """grid -> fill -> standardise -> label CTEs over any panel CTE ``src`` (names prefixed g_)."""
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = p.{c}" for c in keys)
    cast = "CAST({} AS DATE)" if unit in ("month", "day") else "{}"
    wa = f"PARTITION BY {k} ORDER BY period"
    parts = [f"{phase_sql('sm')} AS enso_phase"]
    for h in horizons:
        parts.append(f"{phase_sql(f'lead(sm, {h}) OVER w')} AS enso_t{h}")
        parts.append(f"{rint_sql(f'lead(sm, {h}) OVER w', 2)} AS nino34_t{h}")
    return [
        f"g_bounds AS (SELECT {k}, min(period) AS lo, max(period) AS hi FROM {src} GROUP BY {k})",
        f"g_spine AS (SELECT {k}, {cast.format(f'unnest(generate_series(lo, hi, INTERVAL 1 {unit.upper()}))')} AS period FROM g_bounds)",
        f"""g_grid AS (SELECT {', '.join('s.' + c for c in keys)}, s.period, p.{value}, p.{count}, p.period IS NULL AS is_inserted
  FROM g_spine s LEFT JOIN {src} p ON {on} AND s.period = p.period)""",
        f"""g_filled AS (SELECT {k}, period, is_inserted, last_value({value} IGNORE NULLS) OVER w AS {value},
  last_value({count} IGNORE NULLS) OVER w AS {count} FROM g_grid WINDOW w AS ({wa} ROWS BETWEEN {max_gap} PRECEDING AND CURRENT ROW))""",
        f"""g_prepared AS (SELECT *, CASE WHEN stddev_samp({value}) OVER ws > 0
  THEN ({value} - avg({value}) OVER ws) / stddev_samp({value}) OVER ws END AS anom FROM g_filled WINDOW ws AS (PARTITION BY {k}))""",
        f"""g_smooth AS (SELECT *, CASE WHEN count(anom) OVER w3 >= 2 THEN avg(anom) OVER w3 END AS sm
  FROM g_prepared WINDOW w3 AS ({wa} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
        f"g_labelled AS (SELECT * EXCLUDE (sm), {', '.join(parts)} FROM g_smooth WINDOW w AS ({wa}))",
    ]
