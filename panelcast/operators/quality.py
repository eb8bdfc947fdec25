"""Data-quality and leakage checks.

Checks look at values, not only at names: every row is checked (no spot sample) and the
checks of one kind are fused into a single aggregate per pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.scalar import periods_between
from panelcast.operators.panel import Series, at_offset, keys_of, ordered, over, q


def _unpivot_one_row(row: DataFrame, name_col: str, value_col: str) -> DataFrame:
    cols = row.columns
    return row.unpivot([], cols, name_col, value_col)


def missing_counts(df: DataFrame, cols: Iterable[str] | None = None, keep_zero: bool = False) -> DataFrame:
    """A2 / T4: missing count per column in one pass -> (column, n_missing), most missing first."""
    cols = list(cols) if cols is not None else df.columns
    one = df.agg(*[F.expr(f"count_if({q(c)} IS NULL) AS m{i}") for i, c in enumerate(cols)])
    long = one.selectExpr(_stack([[_sql_str(c), f"m{i}"] for i, c in enumerate(cols)], ["column", "n_missing"]))
    if not keep_zero:
        long = long.filter(F.col("n_missing") > 0)
    return long


def key_check(df: DataFrame, series: Series, time: str, unit: str = "month") -> DataFrame:
    """Q2: per series rows, distinct periods, duplicates and missing periods of the grid."""
    keys = keys_of(series)
    a = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(time).alias("n_periods"),
                              F.min(time).alias("first"), F.max(time).alias("last"))
    expected = periods_between(F.col("first"), F.col("last"), unit) + 1
    return a.select(*keys, "n_rows", "n_periods", (F.col("n_rows") - F.col("n_periods")).alias("n_duplicates"),
                    (expected - F.col("n_periods")).alias("n_missing_periods"), "first", "last")


def input_order_check(df: DataFrame, partition: Sequence[str], order_by: str, time: str) -> DataFrame:
    """Q1: rows whose time is earlier than the previous row's in input order (per partition)."""
    w = Window.partitionBy(*partition).orderBy(order_by)
    bad = F.col(time) < F.lag(time).over(w)
    flagged = df.select(F.coalesce(bad, F.lit(False)).alias("__bad"))
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("__bad").alias("n_out_of_order"))


def file_order_check(spark: SparkSession, path: str | Sequence[str], series: Series, time: str, block_rows: int = 100_000) -> DataFrame:
    """Q1 on Parquet files as they lie: per file (name), its rows and those whose time is earlier than that of the previous row of
    their series.  Input order is the order of the file names, then of the rows in a file; no column has to tell it.

    Rows are compared inside blocks of ``block_rows`` neighbouring rows of a file, and one summary per series and block hands its
    last time on to the next block of the series, also across files: no window holds a whole series.  A row without time, or
    behind one, is not out of order."""
    keys = keys_of(series)
    rows = spark.read.parquet(*([path] if isinstance(path, str) else path)).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(time).alias("__t"),
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    rows = rows.withColumn("__block", F.floor(F.col("__row") / F.lit(block_rows)))
    ks = [f"__k{i}" for i in range(len(keys))]
    block = [*ks, "__file", "__block"]
    late = F.col("__t") < F.lag("__t").over(Window.partitionBy(*block).orderBy("__row"))
    sums = rows.withColumn("__late", late).groupBy(*block).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if("__late").alias("__bad"),
        F.min_by("__t", "__row").alias("__first"), F.max_by("__t", "__row").alias("__last"))
    before = F.lag("__last").over(Window.partitionBy(*ks).orderBy("__file", "__block"))
    sums = sums.withColumn("__edge", F.coalesce(F.col("__first") < before, F.lit(False)).cast("bigint"))
    name = F.element_at(F.split("__file", "/"), -1)
    return sums.groupBy(name.alias("file")).agg(F.sum("__n").alias("n_rows"), F.sum(F.col("__bad") + F.col("__edge")).alias("n_out_of_order"))


_LAG = re.compile(r"_lag(-?\d+)$")


def future_lag_names(columns: Iterable[str]) -> list[str]:
    """Q3 name gate: ``*_lag{n}`` with n <= 0 names a present or future value."""
    out = []
    for c in columns:
        m = _LAG.search(c)
        if m and int(m.group(1)) <= 0:
            out.append(c)
    return out


def _stack(rows: list[list[str]], names: list[str]) -> str:
    """SQL ``stack`` turning one aggregate row into ``len(rows)`` rows."""
    flat = ", ".join(v for r in rows for v in r)
    return f"stack({len(rows)}, {flat}) AS ({', '.join(names)})"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_leak_scan(df: DataFrame, features_by_base: dict[str, Sequence[str]], series: Series, time: str,
                    max_k: int = 6) -> DataFrame:
    """Q3 by value: for each feature and k = 0..max_k, rows where it equals ``lead(base, k)``.

    A feature equal to the current or a future base value on every comparable row is a leak
    whatever its name.  One window pass and one aggregate for all pairs.
    """
    w = over(series, time)
    lead_cols = []
    for i, b in enumerate(features_by_base):
        for k in range(max_k + 1):
            e = q(b) if k == 0 else f"lead({q(b)}, {k}) {w}"
            lead_cols.append(f"{e} AS __l{i}_{k}")
    feats = sorted({f for fs in features_by_base.values() for f in fs})
    tmp = df.selectExpr(*[q(f) for f in feats], *lead_cols)
    aggs, rows = [], []
    for i, (b, fs) in enumerate(features_by_base.items()):
        for f in fs:
            for k in range(max_k + 1):
                n = len(rows)
                both = f"{q(f)} IS NOT NULL AND __l{i}_{k} IS NOT NULL"
                aggs += [f"count_if({both}) AS c{n}", f"count_if({both} AND abs({q(f)} - __l{i}_{k}) < 1e-9) AS e{n}"]
                rows.append([_sql_str(f), _sql_str(b), f"{k}", f"c{n}", f"e{n}"])
    row = tmp.agg(*[F.expr(a) for a in aggs])
    return row.selectExpr(_stack(rows, ["feature", "base", "k", "n_compared", "n_equal"]))


def target_copy_scan(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Q4 by value: for each feature x target of the same kind, compared and mismatching rows.
    ``n_compared > 0 and n_mismatch = 0`` means the feature is a copy of the target."""
    types = {f.name: f.dataType for f in df.schema}
    pairs = [(f, t) for f in features for t in targets
             if isinstance(types[f], T.NumericType) == isinstance(types[t], T.NumericType)
             and not isinstance(types[f], T.BooleanType)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature string, target string, n_compared bigint, n_mismatch bigint")
    aggs, rows = [], []
    for i, (f, t) in enumerate(pairs):
        both = f"{q(f)} IS NOT NULL AND {q(t)} IS NOT NULL"
        differ = f"abs({q(f)} - {q(t)}) > 1e-9" if isinstance(types[f], T.NumericType) else f"{q(f)} <> {q(t)}"
        aggs += [f"count_if({both}) AS c{i}", f"count_if({both} AND {differ}) AS m{i}"]
        rows.append([_sql_str(f), _sql_str(t), f"c{i}", f"m{i}"])
    row = df.agg(*[F.expr(a) for a in aggs])
    return row.selectExpr(_stack(rows, ["feature", "target", "n_compared", "n_mismatch"]))


def target_shift_check(df: DataFrame, series: Series, time: str, phase: str = "enso_phase",
                       horizons: Sequence[int] = (1, 3, 6), prefix: str = "enso") -> DataFrame:
    """Q5 / T5: ``<prefix>_tL`` must equal ``lead(phase, L)`` on every row where both exist."""
    w = ordered(series, time)
    tmp = df.select(*[(F.col(f"{prefix}_t{h}")).alias(f"t{h}") for h in horizons],
                    *[F.lead(phase, h).over(w).alias(f"l{h}") for h in horizons])
    aggs = []
    for h in horizons:
        both = F.col(f"t{h}").isNotNull() & F.col(f"l{h}").isNotNull()
        aggs += [F.count_if(both).alias(f"c{h}"), F.count_if(both & (F.col(f"t{h}") != F.col(f"l{h}"))).alias(f"m{h}")]
    row = tmp.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"c{h}").alias("n_checked"),
                                                   F.col(f"m{h}").alias("n_mismatch")) for h in horizons])).alias("s")
                      ).select("s.*")


def lag_alignment(df: DataFrame, base: str | Sequence[str], series: Series, time: str,
                  lags: Sequence[int] = (1, 3, 6), unit: str = "month", tol: float = 1e-6) -> DataFrame:
    """Q6: look ``{base}_lag{L}`` up again by the period L before (not by the row L before) and count mismatches (value differs by
    >= tol, or exactly one side missing).  All bases and lags share one read and one exchange."""
    bases = [base] if isinstance(base, str) else list(base)
    pairs = [(b, L) for b in bases for L in lags if f"{b}_lag{L}" in df.columns]
    rows = df.selectExpr(*[e for i, (b, L) in enumerate(pairs)
                           for e in (f"{q(f'{b}_lag{L}')} AS l{i}", f"{at_offset(b, series, time, -L, unit)} AS p{i}")])
    one = rows.agg(*[F.expr(e) for i in range(len(pairs)) for e in (
        f"count_if(l{i} IS NOT NULL) AS c{i}",
        f"count_if(coalesce(abs(l{i} - p{i}) >= {tol!r} OR ((l{i} IS NULL) <> (p{i} IS NULL)), false)) AS m{i}")])
    return one.selectExpr(_stack([[_sql_str(b), str(L), f"c{i}", f"m{i}"] for i, (b, L) in enumerate(pairs)],
                                 ["base", "lag", "n_compared", "n_mismatch"]))


def split_integrity(df: DataFrame, series: Series, time: str, split: str = "split") -> DataFrame:
    """Q7 (+ U1): per series last train period < first test period, and no key in both sets."""
    keys = keys_of(series)
    per_key = df.groupBy(*keys, time).agg(F.count_if(F.col(split) == "train").alias("__tr"),
                                          F.count_if(F.col(split) == "test").alias("__te"))
    a = per_key.groupBy(*keys).agg(F.max(F.when(F.col("__tr") > 0, F.col(time))).alias("last_train"),
                                   F.min(F.when(F.col("__te") > 0, F.col(time))).alias("first_test"),
                                   F.count_if((F.col("__tr") > 0) & (F.col("__te") > 0)).alias("n_overlap"))
    return a.select("*", F.coalesce(F.col("last_train") < F.col("first_test"), F.lit(True)).alias("ordered"))


def range_qc(df: DataFrame, cols: Sequence[str], limit: float = 10.0) -> DataFrame:
    """A10: max |x| per column in one pass, flagged when above ``limit``."""
    row = df.agg(*[F.max(F.abs(c)).alias(c) for c in cols])
    long = _unpivot_one_row(row.select(*[F.col(c).cast("double") for c in cols]), "column", "max_abs")
    return long.select("*", (F.col("max_abs") > limit).alias("over_limit"))


def numeric_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per string column, non-missing values that do not parse as numbers."""
    cols = cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in cols])
    return _unpivot_one_row(row, "column", "n_non_numeric")


def possible_copies(rows: DataFrame, pairs: Sequence[tuple[str, str]], key: str, tol: float = 1e-9) -> list[tuple[str, str]]:
    """The pairs of columns of ``rows`` that may be equal wherever both are known; all others differ somewhere.

    Each column gets a fingerprint over the complete rows, whatever their order: for numbers the sums of the values under two sets of weights
    drawn from the hash of ``key``, for texts the exclusive or of hashes of key and value.  Columns within ``tol`` of each
    other have sums within the weights' bound, so no copy is lost.  One pass whose cost is the number of columns, not of pairs; without
    complete rows all pairs are possible."""
    cols = sorted({c for pair in pairs for c in pair})
    if not cols:
        return []
    types = {f.name: f.dataType for f in rows.schema}
    number = {c: isinstance(types[c], T.NumericType) for c in cols}
    weight = [f"(pmod(xxhash64({key}, {k}), 2001) - 1000) / 1000D" for k in (1, 2)]
    full = rows.filter(" AND ".join(f"{q(c)} IS NOT NULL" for c in cols)).selectExpr(
        *[q(c) for c in cols], f"{key} AS __k", *[f"{w} AS __w{k}" for k, w in enumerate(weight)])
    prints = ["count(1) AS n"]
    for i, c in enumerate(cols):
        prints += ([f"sum({q(c)} * __w{k}) AS p{i}_{k}" for k in range(2)] + [f"sum(abs({q(c)})) AS s{i}"] if number[c]
                   else [f"bit_xor(xxhash64(__k, {q(c)})) AS p{i}_0"])
    one = full.agg(*[F.expr(e) for e in prints]).first()  # one row
    if not one["n"]:
        return list(pairs)
    at = {c: i for i, c in enumerate(cols)}

    def close(f: str, x: str) -> bool:
        i, j = at[f], at[x]
        if not number[f]:
            return one[f"p{i}_0"] == one[f"p{j}_0"]
        bound = tol * (one["n"] + max(one[f"s{i}"], one[f"s{j}"]))
        return all(not abs(one[f"p{i}_{k}"] - one[f"p{j}_{k}"]) > bound for k in range(2))

    return [(f, x) for f, x in pairs if close(f, x)]


def leakage_report(df: DataFrame, series: Series, time: str, features: Sequence[str], targets: Sequence[str],
                   phase: str = "enso_phase", horizons: Sequence[int] = (1, 3, 6), prefix: str = "enso",
                   lag_bases: Sequence[str] = (), unit: str = "month") -> DataFrame:
    """Q8: (check, n_bad, passed, detail) for every check; the caller raises when one fails.

    Key uniqueness, grid gaps, target shift and target copies come from ONE window pass over
    the series and ONE global aggregate (partial per task).  Before it, a pass over fingerprints of the columns rules out
    all pairs that differ (``possible_copies``), so that the aggregate compares the rest only; the lag alignment, which must
    be looked up independently of the row windows, is a pass of its own.

    Leaks are found by value as well as by name: a numeric feature that equals ``lead(base, k)`` for a base of
    ``lag_bases`` and a k of ``horizons`` on all rows where both are known counts under
    ``no_future_lags``, a text feature that equals a text target under ``no_target_copies`` (unless
    the compared values are all one and the same).
    """
    w = over(series, time)
    t = q(time)
    prev = f"lag({t}) {w}"
    diff = {"month": f"CAST(months_between({t}, {prev}) AS INT)", "day": f"datediff({t}, {prev})",
            "hour": f"CAST(timestampdiff(HOUR, {prev}, {t}) AS INT)"}[unit]
    types = {f.name: f.dataType for f in df.schema}
    numeric = [f for f in features if isinstance(types[f], T.NumericType)]
    value_targets = [x for x in targets if isinstance(types[x], T.NumericType)]
    pairs = [(f, x) for f in numeric for x in value_targets]
    text = [(f, x) for f in features for x in targets if f != x and isinstance(types.get(f), T.StringType)
            and isinstance(types.get(x), T.StringType)]
    ahead = [(f, b, h) for f in numeric for b in lag_bases for h in horizons if f != b and b in types]
    cols = sorted(set(numeric) | set(value_targets) | {c for pair in text for c in pair})
    rows = df.selectExpr(
        f"coalesce({t} = {prev}, false) AS __dup", f"greatest(coalesce({diff}, 1) - 1, 0) AS __gap",
        *[f"{q(f'{prefix}_t{h}')} AS __t{h}" for h in horizons],
        *[f"lead({q(phase)}, {h}) {w} AS __l{h}" for h in horizons],
        *[f"lead({q(b)}, {h}) {w} AS {q(f'__ahead_{b}_{h}')}" for b, h in sorted({(b, h) for _, b, h in ahead})],
        *[q(c) for c in cols], f"xxhash64({', '.join(map(q, [*keys_of(series), time]))}) AS __key")
    numbers = possible_copies(rows, pairs + [(f, f"__ahead_{b}_{h}") for f, b, h in ahead], "__key")
    pairs = [p for p in pairs if p in set(numbers)]
    ahead = [(f, b, h) for f, b, h in ahead if (f, f"__ahead_{b}_{h}") in set(numbers)]
    text = possible_copies(rows, text, "__key")
    aggs = ["CAST(count_if(__dup) AS BIGINT) AS dup", "CAST(coalesce(sum(__gap), 0) AS BIGINT) AS gap",
            "CAST(" + " + ".join(f"count_if(__t{h} IS NOT NULL AND __l{h} IS NOT NULL AND __t{h} <> __l{h})"
                                 for h in horizons) + " AS BIGINT) AS shift" if horizons else "CAST(0 AS BIGINT) AS shift"]
    for i, (f, x) in enumerate(pairs):
        both = f"{q(f)} IS NOT NULL AND {q(x)} IS NOT NULL"
        aggs += [f"count_if({both}) AS c{i}", f"count_if({both} AND abs({q(f)} - {q(x)}) > 1e-9) AS m{i}"]
    hidden = [(f, x, f"{q(f)} <> {q(x)}", "x") for f, x in text] + [
        (f, f"__ahead_{b}_{h}", f"abs({q(f)} - {q(f'__ahead_{b}_{h}')}) > 1e-9", "a") for f, b, h in ahead]
    for i, (f, x, differ, _) in enumerate(hidden):
        both = f"{q(f)} IS NOT NULL AND {q(x)} IS NOT NULL"
        aggs.append(f"count_if({both}) > 0 AND count_if({both} AND {differ}) = 0 AND "
                    f"min(CASE WHEN {both} THEN {q(x)} END) <> max(CASE WHEN {both} THEN {q(x)} END) AS h{i}")
    found = {kind: "array(" + ", ".join([f"CASE WHEN h{i} THEN {_sql_str(f)} END" for i, (f, _, _, k) in enumerate(hidden) if k == kind]
                                        + ["CAST(NULL AS STRING)"]) + ")" for kind in "xa"}
    one = rows.agg(*[F.expr(a) for a in aggs])
    copy_items = ", ".join(f"CASE WHEN c{i} > 0 AND m{i} = 0 THEN {_sql_str(f)} END" for i, (f, _) in enumerate(pairs))
    copies = (f"array_sort(filter(array({copy_items}), x -> x IS NOT NULL))" if pairs
              else "CAST(array() AS ARRAY<STRING>)")
    copies = f"array_sort(array_distinct(concat({copies}, filter({found['x']}, x -> x IS NOT NULL))))"
    bad_names = future_lag_names(features)
    leaks = ("array_sort(array_distinct(filter(concat(array(" + ", ".join([_sql_str(n) for n in bad_names] + ["CAST(NULL AS STRING)"])
             + f"), {found['a']}), x -> x IS NOT NULL)))")
    overlap = sorted(set(features) & set(targets))
    checks = [
        [_sql_str("key_unique"), "dup", _sql_str("duplicate (series, period) rows")],
        [_sql_str("grid_gapless"), "gap", _sql_str("missing periods inside series spans")],
        [_sql_str("no_future_lags"), f"CAST(size({leaks}) AS BIGINT)", f"array_join({leaks}, ', ')"],
        [_sql_str("no_targets_in_features"), f"CAST({len(overlap)} AS BIGINT)", _sql_str(", ".join(overlap))],
        [_sql_str("target_shift_correct"), "shift", _sql_str("rows where class target != lead(phase, L)")],
        [_sql_str("no_target_copies"), f"CAST(size({copies}) AS BIGINT)", f"array_join({copies}, ', ')"],
    ]
    out = one.selectExpr(_stack(checks, ["check", "n_bad", "detail"]))
    lags = sorted({int(m.group(1)) for b in lag_bases for f in features
                   if (m := re.fullmatch(re.escape(b) + r"_lag(\d+)", f))})
    if lags:
        la = lag_alignment(df, list(lag_bases), series, time, lags, unit).groupBy("base").agg(
            F.sum("n_mismatch").cast("bigint").alias("n"))
        out = out.unionByName(la.select(F.concat(F.lit("lag_alignment_"), F.col("base")).alias("check"),
                                        F.col("n").alias("n_bad"),
                                        F.concat(F.col("base"), F.lit("_lagL != value at t-L")).alias("detail")))
    return out.select("check", "n_bad", (F.col("n_bad") == 0).alias("passed"), "detail")


def assert_passed(report: DataFrame) -> None:
    """Raise when any check failed (the gate before training/export)."""
    failed = report.filter(~F.col("passed")).select("check", "n_bad", "detail").collect()  # bounded: one row per check
    if failed:
        raise AssertionError("leakage checks failed: " + "; ".join(f"{r.check} ({r.n_bad}): {r.detail}" for r in failed))
