"""Time splits (L1-L4) and walk-forward folds (J8).  A split is a column, not three frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.panel import Series, _as_date, whole


def time_split(df: DataFrame, time: str, train_end, test_start, val_start=None, val_end=None,
               series: Series | None = None, col: str = "split") -> DataFrame:
    """L1 / L2: train <= train_end, test >= test_start, val in [val_start, val_end] inclusive.

    Without explicit val bounds the implicit validation is every row strictly between the
    last present train period and the first present test period (per series when given).
    Rows in no set get NULL.
    """
    t = F.col(time)
    train, test = t <= _as_date(train_end), t >= _as_date(test_start)
    if val_start is not None and val_end is not None:
        val = t.between(_as_date(val_start), _as_date(val_end))
        return df.select("*", _label(train, val, test).alias(col))
    scope = whole(series) if series is not None else None
    last_train = F.max(F.when(train, t))
    first_test = F.min(F.when(test, t))
    if scope is not None:
        last_train, first_test = last_train.over(scope), first_test.over(scope)
        val = (t > last_train) & (t < first_test)
        return df.select("*", _label(train, val, test).alias(col))
    b = df.agg(last_train.alias("lt"), first_test.alias("ft")).first()  # one-row bounds
    if b["lt"] is None or b["ft"] is None:
        val = F.lit(False)
    else:
        val = (t > F.lit(b["lt"])) & (t < F.lit(b["ft"]))
    return df.select("*", _label(train, val, test).alias(col))


def _label(train: Column, val: Column, test: Column) -> Column:
    return F.when(train, F.lit("train")).when(test, F.lit("test")).when(val, F.lit("val"))


def export_split(df: DataFrame, time: str, test_start, col: str = "split") -> DataFrame:
    """L3: train < test_start <= test (validation rows go to train)."""
    return df.select("*", F.when(F.col(time) < _as_date(test_start), F.lit("train")).otherwise(F.lit("test")).alias(col))


def walk_forward(df: DataFrame, time: str, initial_years: int = 15, step_months: int = 12,
                 horizon_months: int = 12, start=None, end=None) -> DataFrame:
    """Expanding-window folds as rows ``(…, fold_id, role)``.

    Fold k: train = periods before ``start + initial_years*12 + k*step``; val = the next
    ``horizon_months``.  The last fold is the last one whose val lies within the data.  No
    join: each row computes the fold ids it belongs to from its month offset and emits one
    copy per fold (``explode(sequence)``); the bounds are one scalar aggregate.
    """
    init = initial_years * 12
    if start is None or end is None:
        b = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).first()
        start = b["lo"] if start is None else start
        end = b["hi"] if end is None else end
    lo, hi = _as_date(start), _as_date(end)
    span = F.months_between(hi, lo).cast("int") + 1            # months covered
    n_folds = F.floor((span - init - horizon_months) / step_months).cast("int") + 1
    m = F.months_between(F.trunc(time, "month"), lo).cast("int")  # month offset of the row
    # row is in fold k iff m < init + k*step + horizon  ->  k >= ceil((m - init - horizon + 1) / step)
    k_min = F.greatest(F.lit(0), F.ceil((m - init - horizon_months + 1) / F.lit(float(step_months))).cast("int"))
    k_max = n_folds - 1
    rows = df.filter((m >= 0) & (k_min <= k_max)).select("*", F.explode(F.sequence(k_min, k_max)).alias("fold_id"))
    cut = F.lit(init) + F.col("fold_id") * step_months
    m2 = F.months_between(F.trunc(time, "month"), lo).cast("int")
    return rows.select("*", F.when(m2 < cut, F.lit("train")).otherwise(F.lit("val")).alias("role"))


def fold_bounds(folds: DataFrame, time: str) -> DataFrame:
    """Extent of each fold and role (A9 over folds)."""
    return folds.groupBy("fold_id", "role").agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("start"),
                                                F.max(time).alias("end"))


def walk_forward_extents(df: DataFrame, time: str, initial_years: int = 15, step_months: int = 12,
                         horizon_months: int = 12, start=None, end=None) -> DataFrame:
    """L4: rows and first and last period of each fold and role, equal to ``fold_bounds(walk_forward(df))``, without a copy of
    any row: ``df`` is counted by month once, and folds are prefix sums over that histogram.

    A month enters the train part of one fold and stays in all later ones; it is in the val part of a range of folds, which a
    difference array marks (+n at the first, -n behind the last).  Everything after the first aggregate has one row per
    month or fold, so the windows over all of it are small."""
    init = initial_years * 12
    # F.trunc gives the first day of the month; rows without time belong to no fold
    months = df.filter(F.col(time).isNotNull()).groupBy(F.trunc(time, "month").alias("__p")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.min(time).alias("lo"), F.max(time).alias("hi"))
    all_months = Window.partitionBy()
    first = F.min("lo").over(all_months) if start is None else _as_date(start)
    last = F.max("hi").over(all_months) if end is None else _as_date(end)
    months = months.select("*", first.alias("__first"), last.alias("__last"),
                           (F.row_number().over(all_months.orderBy("__p")) == 1).alias("__mark"))
    m = F.months_between("__p", "__first").cast("int")
    span = F.months_between("__last", "__first").cast("int") + 1
    months = months.select("*", m.alias("__m"), (F.floor((span - init - horizon_months) / F.lit(float(step_months))).cast("int") + 1).alias("__folds"))
    step = F.lit(float(step_months))
    enters = F.floor((F.col("__m") - init) / step).cast("int") + 1                        # first fold whose train part has the month
    k_min = F.greatest(F.lit(0), F.ceil((F.col("__m") - init - horizon_months + 1) / step).cast("int"))
    k_max = enters - 1                                                                    # last fold whose val part has it
    none, zero = F.lit(None), F.lit(0).cast("bigint")
    kind = months.schema["lo"].dataType

    def event(k, n_train=zero, t_lo=none, t_hi=none, n_val=zero, v_lo=none, v_hi=none):
        return F.struct(k.cast("int").alias("fold_id"), n_train.alias("n_train"), t_lo.cast(kind).alias("t_lo"), t_hi.cast(kind).alias("t_hi"),
                        n_val.alias("n_val"), v_lo.cast(kind).alias("v_lo"), v_hi.cast(kind).alias("v_hi"))

    trained = F.array(event(F.greatest(F.lit(0), enters), F.col("n"), F.col("lo"), F.col("hi")))
    empty = F.slice(trained, 1, 0)
    scored = F.when(k_min <= k_max, F.array(event(k_min, n_val=F.col("n"), v_hi=F.col("hi")), event(k_max, v_lo=F.col("lo")),
                                            event(k_max + 1, n_val=-F.col("n")))).otherwise(empty)
    # every fold gets a row, also one that no month begins or ends
    marks = F.when(F.col("__mark") & (F.col("__folds") > 0),
                   F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("__folds") - 1)), lambda k: event(k))).otherwise(empty)
    inside = F.when(F.col("__m") >= 0, F.concat(trained, scored)).otherwise(empty)
    folds = months.select("__folds", F.explode(F.concat(inside, marks)).alias("e")).groupBy("e.fold_id").agg(
        F.max("__folds").alias("__folds"), F.sum("e.n_train").alias("n_train"), F.min("e.t_lo").alias("t_lo"), F.max("e.t_hi").alias("t_hi"),
        F.sum("e.n_val").alias("n_val"), F.min("e.v_lo").alias("v_lo"), F.max("e.v_hi").alias("v_hi"))
    so_far = Window.partitionBy().orderBy("fold_id").rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy().orderBy("fold_id").rowsBetween(0, Window.unboundedFollowing)
    run = folds.select("fold_id", "__folds", *[f.over(w).alias(c) for c, f, w in (
        ("n_train", F.sum("n_train"), so_far), ("t_lo", F.min("t_lo"), so_far), ("t_hi", F.max("t_hi"), so_far),
        ("n_val", F.sum("n_val"), so_far), ("v_lo", F.min("v_lo"), from_here), ("v_hi", F.max("v_hi"), so_far))])
    roles = F.explode(F.array(
        F.struct(F.lit("train").alias("role"), F.col("n_train").alias("n"), F.col("t_lo").alias("start"), F.col("t_hi").alias("end")),
        F.struct(F.lit("val").alias("role"), F.col("n_val").alias("n"), F.col("v_lo").alias("start"), F.col("v_hi").alias("end"))))
    return run.filter(F.col("fold_id") < F.col("__folds")).select("fold_id", roles.alias("r")).select("fold_id", "r.*").filter("n > 0")


def train(df: DataFrame, col: str = "split") -> DataFrame:
    """Accessor filters on the split column (the three frames of a split, lazily)."""
    return df.filter(F.col(col) == "train")


def val(df: DataFrame, col: str = "split") -> DataFrame:
    return df.filter(F.col(col) == "val")


def test(df: DataFrame, col: str = "split") -> DataFrame:
    return df.filter(F.col(col) == "test")
