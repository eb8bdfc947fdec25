"""Splits of two series of unlike spans: every row's label, validation in between, folds counted by hand."""
import datetime as dt

import pytest

from panelcast.operators import quality, splits


def month(k):
    """The month k months after May 1994."""
    n = 1994 * 12 + 4 + k
    return dt.date(n // 12, n % 12 + 1, 1)


ROWS = [("long", k) for k in range(131)] + [("late", k) for k in range(40, 97)]
TRAIN_END, VAL_START, VAL_END, TEST_START = 62, 63, 88, 91  # months 89 and 90 belong to no part


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame([(s, month(k), k) for s, k in ROWS], "series string, period date, k int")


def text(k):
    return f"{month(k):%Y-%m}"


def labels(df):
    return {(r.series, r.k): r.split for r in df.collect()}


def test_every_row_has_the_label_of_its_month(panel):
    got = labels(splits.time_split(panel, "period", text(TRAIN_END), text(TEST_START), text(VAL_START), text(VAL_END)))
    assert got == {(s, k): "train" if k <= TRAIN_END else "test" if k >= TEST_START else "val" if k <= VAL_END else None for s, k in ROWS}


def test_validation_is_what_lies_between(panel):
    got = labels(splits.time_split(panel, "period", text(TRAIN_END), text(TEST_START)))
    assert got == {(s, k): "train" if k <= TRAIN_END else "test" if k >= TEST_START else "val" for s, k in ROWS}
    assert "val" not in labels(splits.time_split(panel, "period", text(70), text(71))).values()


def test_integrity_sees_an_overlap(panel):
    df = splits.time_split(panel, "period", text(TRAIN_END), text(TEST_START))
    assert all(r.ordered and r.n_overlap == 0 for r in quality.split_integrity(df, "series", "period").collect())
    twice = df.unionByName(df.where("series = 'late' AND k = 50").selectExpr("series", "period", "k", "'test' AS split"))
    found = {r.series: (r.ordered, r.n_overlap) for r in quality.split_integrity(twice, "series", "period").collect()}
    assert found == {"long": (True, 0), "late": (False, 1)}


def test_folds_grow_and_validate_on_the_next_months(panel):
    folds = splits.walk_forward(panel.where("series = 'long'"), "period", initial_years=4, step_months=9, horizon_months=5)
    got = {(r.fold_id, r.role): (r.n, r.start, r.end) for r in splits.fold_bounds(folds, "period").collect()}
    want = {}
    for i, cut in enumerate(range(48, 131 - 5 + 1, 9)):
        want[i, "train"] = (cut, month(0), month(cut - 1))
        want[i, "val"] = (5, month(cut), month(cut + 4))
    assert got == want and len(want) == 18


def test_export_has_two_parts(panel):
    assert labels(splits.export_split(panel, "period", text(77))) == {(s, k): "train" if k < 77 else "test" for s, k in ROWS}


def test_fold_extents_without_copies(spark):
    """Prefix sums over the months equal counting the copied rows: gaps between months, steps over and under the horizon."""
    import datetime as dt
    import random
    rng = random.Random(8)
    rows = [("s", dt.date(1971 + m // 12, m % 12 + 1, 1)) for m in range(0, 150) if rng.random() < 0.6 for _ in range(rng.randint(1, 3))]
    df = spark.createDataFrame(rows + [("s", None)], "series string, period date")
    for years, step, horizon in ((3, 12, 12), (2, 7, 3), (1, 5, 14), (4, 1, 1), (30, 12, 12)):
        slow = splits.fold_bounds(splits.walk_forward(df, "period", years, step, horizon), "period")
        fast = splits.walk_forward_extents(df, "period", years, step, horizon)
        key = lambda r: (r.fold_id, r.role, r.n, r.start, r.end)
        assert sorted(map(key, fast.collect())) == sorted(map(key, slow.collect())), (years, step, horizon)
    assert splits.walk_forward_extents(df.limit(0), "period").count() == 0
