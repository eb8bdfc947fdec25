"""Lookups by period, threshold runs, event joins, column fingerprints and hours without zone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.functions.scalar import period_of
from panelcast.operators import analysis, panel, quality

MONTHS = [dt.date(1990 + i // 12, i % 12 + 1, 1) for i in range(60)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(s, m, rng.choice([None, *(round(rng.uniform(-1, 1), 2) for _ in range(6))])) for s in "abc" for m in MONTHS if rng.random() > 0.1]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "series string, time date, x double").repartition(3)


def shifted(m, k):
    n = m.year * 12 + m.month - 1 + k
    return dt.date(n // 12, n % 12 + 1, 1)


def test_analogues_of_every_init_month(df, rows):
    at = {(s, m): v for s, m, v in rows}
    last = {s: max(m.year for q, m, _ in rows if q == s) for s in "abc"}
    for prior in (1, 2, 11, 14):
        want = {(s, m.year, m.month, v, at.get((s, shifted(m, -prior)))) for s, m, v in rows
                if v is not None and 0 <= v <= 0.5 and m.year < last[s] and (at.get((s, shifted(m, -prior))) or 0) < 0}
        got = analysis.analogues(df, ["series"], "time", "x", month=None, prior_months=prior)
        assert {tuple(r) for r in got.select("series", "year", "month", "init_value", "prior_value").collect()} == want
        one = analysis.analogues(df, ["series"], "time", "x", month=1, prior_months=prior, outcome={"later": ("x", 1)})
        assert {tuple(r) for r in one.select("series", "year", "init_value", "later").collect()} == {
            (s, y, v, at.get((s, dt.date(y + 1, 1, 1)))) for s, y, m, v, _ in want if m == 1}


def test_runs_and_events(spark, df, rows):
    at = {(s, m): v for s, m, v in rows}
    want = []
    for s in "abc":
        for sign, name in ((1, "above"), (-1, "below")):
            inside = lambda m: (at.get((s, m)) or 0) * sign > 0.3  # noqa: B023, E731
            for m in MONTHS:
                if inside(m) and not inside(shifted(m, -1)):
                    run = [m]
                    while inside(shifted(run[-1], 1)):
                        run.append(shifted(run[-1], 1))
                    want.append((s, name, run[0], run[-1], len(run), sign * max(at[(s, x)] * sign for x in run)))
    runs = analysis.exceedance_runs(df, ["series"], "time", "x", -0.3, 0.3)
    assert sorted(tuple(r) for r in runs.select("series", "side", "start", "end", "n_periods", "peak").collect()) == sorted(want)
    dated = [("e1", dt.date(1990, 11, 1), dt.date(1991, 2, 1)), ("e2", dt.date(1985, 1, 1), dt.date(1999, 12, 1)), ("e3", dt.date(1992, 5, 1), dt.date(1992, 5, 1))]
    events = spark.createDataFrame(dated, "event string, start date, end date")
    pairs = sorted((*w[:4], e, (min(w[3], b).year - max(w[2], a).year) * 12 + min(w[3], b).month - max(w[2], a).month + 1)
                   for w in want for e, a, b in dated if w[2] <= b and a <= w[3])
    for salts in (1, 5):
        got = analysis.join_events(runs, events, salts).select("series", "side", "start", "end", "event", "n_shared_months")
        assert sorted(map(tuple, got.collect())) == pairs
    assert analysis.join_events(runs, events.limit(0)).count() == 0 and analysis.join_events(runs.limit(0), events).count() == 0


def test_shift_by_period(df, rows):
    at = {(s, m): v for s, m, v in rows}
    for k in (1, -2):
        got = panel.shift_join(df, ["x"], ["series"], "time", k, suffix="_s").collect()
        assert len(got) == len(rows) and all(r["x_s"] == at.get((r["series"], shifted(r["time"], -k))) for r in got)


def test_fingerprints_rule_out_but_never_lose_a_copy(spark):
    rng = random.Random(6)
    rows = [(i, *(v := [rng.gauss(0, 10) for _ in range(3)]), v[0] + 1e-10, v[1] if i % 7 else None, v[2] + (1e-3 if i == 17 else 0), f"t{i % 5}", f"t{i % 5}",
             f"t{(i + (i == 3)) % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, a2 double, b2 double, c2 double, s string, s2 string, s3 string")
    pairs = [(x, y) for x in ("a", "b", "c") for y in ("a2", "b2", "c2")] + [("s", "s2"), ("s", "s3")]
    assert quality.possible_copies(df, pairs, "k") == [("a", "a2"), ("b", "b2"), ("s", "s2")]
    assert quality.possible_copies(df.where("k = 0"), pairs, "k") == pairs  # no complete row
    assert quality.possible_copies(df, [], "k") == []


def test_hours_without_zone_stay_apart(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:00 does not exist there on that day
        rows = [(dt.datetime(2021, 3, 14, h, 12, 30, 250),) for h in (1, 2, 3, 4)]
        out = spark.createDataFrame(rows, "t timestamp_ntz").select(period_of(F.col("t"), "hour").alias("h"))
        assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
        assert sorted(r["h"] for r in out.collect()) == [dt.datetime(2021, 3, 14, h) for h in (1, 2, 3, 4)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bucketed_grid_refuses_a_period_twice(spark):
    df = spark.createDataFrame([("a", MONTHS[0], 1.0), ("a", MONTHS[0], 2.0), ("a", MONTHS[3], 2.0)], "series string, time date, x double")
    for grid in (panel.regular_grid(df, ["series"], "time"), panel.regular_grid_bucketed(df, ["series"], "time", 12)):
        with pytest.raises(Exception, match="twice"):
            grid.collect()
