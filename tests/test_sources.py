"""Text sources on hand-made files (two per format): fixed columns, wide year x month with a
second table, sentinel rows and run-together values, and daily rows with amplitude gating."""
import datetime as dt
import math
import os

import pytest

from panelcast.sources import text

FIXED_1 = """ YR   MON  NINO1+2  ANOM   NINO3    ANOM   NINO4    ANOM NINO3.4    ANOM

 1990   1   23.50   -0.50   25.10    0.10   28.20    0.20   26.40    0.30
 1990   2   24.50    0.50   26.10    0.20   28.30    0.30   26.50    0.40
 90     3   24.50    0.50   26.10    0.20   28.30    0.30   26.50    0.40
 abcd   3   24.50    0.50   26.10    0.20   28.30    0.30   26.50    0.40
 9999   3   24.50    0.50   26.10    0.20   28.30    0.30   26.50    0.40
 1990   3   25.00    x.xx   26.00    0.00   28.00    0.00   26.00   -0.10
"""
FIXED_2 = """YR MON NINO1+2 ANOM NINO3 ANOM NINO4 ANOM NINO3.4 ANOM
2001 12 20.0 1.0 21.0 1.1 22.0 1.2 23.0 1.3
"""

WIDE_1 = """                    STANDARDIZED DATA
YEAR   JAN   FEB   MAR   APR   MAY   JUN   JUL   AUG   SEP   OCT   NOV   DEC
1951   1.5   0.9  -0.1  -0.3  -0.7   0.2  -1.0  -0.2  -1.1  -1.0  -0.8  -0.7
1952   2.0-999.9-999.9   0.1   0.2   0.3   0.4   0.5   0.6   0.7   0.8   0.9
9999 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9 -999.9

                    ANOMALY
YEAR   JAN   FEB   MAR   APR   MAY   JUN   JUL   AUG   SEP   OCT   NOV   DEC
1951   9.9   9.9   9.9   9.9   9.9   9.9   9.9   9.9   9.9   9.9   9.9   9.9
"""
WIDE_2 = """YEAR JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC
2020 0.1 0.2 0.3 0.4 0.5 0.6 0.7 0.8 0.9 1.0 1.1 -999.9
"""

DAILY_1 = """RMM values
year month day RMM1 RMM2 phase amplitude source
1990 1 1 0.5 0.5 3 1.5 Final
1990 1 2 1.0 0.0 5 0.5 Final
1990 1 3 999 999 999 999 Final
1990 2 1 0.2 0.2 1 1.0 Final
"""
DAILY_2 = """header
h2
2000 6 15 -1.0 1.0 7 2.0 Final
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("text")
    out = {}
    for kind, pairs in {"fixed": [("stationA.txt", FIXED_1), ("stationB.txt", FIXED_2)],
                        "wide": [("soi.txt", WIDE_1), ("wind.txt", WIDE_2)],
                        "daily": [("rmm.txt", DAILY_1), ("rmm2.txt", DAILY_2)]}.items():
        os.makedirs(d / kind)
        for name, body in pairs:
            (d / kind / name).write_text(body)
        out[kind] = str(d / kind)
    return out


def test_fixed_columns(spark, files):
    rows = {(r.series, r.period): r for r in text.read_fixed(spark, files["fixed"]).collect()}
    assert set(rows) == {("stationA", dt.date(1990, 1, 1)), ("stationA", dt.date(1990, 2, 1)),
                         ("stationA", dt.date(1990, 3, 1)), ("stationB", dt.date(2001, 12, 1))}
    a1 = rows[("stationA", dt.date(1990, 1, 1))]
    assert (a1.nino12, a1.nino12_anom, a1.nino34, a1.nino34_anom) == (23.5, -0.5, 26.4, 0.3)
    assert rows[("stationA", dt.date(1990, 3, 1))].nino12_anom is None          # garbled token -> missing
    assert rows[("stationB", dt.date(2001, 12, 1))].nino34_anom == 1.3


def test_year_line_rule(spark):
    df = spark.createDataFrame([(" 1990 1 2",), ("90 1",), ("YEAR JAN",), ("9999 -999.9",), ("",), ("1899 1",)], "value string")
    got = [r.ok for r in df.select(text.year_line(df.value).alias("ok")).collect()]
    assert got == [True, False, False, False, False, False]


def test_wide_months_first_table_and_sentinels(spark, files):
    df = text.read_wide_months(spark, files["wide"], value_name="soi")
    rows = {(r.series, r.period): r.soi for r in df.collect()}
    assert len([k for k in rows if k[0] == "soi"]) == 24            # 1951 and 1952 only: 9999 row and 2nd table dropped
    assert rows[("soi", dt.date(1951, 1, 1))] == 1.5 and rows[("soi", dt.date(1951, 12, 1))] == -0.7
    assert rows[("soi", dt.date(1952, 1, 1))] == 2.0                # run-together token split
    assert rows[("soi", dt.date(1952, 2, 1))] is None and rows[("soi", dt.date(1952, 3, 1))] is None
    assert rows[("soi", dt.date(1952, 4, 1))] == 0.1
    assert rows[("wind", dt.date(2020, 11, 1))] == 1.1 and rows[("wind", dt.date(2020, 12, 1))] is None


def test_wide_months_strict(spark, files):
    df = text.read_wide_months(spark, files["wide"], value_name="soi", strict=True)
    rows = {(r.series, r.period): r.soi for r in df.collect()}
    assert rows[("soi", dt.date(1952, 1, 1))] is None               # whole token missing, as the reference does
    assert rows[("soi", dt.date(1952, 2, 1))] == 0.1                # later months shifted


def test_wide_other_value_name(spark, files):
    assert "zwnd850_anom" in text.read_wide_months(spark, files["wide"], value_name="zwnd850_anom").columns


def test_daily_monthly_means(spark, files):
    rows = {(r.series, r.period): r for r in text.read_daily(spark, files["daily"]).collect()}
    jan = rows[("rmm", dt.date(1990, 1, 1))]
    assert abs(jan.rmm1 - 0.75) < 1e-12 and abs(jan.mjo_amplitude - 1.0) < 1e-12    # 999 row skipped in means
    s3 = math.sin(2 * math.pi * 2 / 8)
    assert abs(jan.mjo_sin - (s3 + 0.0 + 0.0) / 3) < 1e-12                        # gate: amp 0.5 and missing -> 0
    feb = rows[("rmm", dt.date(1990, 2, 1))]
    assert abs(feb.mjo_cos - 1.0) < 1e-12                                         # amplitude exactly 1.0 is active
    assert rows[("rmm2", dt.date(2000, 6, 1))].rmm2 == 1.0


def test_registry_flags(spark):
    a = spark.createDataFrame([("s", dt.date(2000, 1, 1), 1.0)], "series string, period date, a double")
    b = spark.createDataFrame([("s", dt.date(2000, 2, 1), 2.0)], "series string, period date, b double")
    out = text.registry({"a": (lambda: a, True), "b": (lambda: b, True), "c": (lambda: 1 / 0, False)}, ["series", "period"])
    assert sorted((r.period, r.a, r.b) for r in out.collect()) == [(dt.date(2000, 1, 1), 1.0, None), (dt.date(2000, 2, 1), None, 2.0)]


def test_month_strings_select_whole_months(spark):
    from panelcast.operators import panel
    days = spark.createDataFrame([(dt.date(2000, 3, d),) for d in (1, 15, 31)] + [(dt.date(2000, 4, 1),)], "day date")
    assert panel.filter_time_range(days, "day", "2000-03", "2000-03").count() == 3


def test_grid_refuses_a_period_that_occurs_twice(spark):
    import pytest
    from panelcast.operators import panel
    df = spark.createDataFrame([("s", dt.date(2000, 1, 1), 1.0), ("s", dt.date(2000, 1, 1), 2.0), ("s", dt.date(2000, 3, 1), 3.0)],
                               "series string, period date, x double")
    with pytest.raises(Exception, match="period twice"):
        panel.regular_grid(df, ["series"], "period").collect()


def _many_series(tmp_path, n=40):
    """One file of ``n`` series, each with two tables and a header between them, and some without a second table."""
    lines, want = [], {}
    for k in range(n):
        name = f"st{k:02d}"
        rows = [[1950 + y, *[round(k + y / 10 + m / 100, 2) for m in range(12)]] for y in range(1 + k % 5)]
        lines += [f"{name} some title", f"{name} YEAR JAN", f"{name}"]
        for r in rows:
            lines.append(name + " " + " ".join(map(str, r)))
            want |= {(name, dt.date(r[0], m + 1, 1)): r[m + 1] for m in range(12)}
        if k % 3:
            lines += [f"{name} 9999 1.0", "", f"{name} ANOMALY", f"{name} 1950" + " 7.7" * 12, f"{name} 1999" + " 7.7" * 12]
    (tmp_path / "all.txt").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "all.txt"), want


@pytest.mark.parametrize("block", ["64", "700", "128m"])
def test_wide_many_series_in_one_file_over_blocks(spark, tmp_path, block):
    path, want = _many_series(tmp_path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = text.read_wide_months(spark, path, series_from="column").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(want) and {(r.series, r.period): r.soi for r in got} == want


def test_one_file_moves_no_line(spark, tmp_path):
    """Only marks are aggregated by shuffle; the lines keep their tasks unless the table of cuts is large."""
    lines = text._lines(spark, _many_series(tmp_path)[0], "column")
    plan = text.first_table(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "wholetext" not in plan.lower()


def test_fixed_many_series_in_one_file(spark, tmp_path):
    (tmp_path / "f.txt").write_text("a YR MON X\nb 1990 1 1.5\na 1990 1 2.5\n\na 9999 1 3.0\nb 1990 2 bad\n")
    got = text.read_fixed(spark, str(tmp_path / "f.txt"), columns=("x",), series_from="column").collect()
    assert {(r.series, r.period): r.x for r in got} == {
        ("b", dt.date(1990, 1, 1)): 1.5, ("a", dt.date(1990, 1, 1)): 2.5, ("b", dt.date(1990, 2, 1)): None}


def test_wide_year_run_into_january(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1951-1980 mean\n1951-999.9 0.1" + " 0.2" * 10 + "\n1952-0.5" + " 0.3" * 11 + "\n")
    got = {r.period: r.soi for r in text.read_wide_months(spark, str(tmp_path)).collect()}
    assert len(got) == 24 and got[dt.date(1951, 1, 1)] is None and got[dt.date(1951, 2, 1)] == 0.1
    assert got[dt.date(1952, 1, 1)] == -0.5 and got[dt.date(1952, 12, 1)] == 0.3
    assert text.read_wide_months(spark, str(tmp_path), strict=True).count() == 0
