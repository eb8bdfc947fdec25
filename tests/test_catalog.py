"""Driver contract: entry() smoke run, query/oracle key consistency, and a sample of queries
against the DuckDB oracle on the smallest tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SAMPLE = ["c4_features", "e2_classification", "j1_full_outer_merge", "j8_walk_forward", "w7_ffill_hourly",
          "x1_export", "q3_future_lag_value", "s4_wide_to_long", "c4_features_bucketed", "c4_features_gapped",
          "w8_ffill_unbounded_bucketed", "q8_leakage_report"]


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and set(df.columns) >= {"target", "model", "accuracy", "f1_macro", "n"}


def test_keys_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 120


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) <= 10 or v.isoformat().endswith("T00:00:00") else v.isoformat()
    return v


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "supplier", "events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    exp = sorted((tuple(_norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == exp
