"""Registry of named queries: a Spark plan and (where SQL can say it) the DuckDB oracle text.

Doubles listed in ``r6`` are rounded to 6 decimals (ties to even on the binary value) on
both sides, so that summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    r6: Sequence[str] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, r6: Sequence[str] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(r6))
        return fn
    return deco


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    e = REGISTRY[name]
    df = e.fn(spark, sf_dir)
    if e.r6:
        df = df.select(*[(F.rint(F.col(c) * 1e6) / 1e6).alias(c) if c in e.r6 else F.col(c) for c in df.columns])
    return df


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT, Spark's BIGINT: cast every count_if(...) call."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def oracle(name: str) -> str | None:
    e = REGISTRY[name]
    if e.sql is None:
        return None
    sql = _bigint_counts(e.sql)
    if not e.r6:
        return sql
    rep = ", ".join(f"round_even(({c}) * 1000000.0, 0) / 1000000.0 AS {c}" for c in e.r6)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) oracle_q"


def load_all() -> dict[str, Entry]:
    # importing the modules fills the registry
    from panelcast.plans import q_analysis, q_eval, q_panel, q_quality, q_text  # noqa: F401
    return REGISTRY
