"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import string
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir

#: A word is a run of characters other than these (in lower case).
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A token of white-space separated text.
TOKEN = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast up to this many rows (checked by counting it), joined by shuffle above.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read from there: its lineage is cut, and
    the loss of an executor loses none of it.  (A checkpoint() would hand the constraints of the old plan on, which
    iterations pile up.)"""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _passing:
        _passing[-1].append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read any more: what was made of them is written itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_passing: list[list[DataFrame]] = []


@contextmanager
def passing():
    """Tables that ``materialize`` writes inside are deleted at the end, but for those given to the function that this hands out."""
    _passing.append([])
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        discard(*(t for t in _passing.pop() if not any(t is k for k in kept)))


def ship(spark: SparkSession) -> None:
    """Send this library's code to the executors, once per Spark application: Python tasks import it there."""
    sc = spark.sparkContext
    if getattr(sc, "_panelcast_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="panelcast-code-"), "panelcast-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                z.write(file, os.path.relpath(file, os.path.dirname(package)))
    sc.addPyFile(archive)  # served by the driver
    sc._panelcast_shipped = True


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when lambdas inside use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged; null as empty."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.rlike(r"[^\x00-\x7F]"), F.translate(t, string.ascii_uppercase, string.ascii_lowercase))
            .otherwise(F.lower(t)))


def words(text: Column) -> Column:
    """The lower-case words of the whole text, in order."""
    return F.array_remove(F.split(ascii_lower(text), NO_WORD), "")


def tail(arr: Column, skip: int) -> Column:
    """``arr`` without its first ``skip`` elements."""
    return F.slice(arr, F.lit(skip + 1), F.greatest(F.size(arr) - skip, F.lit(0)))


def head(arr: Column, drop: int) -> Column:
    """``arr`` without its last ``drop`` elements."""
    return F.slice(arr, F.lit(1), F.greatest(F.size(arr) - drop, F.lit(0)))


def _pairs(arr: Column, other: Column, shift: int, fn) -> Column:
    """``fn(arr[i], other[i + shift])`` for every i where both exist."""
    return let(other, lambda o: let(arr, lambda a: let(
        F.greatest(F.least(F.size(a), F.size(o) - shift), F.lit(0)),
        lambda n: F.zip_with(F.slice(a, F.lit(1), n), F.slice(o, F.lit(shift + 1), n), fn))))


def sliding_hash(hashes: Column, k: int) -> Column:
    """Hash of every k consecutive elements, built from runs of half the length."""
    if k == 1:
        return hashes
    half = k // 2
    return let(hashes, lambda h: let(sliding_hash(h, half), lambda lo: _pairs(
        lo, lo if k == 2 * half else sliding_hash(h, k - half), half, lambda a, b: F.xxhash64(a, b))))


def sliding_min(values: Column, w: int) -> Column:
    """Minimum of every w consecutive elements."""
    if w == 1:
        return values
    half = (w + 1) // 2
    return let(values, lambda v: let(sliding_min(v, half), lambda m: _pairs(
        m, m, w - half, lambda a, b: F.least(a, b))))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (written already) with a broadcast hint if it has no more than ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_same(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` (names, or left: right names) in which nulls match; the right keys go."""
    keys = keys if isinstance(keys, dict) else {k: k for k in keys}
    for i, k in enumerate(keys.values()):
        right = right.withColumnRenamed(k, f"_key{i}")
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return left.join(right, cond, how).drop(*[f"_key{i}" for i in range(len(keys))])


def hex_number(text: Column, digits: int = 8) -> Column:
    """The first hex digits of the MD5 of a string as a number, which other engines can repeat."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")
