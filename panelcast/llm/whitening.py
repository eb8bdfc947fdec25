"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors become integers.  Each distinct vector counts once.  Tasks add up sums and products of their vectors as integers, Spark adds
the tasks' entries exactly, and the driver sees one matrix of dimension x dimension numbers, never vectors.  The
scatter ``n * sum(x x') - S S'`` is an exact integer matrix; it is turned into floating point once.  Pivoted Cholesky
factors it as L L' (the pivots give the rank), and rotations of pairs of L's columns make them orthogonal: their squared norms are
the eigenvalues, the normalised columns the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import materialize, ship
from panelcast.llm.topk_search import usable

SCALE, COMPONENTS = 256, 4
#: Sums of products stay in 64-bit integers up to this size, beyond it they are Python's own integers.
SAFE = 2 ** 62
LONG = 2 ** 63


def scaled(vec: Column, scale: int = SCALE) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale))


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """Rows x rank factor L with L L' = v, its rows in the order of v.  Stops where no pivot is left above rounding."""
    left = np.array(v, np.longdouble)
    d = len(left)
    least = np.finfo(np.float64).eps * d * max(float(np.diag(left).max(initial=0)), 0.0)
    columns = []
    for _ in range(d):
        p = int(np.argmax(np.diag(left)))
        if not left[p, p] > least:
            break
        column = left[:, p] / np.sqrt(left[p, p])
        for known in range(len(columns)):  # earlier pivots are done: exact zeros
            column[columns[known][0]] = 0
        left = left - np.outer(column, column)
        left[p, :] = left[:, p] = 0
        columns.append((p, column))
    return np.stack([c for _, c in columns], 1) if columns else np.zeros((d, 0), np.longdouble)


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor factor', by falling eigenvalue."""
    a = np.array(factor, np.longdouble)
    r = a.shape[1]
    tiny = np.finfo(np.longdouble).eps * 8
    for _ in range(sweeps):
        turned = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                x, y = a[:, i], a[:, j]
                p, q, c = x @ x, y @ y, x @ y
                if c == 0 or abs(c) <= tiny * np.sqrt(p * q):
                    continue
                turned = True
                z = (q - p) / (2 * c)
                t = (1 if z >= 0 else -1) / (abs(z) + np.sqrt(1 + z * z))
                cos = 1 / np.sqrt(1 + t * t)
                a[:, i], a[:, j] = cos * x - cos * t * y, cos * t * x + cos * y
        if not turned:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], a[:, order] / np.sqrt(values[order])


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of integers, the short ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _top(m: np.ndarray) -> int:
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))


def _products(m: np.ndarray) -> np.ndarray:
    """m' m in exact integers."""
    top = _top(m)
    if top * top * max(1, len(m)) < 2 ** 53:
        x = m.astype(float)
        return (x.T @ x).astype(np.int64)
    if top * top * max(1, len(m)) < SAFE:
        return m.T @ m
    x = m.astype(object)
    return x.T @ x


def moments(vectors: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """(n, S, sum of x x') of ``vectors`` (x), as exact integers.  Each task sends one row per entry of a triangle."""
    upper = [(i, j) for i in range(dim) for j in range(i, dim)]

    def run(batches):
        n, total, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for b in batches:
            m = _matrix(b.column(0), dim)
            n += len(m)
            total = total + m.sum(0) if _top(m) * max(1, len(m)) < SAFE else total + m.astype(object).sum(0)
            products = products + _products(m)
        if n:
            entries = [(-1, -1, n), *((i, -1, total[i]) for i in range(dim)), *((i, j, products[i, j]) for i, j in upper)]
            yield pa.record_batch([pa.array([e[0] for e in entries], pa.int32()), pa.array([e[1] for e in entries], pa.int32()),
                                   pa.array([str(int(e[2])) for e in entries], pa.string())], ["i", "j", "v"])

    parts = vectors.mapInArrow(run, "i int, j int, v string")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v"))
    n, total, products = 0, [0] * dim, np.zeros((dim, dim), object)
    for r in sums.collect():  # dimension ^ 2 / 2 numbers
        if r["i"] < 0:
            n = int(r["v"])
        elif r["j"] < 0:
            total[r["i"]] = int(r["v"])
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = int(r["v"])
    return n, total, products


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for the rows of ``rows`` (vec_id, embedding; others
    are ignored), a row per component.

    Vectors that are null or hold null or non-finite entries take no part.  Repeated rows come out alike and count once in the
    fit, as do rows of one vector under several ids; null ids are kept.  Short vectors, the empty one among them, end in
    zeros up to the longest.  Entries beyond 64 bits after scaling saturate; a ``deviation`` beyond 64 bits is null.
    There are no more components than the rank of the covariance: none, thus no rows, for an empty table or one distinct vector.
    Components of equal eigenvalues are any orthogonal ones, the same for all rows.  Long tables cost two passes over the distinct
    vectors and one over the rows."""
    ship(rows.sparkSession)
    kind = rows.schema["vec_id"].dataType.simpleString()
    used = rows.where(usable(F.col("embedding"))).select("vec_id", scaled(F.col("embedding"), scale).alias("x"))
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    dim = used.agg(F.max(F.size("x"))).first()[0] or 0
    if not dim:
        return rows.sparkSession.createDataFrame([], schema)
    # equal vectors are equal after the zeros at their end are gone
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("x")))
    distinct = materialize(used.select(padded.alias("x")).distinct())
    n, total, products = moments(distinct, dim)
    exact = n * products - np.outer(np.array(total, object), np.array(total, object))  # n^2 times the covariance
    covariance = np.array([[np.longdouble(int(x) // n) / n + np.longdouble(int(x) % n) / n / n for x in row] for row in exact], np.longdouble)
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
    keep = min(components, len(values))
    if not keep:
        return rows.sparkSession.createDataFrame([], schema)
    trace = np.trace(covariance)
    explained = [float(v / trace) for v in values[:keep]]
    project = np.asarray(vectors[:, :keep] / np.sqrt(values[:keep]), np.float64)
    sums = np.array([int(s) for s in total], object)
    bounded = max((abs(int(s)) for s in total), default=0)

    def deviations(m: np.ndarray):
        """n * x - S, exact."""
        if n * _top(m) + bounded < SAFE:
            return m * np.int64(n) - sums.astype(np.int64)
        return m.astype(object) * n - sums

    def errors(batches):
        out = np.zeros((keep, keep))
        for b in batches:
            w = np.asarray(deviations(_matrix(b.column(0), dim)), float) / n @ project
            out += w.T @ w
        yield pa.record_batch([pa.array([i for i in range(keep) for _ in range(keep)], pa.int32()),
                               pa.array([j for _ in range(keep) for j in range(keep)], pa.int32()), pa.array(out.ravel())], ["i", "j", "v"])

    found = distinct.mapInArrow(errors, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    error = max(abs(r["v"] / n - (r["i"] == r["j"])) for r in found)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dev = deviations(_matrix(b.column(1), dim))
            w = (np.asarray(dev, float) / n @ project).ravel()
            top = _top(dev) if dev.dtype != object else LONG
            squares = ((dev * dev).sum(1) if top * top * dim < SAFE else (dev.astype(object) ** 2).sum(1))
            squares = [int(s) if s < LONG else None for s in squares.tolist()]
            at = np.repeat(np.arange(b.num_rows), keep)
            yield pa.record_batch([
                b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), b.num_rows)),
                pa.array(np.full(len(at), n, np.int64)), pa.array(squares, pa.int64()).take(pa.array(at)), pa.array(w),
                pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(len(at), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return used.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
