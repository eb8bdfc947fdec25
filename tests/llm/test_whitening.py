"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import whitening
from panelcast.llm.whitening import one_sided_jacobi, pivoted_cholesky, whiten


def expected(rows):
    """({(id, vector): deviation}, n, eigenvalues, covariance, S) from (id, vector) rows by plain integers and numpy."""
    d = max(len(x) for _, x in rows)
    pad = [(i, tuple(int(np.floor(256 * float(c))) for c in x) + (0,) * (d - len(x))) for i, x in rows]
    fit = sorted({x for _, x in pad})
    n, s = len(fit), [sum(x[k] for x in fit) for k in range(d)]
    dev = [(i, x, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))) for i, x in pad]
    m = np.array([[n * a - b for a, b in zip(x, s, strict=True)] for x in fit], float) / n
    return dev, n, m.T @ m / n, s


def check(rows, got, components=4):
    dev, n, cov, s = expected(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    scores = []
    for i, x, d in dev:
        mine = by[(i, d)]
        assert {r["component"] for r in mine} == set(range(1, components + 1)) and {r["n"] for r in mine} == {n}
        centred = (np.array(x, float) * n - np.array(s, float)) / n
        w = [[r["whitened"] for r in mine if r["component"] == c][0] for c in range(1, components + 1)]
        scores.append((w, centred @ vectors[:, :components] / np.sqrt(values[:components])))
    got_w, want_w = (np.array(x) for x in zip(*scores, strict=True))
    sign = np.sign((got_w * want_w).sum(0))
    assert np.abs(got_w - want_w * sign).max() < 1e-8
    for c in range(components):
        e = {r["explained"] for r in got if r["component"] == c + 1}
        assert len(e) == 1 and abs(e.pop() / (values[c] / np.trace(cov)) - 1) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((6, 6), (9, 4), (5, 1), (3, 0)):
        a = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        v = a @ a.T
        f = pivoted_cholesky(v)
        assert f.shape[1] == rank and np.allclose(np.asarray(f @ f.T, float), v, rtol=1e-10, atol=1e-12 * np.abs(v).max(initial=1))
        e, u = one_sided_jacobi(f)
        assert np.all(np.diff(e.astype(float)) <= 0) and np.allclose(np.asarray(u.T @ u, float), np.eye(rank), atol=1e-12)
        assert np.allclose(np.asarray(v @ u, float), np.asarray(u * e, float), atol=1e-9 * np.abs(v).max(initial=1))
        if rank == d:
            assert np.allclose(e.astype(float), np.linalg.eigvalsh(v)[::-1], rtol=1e-9)


def test_query_against_numpy(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check([(i, np.array(x, np.float32)) for i, x in rows], whitening.query(spark, sf_dir).collect())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumn("Component", F.lit("clash")).withColumn("x", F.lit(0))


def test_edge_rows(spark):
    rng = np.random.default_rng(8)
    good = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    good += [good[0], (77, good[0][1]), (None, good[1][1]), (50, [0.5, 0.25]), (51, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]), (52, [])]
    bad = [(60, None), (61, [None] * 6), (62, [float("nan")] * 6), (63, [float("inf")] + [0.0] * 5), (64, [float("-inf")])]
    got = whiten(frame(spark, good + bad)).collect()
    assert len(got) == 4 * len(good)
    check(good, got)
    assert whiten(frame(spark, good).limit(0)).count() == 0 and whiten(frame(spark, bad)).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector: no direction
    line = whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    assert whiten(frame(spark, good)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_integers_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-2 ** 40, 2 ** 40, 3) / 256).tolist()) for i in range(200)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(frame(spark, rows)).collect()}
    dev = {i: d for i, _, d in expected(rows)[0]}
    assert got == {i: d if d < 2 ** 63 else None for i, d in dev.items()} and None in got.values()
    rows = [(i, (rng.integers(-2 ** 22, 2 ** 22, 3) / 256).tolist()) for i in range(200)]
    check(rows, whiten(frame(spark, rows)).collect(), 3)
