"""Exact top-k inner products through a pivot-distance index.

Vectors are keyed by their nearest pivot and by their distance from it, which cuts each pivot's vectors
into rings (annuli); large rings are salted into blocks of bounded size.  The triangle inequality bounds every score
in a ring: ``|q - v| >= |d(q, p) - d(v, p)|``, hence ``q.v <= (|q|^2 + max|v|^2 - gap^2) / 2``.

A query first searches a block of its own ring, which gives it a k-th best score.  Then its rings are sorted by
their bounds, and expansion stops at the first whose bound is below that score.  Every (block, chunk of
queries) is one bounded matrix product.  The pivots come from a bounded sample; the driver sees
them and one row per ring (at most pivots x rings), never vectors or scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialize, ship

SCALE, K, QUERY_EVERY, PIVOTS, RINGS, BLOCK_ROWS, QUERY_ROWS = 1024, 10, 100, 32, 16, 2048, 512
EXACT = 2.0 ** 53


def usable(vec: Column) -> Column:
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def scaled(vec: Column, scale: int = SCALE) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale))


def _matrix(lists, dim: int) -> np.ndarray:
    """Rows of integers, the short ones filled up with zeros."""
    out = np.zeros((len(lists), dim), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where no sum can leave its exact range."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if top < EXACT else a @ b.T


def _keyed(rows: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """Nearest pivot, distance from it, and squared norm of every row (id, v)."""
    def run(frames):
        for f in frames:
            x = _matrix(f["v"], dim).astype(float)
            norm = (x * x).sum(1)
            near = np.full(len(x), np.inf)
            which = np.zeros(len(x), np.int32)
            for i, p in enumerate(pivots):
                d = ((x - p) ** 2).sum(1)
                which[d < near] = i
                near = np.minimum(near, d)
            yield pd.DataFrame({"id": f["id"], "v": f["v"], "pivot": which, "dist": np.sqrt(near), "norm": norm})

    return rows.mapInPandas(run, "id bigint, v array<bigint>, pivot int, dist double, norm double")


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, n_pivots: int = PIVOTS, n_rings: int = RINGS,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries among ``vectors`` (vec_id, embedding; others are ignored).

    Rows without an id, and vectors that are null or hold null or non-finite components, take no
    part.  A query's own id is no candidate; repeated rows of an id and vector count once.  Vectors of
    different lengths are compared as if the short one ended in zeros.  Ties go to the smaller id."""
    ship(vectors.sparkSession)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("id"), scaled(F.col("embedding")).alias("v"))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    sample = rows.orderBy(F.xxhash64("id", F.lit("pivot")), "id", "v").limit(n_pivots).collect()
    pivots = _matrix([r["v"] for r in sample], dim).astype(float)
    index = _keyed(rows, pivots, dim)
    # rings of equal width between the smallest and the largest distance of the pivot
    index = materialize(index)
    span = {r["pivot"]: (r["lo"], r["hi"]) for r in index.groupBy("pivot").agg(
        F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect()}
    lo = F.element_at(F.array(*[F.lit(span.get(i, (0.0, 0.0))[0]) for i in range(len(pivots))] or [F.lit(0.0)]), F.col("pivot") + 1)
    wide = F.element_at(F.array(*[F.lit(max(span.get(i, (0.0, 0.0))[1] - span.get(i, (0.0, 0.0))[0], 1e-9)) for i in range(len(pivots))]
                                or [F.lit(1.0)]), F.col("pivot") + 1)
    ring = F.least(F.floor((F.col("dist") - lo) / wide * n_rings), F.lit(n_rings - 1)).cast("int")
    index = index.withColumn("ring", ring)
    rings = sorted((r["pivot"], r["ring"], r["lo"], r["hi"], r["top"], -(-r["n"] // block_rows)) for r in index.groupBy("pivot", "ring").agg(
        F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max("norm").alias("top"), F.count("*").alias("n")).collect())
    blocks_of = {(p, r): b for p, r, _, _, _, b in rings}
    salts = F.element_at(F.create_map(*[x for key, b in blocks_of.items() for x in (F.lit(key[0] * n_rings + key[1]), F.lit(b))])
                         if blocks_of else F.create_map(F.lit(0), F.lit(1)), F.col("pivot") * n_rings + F.col("ring"))
    index = index.withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
    queries = index.where(F.col("id") % query_every == 0).select("id", "v", "pivot", "dist", "norm", "ring").distinct()
    n_queries = queries.count()
    chunks = max(1, -(-n_queries // query_rows))
    chunk = F.pmod(F.xxhash64("id", F.lit("chunk")), F.lit(chunks)).cast("int")
    queries = queries.withColumn("chunk", chunk)

    def search(wanted: DataFrame) -> DataFrame:
        """Best k per query and block; ``wanted`` has (id, v, chunk, pivot, ring, salt)."""
        block = ("pivot", "ring", "salt")
        places = wanted.select(*[F.col(c).alias(f"b_{c}") for c in (*block, "chunk")]).distinct()
        blocks = index.select("id", "v", *[F.col(c).alias(f"b_{c}") for c in block]).join(places, [f"b_{c}" for c in block])
        blocks = blocks.select(*[F.col(c).alias(f"of_{c}") for c in blocks.columns])

        def run(key, q, b):
            a, m = _matrix(q["v"], dim), _matrix(b["of_v"], dim)
            ids = b["of_id"].to_numpy()
            got = []
            products = _products(a, m)
            for i, own in enumerate(q["id"].to_numpy()):
                s = products[i]
                ok = ids != own
                pos = np.flatnonzero(ok)
                if len(pos) > 4 * k:  # all that reach the k-th of the rows, with ties, then the distinct ids
                    floor = np.partition(s[pos], len(pos) - min(len(pos), k))[len(pos) - min(len(pos), k)]
                    strong = pos[s[pos] >= floor]
                    pos = strong if len(np.unique(ids[strong])) >= k else pos
                order = pos[np.lexsort((ids[pos], -s[pos]))]
                seen = set()
                for j in order:
                    pair = (int(ids[j]), int(s[j]))
                    if pair not in seen:
                        seen.add(pair)
                        got.append((int(own), *pair))
                        if len(seen) == k:
                            break
            return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

        return wanted.groupBy("pivot", "ring", "salt", "chunk").cogroup(
            blocks.groupBy(*[f"of_b_{c}" for c in (*block, "chunk")])).applyInPandas(
            run, "query_id bigint, vec_id bigint, score bigint")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = queries.withColumn("salt", F.lit(0))
    first = materialize(search(home))
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    floors = floors.select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    head = np.array([r[2:5] for r in rings], float).reshape(-1, 3)
    names = [(r[0], r[1], r[5]) for r in rings]

    def expand(frames):
        """The (query, block) pairs whose bound reaches the query's k-th best score so far."""
        for f in frames:
            out = {c: [] for c in ("id", "v", "chunk", "pivot", "ring", "salt")}
            for r in f.itertuples(index=False):
                q = np.zeros(dim)
                q[:len(r.v)] = r.v
                d = np.sqrt(((pivots - q) ** 2).sum(1))[[n[0] for n in names]]
                gap = np.maximum(0, np.maximum(head[:, 0] - d, d - head[:, 1]))
                bound = (r.norm + head[:, 2] - gap ** 2) / 2
                slack = 1 + 1e-9 * np.abs(bound)
                for i in np.argsort(-bound, kind="stable"):
                    if r.floor == r.floor and bound[i] + slack[i] < r.floor:
                        break  # the rest are sorted below it
                    p, g, n = names[i]
                    for s in range(n):
                        if (p, g, s) != (r.pivot, r.ring, 0):
                            for c, x in zip(out, (r.id, r.v, r.chunk, p, g, s), strict=True):
                                out[c].append(x)
            yield pd.DataFrame(out)

    more = queries.join(floors, "id", "left").select("id", "v", "chunk", "pivot", "ring", "norm", F.col("floor").cast("double").alias("floor"))
    more = more.mapInPandas(expand, "id bigint, v array<bigint>, chunk int, pivot int, ring int, salt int")
    both = first.unionByName(search(materialize(more))).distinct()
    return ranked(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH v AS (
  SELECT vec_id, [CAST(floor({SCALE} * x::DOUBLE) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % {QUERY_EVERY} = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
