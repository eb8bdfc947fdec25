"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its words and of their four-letter beginnings, hashed to ``DIM`` places.  The machine
has a linear weight for each place and a factor vector whose inner products weigh pairs of terms: an
insult next to the mention of a group can count for more than both alone.

It is fitted on a bounded sample of labelled rows (``sample_rows`` per label, chosen by a hash of the id; each
label's rows are weighted back to their share of all labelled rows, which Spark counts).  Scoring is a
broadcast of the fitted weights, whose size ``sample_rows`` and ``DIM`` bound, to tasks that each score their own rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import let, ship, words

DIM, FACTORS, SAMPLE_ROWS, PREFIX = 2 ** 20, 4, 5_000, 4
LEAST_L1 = 5.0
EPOCHS, BATCH, ALPHA, L1, RATE, SEED = 5, 64, 0.5, 0.1, 0.02, 7


def terms(text: Column) -> Column:
    """The places of the distinct terms of the whole text."""
    place = lambda w, salt: F.pmod(F.xxhash64(w, F.lit(salt)), F.lit(DIM)).cast("int")
    return let(F.array_distinct(words(text)), lambda ws: F.array_distinct(F.concat(
        F.transform(ws, lambda w: place(w, 0)), F.transform(ws, lambda w: place(F.substring(w, 1, PREFIX), 1)))))


class Machine:
    """score = w0 + sum w_i + sum over pairs <v_i, v_j>, for the terms with a nonzero linear weight."""

    def __init__(self, bias: float, places: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.bias, self.places, self.w, self.v = bias, places, w, v

    def scores(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities for rows given as their places one after the other, and their numbers."""
        rows = np.repeat(np.arange(len(counts)), counts)
        at = np.searchsorted(self.places, flat)
        known = at < len(self.places)
        known[known] = self.places[at[known]] == flat[known]
        rows, at = rows[known], at[known]
        n = len(counts)
        out = self.bias + np.bincount(rows, self.w[at], n)
        for f in range(self.v.shape[1]):
            x = self.v[at, f]
            out += 0.5 * (np.bincount(rows, x, n) ** 2 - np.bincount(rows, x * x, n))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """Fit on rows of places.  Linear weights by follow-the-regularized-leader with an L1 term, which leaves
    out terms that tell nothing; factors of the remaining terms by AdaGrad."""
    total = weights.sum()
    shrink = max(LEAST_L1, L1 * np.sqrt(total))  # the noise of a sum over the rows grows with their root
    rate = (float((weights * labels).sum()) + 0.1) / (total + 1)
    prior = np.log(rate / (1 - rate))
    if not rows or labels.min() == labels.max():
        return Machine(prior, np.empty(0, np.int64), np.empty(0), np.empty((0, factors)))
    counts = np.array([len(r) for r in rows])
    places, flat = np.unique(np.concatenate(rows), return_inverse=True)
    start = np.concatenate([[0], np.cumsum(counts)])
    n, rng = len(places), np.random.default_rng(SEED)
    z, sq, w = np.zeros(n), np.zeros(n), np.zeros(n)
    v, vsq = rng.normal(0, 0.01, (n, factors)), np.full((n, factors), 1e-6)
    bias, bsq = prior, 1.0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            pick = order[b:b + BATCH]
            at = np.concatenate([flat[start[i]:start[i + 1]] for i in pick])
            row = np.repeat(np.arange(len(pick)), counts[pick])
            on = w[at] != 0
            a, r, k = at[on], row[on], len(pick)
            x = v[a]
            sums = np.stack([np.bincount(r, x[:, f], k) for f in range(factors)], 1)
            squares = np.bincount(r, (x * x).sum(1), k)
            raw = bias + np.bincount(r, w[a], k) + 0.5 * ((sums ** 2).sum(1) - squares)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]) * weights[pick]
            bsq += float((g * g).sum())
            bias -= ALPHA * float(g.sum()) / np.sqrt(bsq)
            used, inverse = np.unique(at, return_inverse=True)
            gw = np.bincount(inverse, g[row], len(used))
            new = sq[used] + gw * gw
            z[used] += gw - (np.sqrt(new) - np.sqrt(sq[used])) / ALPHA * w[used]
            sq[used] = new
            zu = z[used]
            w[used] = np.where(np.abs(zu) <= shrink, 0, -(zu - np.sign(zu) * shrink) / ((1 + np.sqrt(new)) / ALPHA))
            if len(a):
                au, ai = np.unique(a, return_inverse=True)
                for f in range(factors):
                    gv = np.bincount(ai, g[r] * (sums[r, f] - x[:, f]), len(au)) + 1e-4 * v[au, f]
                    vsq[au, f] += gv * gv
                    v[au, f] -= RATE * gv / np.sqrt(vsq[au, f] + 1)
    keep = w != 0
    return Machine(bias, places[keep].astype(np.int64), w[keep], v[keep])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on the labelled rows outside the held-out fifth; a row's label is the largest ``toxic`` of its id."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y")))
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = []
    for y in sorted(share):
        chosen = known.where(F.col("y") == y).select("doc_id", F.xxhash64("doc_id", F.lit("fit")).alias("h")).orderBy("h").limit(sample_rows)
        parts.append(chosen.withColumn("y", F.lit(y)))
    if not parts:
        return fit([], np.empty(0), np.empty(0))
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # the bounded sample comes as columns of numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("h", "y", terms(F.col("text")).alias("t")).toArrow()
    lists = pa.chunked_array(sample["t"].chunks, sample["t"].type).combine_chunks()
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    order = np.lexsort((np.diff(ends), sample["h"].to_numpy()))
    y = sample["y"].to_numpy()[order].astype(float)
    n = {k: max(1, int((y == k).sum())) for k in share}
    return fit([flat[ends[i]:ends[i + 1]] for i in order], y, np.array([share[int(k)] / n[int(k)] for k in y]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` (doc_id, text, any others) with ``score`` and ``predicted`` added (they replace columns of those
    names in any case of letters).

    One row per input row.  Null and empty texts get the score of a text without terms; repeated rows
    come out alike."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(machine)
    keep = [c for c in docs.columns if c.lower() not in ("score", "predicted")]

    @F.pandas_udf("double")
    def apply(t):
        import pandas as pd

        counts = t.str.len().to_numpy()
        flat = np.concatenate([np.empty(0, np.int64), *t]).astype(np.int64)
        return pd.Series(shared.value.scores(flat, counts))

    out = docs.select(*keep, apply(terms(F.col("text"))).alias("score"))
    return out.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the machine, trained on all labelled ``documents``, does not reject, with columns of any name
    as they were.  Null and empty texts are scored as texts without terms, texts of any length are read whole, an empty table gives no rows."""
    machine = train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text", F.struct(*docs.columns).alias("own")), machine).where("predicted = 0").select("own.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
