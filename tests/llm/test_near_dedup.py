"""ProbMinHash classes against brute force, and the parts on their own."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import near_dedup as N


def _runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)
    out = {}
    for r in runs:
        out[r] = out.get(r, 0) + 1
    return out


def _similarity(a, b):
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in a.keys() & b.keys())


def _brute(rows):
    runs = [_runs(t) for _, t in rows]
    label = list(range(len(rows)))
    holders = {}
    for i, r in enumerate(runs):
        for x in r:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for k, i in enumerate(h) for j in h[k + 1:]}
    for i, j in pairs:
        if len(runs[i].keys() & runs[j].keys()) * 3 > len(runs[i].keys() | runs[j].keys()) and _similarity(runs[i], runs[j]) >= 0.8 - 1e-12:
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    ids = {}
    for (d, _), c in zip(rows, label, strict=True):
        ids[c] = min(ids.get(c, d), d)
    return {d: ids[c] for (d, _), c in zip(rows, label, strict=True)}


def test_probability_jaccard():
    a, b = {1: 2, 2: 1, 5: 3}, {1: 1, 5: 2, 9: 4}
    got = N.probability_jaccard(np.array(sorted(a)), [a[k] for k in sorted(a)], np.array(sorted(b)), [b[k] for k in sorted(b)])
    assert got == pytest.approx(_similarity(a, b))


def test_registers_agree_with_the_similarity():
    rng = np.random.default_rng(3)
    a, b = {int(x): int(w) for x, w in zip(range(60), rng.integers(1, 4, 60))}, {int(x): int(w) for x, w in zip(range(20, 90), rng.integers(1, 4, 70))}
    text = np.repeat([0, 1], [len(a), len(b)])
    run = np.array([*a, *b], np.uint64)
    won = N.signatures(text, run, np.array([*a.values(), *b.values()]), 2, 4000)
    assert (won[0] == won[1]).mean() == pytest.approx(_similarity(a, b), abs=0.03)


def test_block_links_equal_pairwise():
    rng = np.random.default_rng(5)
    base = np.sort(rng.choice(10_000, 80, replace=False))
    sets = [np.unique(np.concatenate([rng.choice(base, 74, replace=False), rng.choice(10_000, rng.integers(0, 9))])) for _ in range(40)]
    weights = [np.ones(len(s), int) if i % 5 else rng.integers(1, 3, len(s)) for i, s in enumerate(sets)]
    side = {"label": [bytes([i]) for i in range(40)], "runs": sets, "weights": weights}
    got = {(int(i), int(j)) for i, j in N.block_links(side, side, 0.8, columns=64)}
    assert got == {(i, j) for i in range(40) for j in range(40) if i != j
                   and N.probability_jaccard(sets[i], weights[i], sets[j], weights[j]) >= 0.8 - 1e-12}


def test_classes_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(5000)])
    rows, i = [], 0
    for _ in range(25):
        base = list(rng.choice(words, rng.integers(30, 120)))
        for _ in range(rng.integers(1, 9)):
            text = list(base)
            for k in rng.integers(0, len(base), rng.integers(0, 4)):
                text[k] = str(rng.choice(words))
            rows.append((i, " ".join(text)))
            i += 1
    shared = list(rng.choice(words, 60))  # a family that shares a passage and is not alike otherwise
    rows += [(1000 + k, " ".join(shared + list(rng.choice(words, 14)))) for k in range(30)]
    for bucket in (16, 2):  # 2: nearly all mixed buckets go block by block
        monkeypatch.setattr(N, "SMALL_BUCKET", bucket)
        monkeypatch.setattr(N, "BLOCK_ROWS", 8)
        got = {r["doc_id"]: r["class_id"] for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == _brute(rows)


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in N.query(spark, sf_dir).collect()}
    assert got == _brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, "A b c d e f g"), (2, "a B c, d e f. g"), (3, None), (4, ""), (5, "..."), (6, "a b"), (7, "A-b"), (7, "A-b"),
            (None, "x y z x y z"), (8, long), (9, long + " end"), (10, "ÉA b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    got = sorted(N.classes(df).select("doc_id", "class_id", "class_size", "kept").collect(), key=str)
    as_dict = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in got}
    assert len(got) == len(rows)
    assert as_dict == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 3), 7: (6, 3), None: (None, 1), 8: (8, 2), 9: (8, 2), 10: (10, 1)}
    kept = N.stage(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 10]
    assert N.classes(df.limit(0)).count() == 0
