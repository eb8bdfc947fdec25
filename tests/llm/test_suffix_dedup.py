"""Removal of repeated byte strings: the merge, edge rows, and brute force over all windows."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import suffix_dedup
from panelcast.llm.suffix_dedup import common, dedup, decode, encode, merge


def brute(texts, length):
    """(bytes, removed, spans, digest) of every text."""
    data = [(t or "").encode() for t in texts]
    often = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - length + 1):
            if often[d[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        kept = bytes(x for x, g in zip(d, gone[1:], strict=False) if not g)
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), sha256(kept).hexdigest()))
    return out


def check(spark, texts, length, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in dedup(df, length=length, **more).collect()}
    want = brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want
    return want


def test_merge_equals_sort():
    rng = random.Random(3)
    lists = [sorted({bytes(rng.choices(b"ab", k=rng.randrange(0, 12))) for _ in range(rng.randrange(0, 30))}) for _ in range(7)]
    runs = [decode(encode(keys, [len(k) for k in keys], [[(b"r" * 16, n, 0, 0)] for _ in keys])) for n, keys in enumerate(lists)]
    got = list(merge(runs))
    assert [k for _, k, _ in got] == sorted(k for keys in lists for k in keys)
    keys = [k for _, k, _ in got]
    assert [s for s, _, _ in got[1:]] == [common(a, b, 0) for a, b in zip(keys, keys[1:], strict=False)]
    assert list(merge([])) == []


def planted(rng, n, alphabet, length):
    word = lambda k: "".join(rng.choices(alphabet, k=k))
    shared = [word(rng.randrange(length - 8, 3 * length)) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            s = rng.choice(shared)
            cut = rng.randrange(0, len(s))
            parts += [word(rng.randrange(0, length)), rng.choice([s, s[cut:], s[:cut], s[:cut] + "!" + s[cut:]])]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("more", [{}, {"hot": 3}, {"gram": 30}])
def test_windows_against_brute_force(spark, more):
    rng = random.Random(7)
    texts = [*planted(rng, 120, "abcdé ", 40), *planted(rng, 20, "ab", 40), "x" * 300, "xy" * 200, "ab" * 17, "", None, "x" * 39, "x" * 40]
    texts += [texts[3], texts[3], texts[5] + "z"]
    want = check(spark, texts, 40, **({"gram": 10} | more))
    assert 0 < sum(w[1] for w in want) < sum(w[0] for w in want)


def test_offset_wise_comparison_equals_pairs(spark, monkeypatch):
    texts = planted(random.Random(5), 150, "abcd ", 40)
    monkeypatch.setattr(suffix_dedup, "FEW", 2)
    entries = lambda: [suffix_dedup.Entry(b"12345678" + t.encode()[20:60] + t.encode()[:20][::-1], 40, [(b"r" * 16, 0, 0, 0)], 0, 40)
                       for t in sorted(x for x in texts if len(x) > 60)]
    for n in (3, 40):
        rows = sorted(entries()[:n], key=lambda e: e.after + e.before)
        suffix_dedup.mark(rows, 40)
        for e in rows:
            want = {o for o in range(e.low, e.high + 1) if any(
                e is not x and e.after[:40 - o] == x.after[:40 - o] and e.before[:o] == x.before[:o] for x in rows)}
            assert e.found == want


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    data = " ".join(f"w{i % 97}" for i in range(600)).encode()
    rows = list(zip(*suffix_dedup.anchors(data, 40, 10), strict=True))
    windows = sorted(w for _, first, last, _ in rows for w in range(first, last + 1))
    assert windows == list(range(len(data) - 39))
    assert all(first <= at <= first + 30 for at, first, _, _ in rows)


def test_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (None, "a" * 900), (None, "a" * 900), (3, long), (4, "q" + long[:500]), (5, "b" * 399), (5, "b" * 399), (6, "é" * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N_Bytes", F.lit("clash")).withColumn("ref", F.lit("mine"))
    out = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["ref"]) for r in dedup(df).collect()))
    n = len(long)
    assert out == [(0, 900, 900, 1, "mine"), (0, 900, 900, 1, "mine"), (1, 0, 0, 0, "mine"), (2, 0, 0, 0, "mine"), (3, n, 500, 1, "mine"),
                   (4, 501, 500, 1, "mine"), (5, 399, 0, 0, "mine"), (5, 399, 0, 0, "mine"), (6, 400, 0, 0, "mine")]
    assert dedup(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.query(spark, sf_dir).collect()}
    assert [got[i] for i, _ in texts] == brute([t for _, t in texts], 400)
