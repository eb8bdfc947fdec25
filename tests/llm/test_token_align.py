"""Alignment of two tokenizers against a direct count over whole texts."""

import cProfile
import pstats
import random
from bisect import bisect_left
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import token_align
from panelcast.llm.token_align import alignments, chunks_of
from panelcast.llm.token_counts import tokenizer_path


@pytest.fixture(scope="module")
def both():
    return token_align.Tokenizers(tokenizer_path(token_align.A_FILE), tokenizer_path(token_align.B_FILE))


def brute(texts, of):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every text, encoded whole, links by comparing all tokens of a group."""
    rows, held = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = of.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = of.b.encode(text or "")
        ta, tb = [of.a_bytes[x] for x in a], [of.b_bytes[x] for x in b]
        if not text or b"".join(ta) != whole or b"".join(tb) != whole:
            rows.append(None)
            continue
        ends = [[0], [0]]
        for side, toks in zip(ends, (ta, tb), strict=True):
            for t in toks:
                side.append(side[-1] + len(t))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            mine = [range(bisect_left(e, lo), bisect_left(e, hi)) for e in ends]
            groups.append(",".join(str(a[k]) for k in mine[0]) + "|" + ",".join(str(b[k]) for k in mine[1]))
            links += [(a[x], b[y]) for x in mine[0] for y in mine[1] if ends[0][x] < ends[1][y + 1] and ends[1][y] < ends[0][x + 1]]
        rows.append((len(a), len(b), groups, links))
        held.update(set(links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else (
        r[0], r[1], len(r[2]), len(r[3]), sum(held[p] == top[p[0]] for p in r[3]), sum(held[p] for p in r[3]),
        sha256(";".join(r[2]).encode()).hexdigest()) for r in rows]


def rows_of(df):
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()}


ODD = [None, "", " ", "  ", "a", " a", "  a  b ", "a \n b", "a\n  b\n\n c", "\t x", "tab\t y\t\tz ", "▁x ▁", "<s></s><unk><|endoftext|> x", "é①🙂한\x00 \x1c y",
       "a\x85b \x85c", "a　 b c  d", "don't  we'll I'M", "x=1;  y  =22", "a" * 3000, " " * 300, "ab " * 2000 + " \n", "ﬁne ½ Å", "​ ﻿ z", "<0x41> <0x0A>"]


def test_odd_texts_against_brute_force(spark, both):
    rng = random.Random(1)
    texts = [*ODD, *ODD[-4:], *("".join(rng.choices(["a", "the", " ", " ", "\n", "\t", ".", "12", "é", "'s", "  "], k=60)) for _ in range(150))]
    texts.append(" ".join(f"t{i}" for i in range(20_000)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("Pairs", F.lit("clash")).withColumn("row", F.lit(1))
    assert rows_of(alignments(df.repartition(3))) == dict(enumerate(brute(texts, both)))


def test_chunks_are_the_text(both):
    for text in ODD:
        if text:
            parts = chunks_of(text)
            assert " ".join(parts) == text


def test_new_words_are_aligned_many_at_a_time(both):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(5_000)]
    words += [w + rng.choice([".", ", x", "\n" + w, "1", "é"]) for w in words]
    table, seen = token_align.Table(both), cProfile.Profile()
    seen.runcall(table.add, words)
    assert pstats.Stats(seen).total_calls < 10 * len(words)
    # what the calls of one and of many parts find
    odd = ["ﬁne", "½", "Å", "x", "a　b", "\x00", "①", "é", "<unk>", "x" * 40, "▁", "y▁"]
    parts = [" " + w for w in [*odd, *words[:50], *odd]]
    shown, figures, pairs = token_align.align(both, parts)
    alone = [token_align.align(both, [p]) for p in parts]
    assert shown == [x for s, _, _ in alone for x in s]
    assert figures.tolist() == [x for _, f, _ in alone for x in f.tolist()]
    assert pairs.tolist() == [x for _, _, p in alone for x in p.tolist()]
    for part, told, figure in zip(parts, shown, figures.tolist(), strict=True):
        want = brute([part[1:]], both)[0]
        assert (*figure[:4], sha256(told[:-1].encode()).hexdigest() if told else "") == (*want[:4], want[6])
    assert figures[:, 4].sum() == len(parts) - 4
    # tokens of the right length with other bytes
    tokens, whole = [b"a", b"bc", b"cd"], [b"abc", b"acd", b"a", b"abc", b"cda", b"aa"]
    ids, n = np.array([0, 1, 0, 1, 0, 0, 2, 2, 0]), np.array([2, 2, 1, 2, 2, 0])
    right = token_align.spelt(ids, n, tokens, np.array([1, 2, 2]), whole, np.array([len(w) for w in whole]))
    assert right.tolist() == [True, False, True, False, True, False]


def test_repeated_rows_ids_and_empty_tables(spark, both):
    rows = [(1, "one two two"), (1, "one two two"), (None, "two three"), (None, "two three"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute([t for _, t in rows], both)
    got = sorted(((r["doc_id"], r["n_links"], r["n_best"], r["count_sum"]) for r in alignments(df).collect()), key=str)
    assert got == sorted(((i, w[3], w[4], w[5]) for (i, _), w in zip(rows, want, strict=True)), key=str)
    assert alignments(df.limit(0)).count() == 0


def test_full_tables_start_anew(spark, both, monkeypatch):
    monkeypatch.setattr(token_align, "CACHE_CHUNKS", 50)
    monkeypatch.setattr(token_align, "PAIR_BATCH", 40)
    t = token_align.Table(both)
    t.add(["a", "b", "a"])
    assert len(t.shown) == 2
    texts = [" ".join(f"w{i * 7 + k}" for k in range(40)) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows_of(alignments(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == dict(enumerate(brute(texts, both)))


def test_query_against_brute_force(spark, sf_dir, both):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(token_align.query(spark, sf_dir)) == {i: w for (i, _), w in zip(texts, brute([t for _, t in texts], both), strict=True)}
