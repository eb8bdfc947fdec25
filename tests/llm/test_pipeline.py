"""The corpus pipeline: stages keep the columns, drop what they should and nothing else."""

import itertools

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm import decontam, mixing, toxicity


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert first.columns == docs.columns
    out = corpus_pipeline.run(spark, sf_dir)
    assert 0 < out.count() <= docs.count()
    assert out.select("doc_id").distinct().count() == out.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "mixing"]


def _words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10 ** 6, n)]


def _lines(rng, n, words=12):
    return [" ".join(_words(rng, words)) for _ in range(n)]


def _one_of_each(texts):
    """Brute force: the first id of every class of texts whose five-word runs have a Jaccard similarity of 0.8 or more."""
    runs = {i: {tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} for i, t in texts.items() if (ws := t.split())}
    label = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(runs), 2):
        if len(runs[a] & runs[b]) >= 0.8 * len(runs[a] | runs[b]):
            lo, hi = sorted((label[a], label[b]))
            label = {i: lo if x == hi else x for i, x in label.items()}
    return {i: texts[i] for i in texts if label[i] == i}


def _without_passages(texts):
    """Brute force: two neighbouring lines, and lines of 50 words, that an earlier place holds go, unless the document is a copy."""
    first, out = {}, {}
    for i in sorted(texts):
        lines, gone, by = texts[i].split("\n"), set(), {}
        for k, line in enumerate(lines):
            for unit in ([tuple(lines[k:k + 2])] if k + 1 < len(lines) else []) + ([(line,)] if len(line.split()) >= 50 else []):
                if unit in first:
                    gone |= set(range(k, k + len(unit)))
                    by.setdefault(first[unit], set()).update(range(k, k + len(unit)))
                first.setdefault(unit, i)
        common = {j: sum(len(lines[k]) for k in ks) for j, ks in by.items() if j != i}
        copy = any(n >= 0.5 * (len(texts[i]) + len(texts[j]) - n) for j, n in common.items())
        left = texts[i] if copy else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if left.strip():
            out[i] = left
    return out


def test_run_equals_brute_force(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    texts = {i: _lines(rng, int(rng.integers(3, 12))) for i in range(40)}
    item = _words(rng, 30)
    for k, i in enumerate(range(0, 10)):  # exact copies, near copies with one word in another line changed
        texts[100 + i] = list(texts[i])
        texts[200 + i] = [*texts[i], *_lines(rng, 6)]
        texts[i] = texts[100 + i] = texts[200 + i]
        texts[200 + i] = [x if n != k % len(texts[i]) else x + " changed" for n, x in enumerate(texts[i])]
    for i in range(10, 26):  # passages of 2 to 5 lines between other lines
        passage = texts[i - 10][1:3 + i % 4]
        texts[i] = texts[i][:2] + passage + texts[i][2:]
    texts[26][1] += " " + " ".join(item[4:20])
    texts[27][0] += " insult"
    texts[300], texts[301] = [" ".join(_words(rng, 60))], _lines(rng, 2)
    texts[302] = [*_lines(rng, 3), texts[300][0], *_lines(rng, 2)]
    texts = {i: "\n".join(x) for i, x in texts.items()}
    source = {i: "abc"[i % 3] for i in texts}
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, "en", source[i], len(t)) for i, t in texts.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    place = spark.sql("SELECT 'insult' AS t").select(toxicity.terms(F.col("t")).alias("t")).first()["t"]
    machine = toxicity.Machine(-5.0, np.sort(place).astype(np.int64), np.full(len(place), 10.0), np.zeros((len(place), 1)))
    monkeypatch.setattr(toxicity, "train", lambda *_: machine)  # scores given
    got = corpus_pipeline.run(spark, sf)

    want = _without_passages({i: t for i, t in texts.items() if "insult" not in t.split()})
    assert all(want[i] == texts[i] for i in range(100, 110)) and any(want[i] != texts[i] for i in range(10, 26))
    want = _one_of_each(want)
    assert not any(i in want for i in range(100, 300))  # one survivor of every group
    windows = {tuple(item[k:k + decontam.SPAN]) for k in range(len(item) - decontam.SPAN + 1)}
    want = {i: t for i, t in want.items() if not windows & {tuple(t.split()[k:k + decontam.SPAN]) for k in range(len(t.split()))}}
    assert 26 not in want and 27 not in want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, source[i]) for i, t in want.items()])
    rows = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall()
    assert sorted(map(tuple, got.select("doc_id", "size", "source_size", "target", "taken").collect())) == sorted(rows)


def test_edge_rows_and_names(spark, tmp_path, monkeypatch):
    """Nulls in every column, empty and repeated rows, empty tables, columns whose names clash with those used inside."""
    sf = str(tmp_path)
    long = "\n".join(" ".join(f"t{i * 7 + k}" for k in range(9)) for i in range(2_000))
    rows = [(1, "a b\nc d", "en", "s", 7), (1, "a b\nc d", "en", "s", 7), (2, None, None, None, None), (None, "x y z", None, None, None), (None, None, None, None, None),
            (3, "", "en", "s", 0), (4, "\n\n", "en", "s", 2), (5, long, "en", "t", len(long)), (6, long, "en", "t", len(long))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "q r s"), (None, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    monkeypatch.setattr(toxicity, "train", lambda *_: toxicity.Machine(-5.0, np.empty(0, np.int64), np.empty(0), np.empty((0, 1))))
    for name, docs in (("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("documents", df)):
        docs.write.parquet(f"{sf}/{name}.parquet")
    clash = ["row", "gone", "digest", "id", "hash", "rows", "of", "N_LINES", "_text_digest", "_gone"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[1:3]):
        docs = df.select("*", *[F.lit(c).alias(c) for c in clash])
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[c] == c for r in got for c in clash)
        assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in got) == sorted((i or 0, len(t or "")) for i, t, *_ in (
            rows if k == 0 else [rows[0], *rows[2:8]])), name
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.run(spark, sf).count() == 7
