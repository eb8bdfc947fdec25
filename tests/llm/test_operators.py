"""The operators on edge rows, round trips and brute force."""

import io
import os
import struct

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from panelcast.llm import decontam, html_extract, line_dedup, mixing, queries, token_counts, topk_search, toxicity, url_filters, warc
from panelcast.llm.common import scratch

LONG = " ".join(f"t{i}" for i in range(20_000))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want, got = con.execute(queries.ORACLES[name]).df(), queries.QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).values.tolist()), key=str)
    assert rows(got) == rows(want)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit("clash")).withColumn("score", F.lit("clash"))


def test_line_dedup(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"own line\n{passage}\nmore"), (2, f"{passage}\nother words here"), (3, None), (4, ""), (5, "\n\n"), (5, "\n\n"),
            (None, "alone"), (6, LONG), (6, LONG)]
    out = {(r["doc_id"], r["text"]): r["n_removed"] for r in line_dedup.dedup(docs(spark, rows)).collect()}
    assert out[(2, "other words here")] == 1 and out[(1, rows[0][1])] == 0
    assert out[(3, None)] == out[(4, "")] == out[(5, "\n\n")] == out[(None, "alone")] == out[(6, LONG)] == 0
    assert line_dedup.dedup(docs(spark, rows).limit(0)).count() == 0
    # the stage: a copy of one document stays for near-dedup, a document that is a small part of another leaves
    other = " ".join(f"z{i}" for i in range(55))
    more = [*rows, (7, f"{LONG} end\n{other}"), (8, passage), (9, other)]
    out = line_dedup.stage(spark, docs(spark, more).withColumn("n_chars", F.lit(1)), "")
    assert {r["doc_id"] for r in out.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, None}


def test_line_dedup_passages_of_few_lines(spark):
    rng = np.random.default_rng(4)
    line = lambda n: " ".join(f"x{i}" for i in rng.integers(0, 10 ** 6, n))
    rows, want = [], {}
    for i in range(60):  # passages of 2, 3 and 4 lines and over 50 words between different neighbours
        passage, mine = [line(27) for _ in range(2 + i % 3)], [line(20) for _ in range(1 + i % 4)]
        rows += [(i, "\n".join([line(9), *passage, line(9)])), (100 + i, "\n".join([*mine, *passage, line(3)]))]
        want[100 + i] = len(passage)
        want[i] = 0
    rows += [(300, "a 1\na 2\n\na 3"), (301, "b\na 2\n\na 3\nc"), (302, "b\nc"), (303, "a 1\na 2\n\na 3"), (304, None), (305, "")]
    out = {r["doc_id"]: r for r in line_dedup.dedup(docs(spark, rows)).collect()}
    assert {i: out[i]["n_removed"] for i in want} == want
    assert [(out[i]["text"], out[i]["n_lines"]) for i in range(300, 306)] == [
        ("a 1\na 2\n\na 3", 4), ("b\nc", 5), ("b\nc", 2), ("", 4), (None, 0), ("", 0)]


def test_line_dedup_does_not_depend_on_the_cuts(spark, monkeypatch):
    """Whatever cuts the chunks: the same lines go as by the stated rule, worked out by hand."""
    rng = np.random.default_rng(8)
    few = [[" ".join(rng.choice(list("abc"), rng.integers(0, 3))) for _ in range(rng.integers(0, 9))] for _ in range(120)]
    few += [[" ".join(f"w{j}" for j in range(k, k + 50)) if k < 4 else str(k) for k in rng.integers(0, 8, 5)] for _ in range(20)]
    few = [(i, "\n".join(ls)) for i, ls in enumerate(few)]
    seen, want = set(), {}
    for i, text in few:
        ls = text.split("\n") if text else []
        at = [k for k, line in enumerate(ls) if line.split()]
        runs = [*zip(at, at[1:]), *((k, k) for k in at if len(ls[k].split()) >= 50)]
        lost = set()
        for first, last in sorted(runs):
            body = "\n".join(ls[first:last + 1])
            lost |= set(range(first, last + 1)) if body in seen else set()
            seen.add(body)
        want[i] = ("\n".join(line for k, line in enumerate(ls) if k not in lost), len(ls), len(lost))
    for divisor in (1, 4, 1000):
        out = line_dedup.dedup(docs(spark, few), divisor=divisor).collect()
        assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out} == want
    monkeypatch.setattr(line_dedup, "HASHES", 0)  # as beyond the broadcast
    twice = docs(spark, [*few, *few[:50], (None, None), (None, "")])
    out = line_dedup.dedup(twice).collect()
    assert len(out) == len(few) + 52
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out if r["doc_id"] is not None} == want
    # names of any case beside the operator's own
    named = docs(spark, few).selectExpr("*", "1 AS N_LINES", "2 AS _gone", "3 AS gone", "4 AS _text_digest", "5 AS `row`")
    out = line_dedup.dedup(named)
    assert out.columns == ["doc_id", "text", "n_hit", "score", "_gone", "gone", "_text_digest", "row", "n_lines", "n_removed"]
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {i: w[2] for i, w in want.items()}


def test_decontamination(spark):
    span = "a b c d e f g h i j k"
    items = spark.createDataFrame([(1, span), (2, "x y"), (3, None), (None, "a b c d e f g h i j")], "item_id long, text string")
    rows = [(1, "q A b, C d e f g h i J r"), (2, "X-y x y"), (3, None), (4, ""), (5, "a b c d e f g h i"), (None, span), (None, span), (7, LONG)]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in decontam.decontaminate(docs(spark, rows), items).collect()), key=str)
    assert got == sorted([(1, 12, 10, 2), (2, 4, 4, 1), (3, 0, 0, 0), (4, 0, 0, 0), (5, 9, 0, 0), (None, 11, 11, 2), (None, 11, 11, 2), (7, 20_000, 0, 0)], key=str)
    assert decontam.decontaminate(docs(spark, rows), items.limit(0)).where("contaminated").count() == 0
    assert decontam.decontaminate(docs(spark, rows).limit(0), items).count() == 0


def test_clashing_names(spark, sf_dir):
    """Columns named like the operators' own, in any case, crash nothing; the stages hand them on."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    named = table.selectExpr("*", "1 AS _text_digest", "2 AS _n_hit", "3 AS _items", "4 AS N_HIT", "5 AS Score", "6 AS _id", "7 AS _c0",
                             "8 AS own", "9 AS _doc", "10 AS `a.b`")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = {r["doc_id"]: r["n_hit"] for r in decontam.decontaminate(table, items).collect()}
    out = decontam.decontaminate(named, items)
    assert [c for c in out.columns if c.lower() == "n_hit"] == ["n_hit"] and "a.b" in out.columns
    assert {r["doc_id"]: r["n_hit"] for r in out.collect()} == plain and any(plain.values())
    left = decontam.stage(spark, named.drop("a.b"), sf_dir)
    assert left.columns == named.drop("a.b").columns
    assert {(r["doc_id"], r["N_HIT"], r["own"]) for r in left.collect()} == {(i, 4, 8) for i, n in plain.items() if n == 0}
    left = toxicity.stage(spark, named.drop("a.b"), sf_dir)
    assert left.columns == named.drop("a.b").columns and {r["Score"] for r in left.collect()} == {5}


def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(300)] + [(None, None, None), (7, "", "a"), (8, "x y", None), (8, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(df, bucket_rows=20).collect()
    assert len(got) == len(rows) and sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    for s in "abc":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 7
    assert sorted(map(tuple, mixing.mix(df, bucket_rows=50).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(df.limit(0)).count() == 0


def test_url_filters(spark):
    e = spark.createDataFrame([("l", "block", "bad.com", "add", 100), ("l", "block", "bad.com", "remove", 200), ("l", "block", "bad.com", "add", 300),
                               ("w", "allow", "ok.bad.com/a", "add", 0), (None, "block", "x.org", "add", 0)],
                              "list string, kind string, pattern string, action string, at long")
    rows = [(1, "http://u@BAD.com:80/x", 150), (2, "https://sub.bad.com/", 200), (3, "http://sub.bad.com/", 10 ** 9), (4, "http://ok.bad.com/a/b?q", 350),
            (5, "http://ok.bad.com/ab", 350), (6, None, 350), (7, "nonsense", 350), (8, "http://bad.com", None), (None, "http://notbad.com/", 350), (1, "http://u@BAD.com:80/x", 150)]
    c = spark.createDataFrame(rows, "page_id long, url string, fetched long").withColumn("pattern", F.lit("clash"))
    got = sorted((r["page_id"] or 0, r["blocked"]) for r in url_filters.evaluate(c, e).collect())
    assert got == [(0, False), (1, True), (1, True), (2, False), (3, True), (4, False), (5, True), (6, False), (7, False), (8, False)]
    assert url_filters.evaluate(c, e.limit(0)).where("blocked").count() == 0 and url_filters.evaluate(c.limit(0), e).count() == 0


def test_token_counts_equal_the_library(spark, sf_dir):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.tokenizer_path())
    odd = [None, "", " ", "  a  b ", "▁x ▁", "<s></s><unk>", "é①🙂한\x00", "a" * 4000, " " * 300, "ab" * 3000, LONG, LONG]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    texts = sorted((r["doc_id"], len(sp.encode(r["text"] or ""))) for r in df.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(df.withColumn("n_tokens", F.lit("clash"))).collect()) == texts


def test_warc_round_trip(spark, sf_dir):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/", ""), (5, "u\r\nx: y", "é <b>"), (5, "u\r\nx: y", "é <b>"), (6, "l", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    path = scratch(spark, "test-warc")
    warc.write(pages, path, archive_bytes=50_000)
    got = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"]) for r in warc.read(spark, path).collect())
    p = lambda i: f"<urn:page:{i}>"
    assert [g[:4] for g in got] == [(p(1), "response", None, 4), (p(2), "revisit", p(1), 4), (p(3), "response", None, 0), (p(4), "revisit", p(3), 0),
                                    (p(5), "response", None, 6), (p(5), "response", None, 6), (p(6), "response", None, len(LONG))]
    assert bytes(got[-1][4]).decode() == LONG
    whole = {r["page_id"]: r for r in warc.query(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        data = (r["html"] or "").encode()
        assert (whole[r["page_id"]]["payload_bytes"], whole[r["page_id"]]["payload_digest"]) == (len(data), warc.sha1_base32(data))
    empty = scratch(spark, "test-warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_warc_reader_loads_the_dictionary_and_refuses_broken_archives():
    raw = warc.record(1, "http://a/", b"payload " * 50)
    trained = zstandard.train_dictionary(2048, [warc.record(i, "http://a/", os.urandom(40).hex().encode() * 9) for i in range(60)])
    frame = zstandard.ZstdCompressor(dict_data=trained).compress(raw)
    lead = struct.pack("<II", warc.DICT_MAGIC, len(trained.as_bytes())) + trained.as_bytes()
    assert list(warc.read_frames(io.BytesIO(lead + warc.SEPARATOR + frame + frame), step=100)) == [raw, raw]
    for broken in (frame, lead + frame[:-5], lead + b"junk!", lead + frame + lead):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(io.BytesIO(broken)))
    for broken in (raw[:-4], raw.replace(b"payload payload", b"payload Payload", 1), raw.replace(b"WARC/1.1", b"WARC/9"), raw + b"x"):
        with pytest.raises(warc.WarcError):
            warc.parse_record(broken)


def test_html_text(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy this now</div>
      <article><h1>A &amp;  B</h1><p>First <b>bold</b><br>line.<p>S.</p><aside>Also read</aside></article>
      <section class="comments"><p>I disagree with all of this text, which is long enough to be read as prose by a tree.</p></section>
      <script>var t="</p>";</script><form><p>Sign up</p></form><footer>&copy; us</footer></body></html>"""
    tree = html_extract.train()
    assert html_extract.main_text(page, tree) == "A & B\n\nFirst bold line.\n\nS."
    assert all(html_extract.classify(tree, r[:-1]) == r[-1] for r in html_extract.LABELLED)
    rng = np.random.default_rng(0)
    for w, a, b in rng.integers(0, 120, (500, 3)):  # inside an article, text without links stays; inside a menu, none does
        near = (a, float(rng.random()), b, float(rng.random()))
        assert html_extract.classify(tree, (1, w, 0.0, *near)) == 1 and html_extract.classify(tree, (-1, w, 0.0, *near)) == 0
    rows = [(1, page), (2, None), (3, ""), (4, "<nav>x"), (5, "<article><p>" + LONG), (5, "<article><p>" + LONG), (None, "<p <p><<>")]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("u")).withColumn("text", F.lit("clash"))).collect()
    assert len(out) == len(rows)
    assert {r["page_id"]: r["text"] for r in out if r["page_id"] in (2, 3, 4, 5)} == {2: "", 3: "", 4: "", 5: LONG}


@pytest.mark.parametrize("wrapper", ["layout has-sidebar", "no-comments", "header-fixed", "with-ads", "page sidebar"])
def test_html_article_in_a_hinted_wrapper(wrapper):
    tree = html_extract.train()
    page = f'<div class="{wrapper}"><p>Buy this</p><article><p>Own text.</p><aside>Also</aside></article><nav><a href="/">Home</a></nav></div>'
    assert html_extract.main_text(page, tree) == "Own text."
    assert html_extract.main_text(f'<div class="{wrapper}"><main class="{wrapper}"><p>Own text.</p></main></div>', tree) == "Own text."
    around = '<article><p>Own text.</p></article><div class="comments"><article class="comment-body"><p>Mine.</p></article><article>Yours.</article></div>'
    assert html_extract.main_text(around, tree) == "Own text."


def test_html_links_of_an_article():
    tree = html_extract.train()
    link = lambda t: f'<a href="/x">{t}</a>'
    items = lambda ts: "<ul>" + "".join(f"<li>{link(t)}</li>" for t in ts) + "</ul>"
    text = "Some prose that is long enough to be a paragraph of this article."
    kept = ["Smith 2010", "Jones on rivers", "Roe and Doe, lakes of the north"]
    page = f"<article><h1>{link('On rivers')}</h1><p>{link('Jane Roe')}</p><p>{text}</p><h2>References</h2>{items(kept)}</article>"
    assert html_extract.main_text(page, tree).split("\n\n") == ["On rivers", "Jane Roe", text, "References", *kept]
    assert html_extract.main_text(f"<article><p>{text}</p>{items(['Home', 'About us', 'Contact'])}</article>", tree) == text
    assert "lakes" not in html_extract.main_text(f"<article><p>{text}</p><h2>Related</h2>{items(kept)}</article>", tree)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8)) * 0.3
    x[100:300] = x[100]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200, x[200].tolist()), (700, None), (800, [float("nan")] * 8), (None, x[0].tolist()), (900, [1.0, None]), (1000, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash"))
    ok = {i: np.floor(1024 * np.pad(np.array(v), (0, 8 - len(v)))).astype(int) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = set()
    for q in (i for i in ok if i % 100 == 0):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:10]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    assert {tuple(r) for r in topk_search.top_k(df, n_pivots=4, n_rings=4, block_rows=50, query_rows=3).collect()} == want
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_toxicity_learns_pairs_and_keeps_labels_out(spark, sf_dir):
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(1500):  # only both terms together are toxic
        a, b = rng.random(2) < 0.5
        rows.append(np.unique(np.concatenate([rng.integers(100, 400, 12), [1] * int(a), [2] * int(b)])).astype(np.int64))
        y.append(float(a and b))
    m = toxicity.fit(rows[:1200], np.array(y[:1200]), np.ones(1200), epochs=20)
    s = m.scores(np.concatenate(rows[1200:]), np.array([len(r) for r in rows[1200:]]))
    assert ((s >= 0.5) == np.array(y[1200:])).mean() > 0.97
    empty = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0))
    df = docs(spark, [(1, None), (2, ""), (None, "words"), (3, LONG), (3, LONG)])
    out = toxicity.score(df, empty).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in out)
    assert toxicity.score(df.limit(0), empty).count() == 0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.query(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("toxic", "predicted").toPandas()
    assert (out["toxic"] == out["predicted"]).mean() > 0.95 and out["predicted"][out["toxic"] == 0].mean() < 0.02
