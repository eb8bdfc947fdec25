"""Benchmark decontamination by winnowing.

Texts are lower-cased words.  A window is ``span`` consecutive words of a benchmark item (a shorter item
is one window).  From the hashes of all k-word runs, every window keeps the smallest: any ``span`` words
that a document shares with an item keep the same one on both sides, so joining these fingerprints misses
no shared window.  A document's fingerprints join those of the benchmark; each hit is then extended to
the words around it and compared word by word with the item's windows.

The benchmark's tables are written first and broadcast only if their counted rows are few; beyond
that the same joins shuffle.  Documents travel as (key, fingerprint) until they have a hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import join_same, let, materialize, sliding_hash, sliding_min, small, words

SPAN, GRAM = 10, 5


def fingerprints(ws: Column, span: int, gram: int) -> Column:
    """For each place where a window of ``span`` words starts: the smallest hash of its runs of ``gram`` words."""
    return sliding_min(sliding_hash(F.transform(ws, lambda w: F.xxhash64(w)), gram), span - gram + 1)


def _window(ws: Column, start: Column, span) -> Column:
    return F.array_join(F.slice(ws, start + 1, span), " ")


def benchmark_windows(items: DataFrame, span: int, gram: int) -> DataFrame:
    """(span, fp, window, items): every distinct window with the ids of the items that hold it."""
    it = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws"))
    long = (it.where(F.size("ws") >= span)
            .select("item", "ws", F.posexplode(fingerprints(F.col("ws"), span, gram)).alias("at", "fp"))
            .select(F.lit(span).alias("span"), "fp", _window(F.col("ws"), F.col("at"), span).alias("window"), "item"))
    short = [it.where(F.size("ws") == n).select(
        F.lit(n).alias("span"), F.element_at(fingerprints(F.col("ws"), n, n), 1).alias("fp"),
        F.array_join("ws", " ").alias("window"), "item") for n in range(1, span)]
    rows = long
    for s in short:
        rows = rows.unionByName(s)
    return rows.groupBy("span", "fp", "window").agg(F.collect_set(F.coalesce("item", F.lit(""))).alias("items"))


def hits(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(_id, _digest, start, span, items): the verified windows of every distinct document (doc_id, text)."""
    known = materialize(benchmark_windows(items, span, gram))
    spans = [r[0] for r in known.select("span").distinct().collect()]  # at most ``span`` values
    d = docs.select(F.col("doc_id").alias("_id"), F.md5("text").alias("_digest"), words(F.col("text")).alias("ws"))
    runs = lambda n: fingerprints(F.col("ws"), n, gram if n == span else n)
    fps = small(known.select("span", "fp").distinct())
    seen = None
    for n in sorted(spans):
        one = (d.select("_id", "_digest", F.explode(F.array_distinct(runs(n))).alias("fp"))
               .join(fps.where(F.col("span") == n), "fp"))
        seen = one if seen is None else seen.unionByName(one)
    if seen is None:
        return None
    per_doc = seen.groupBy("_id", "_digest").agg(F.collect_set(F.struct("span", "fp")).alias("_fps"))
    # a hit needs the document's words again; only documents with hits go on
    found = join_same(d, per_doc, ["_id", "_digest"])
    out = None
    for n in sorted(spans):
        mine = F.transform(F.filter("_fps", lambda x: x["span"] == n), lambda x: x["fp"])
        at = let(mine, lambda m: let(runs(n), lambda f: F.filter(
            F.transform(f, lambda v, i: F.when(F.array_contains(m, v), F.struct(i.alias("start"), v.alias("fp")))),
            lambda x: x.isNotNull())))
        one = found.where(F.exists("_fps", lambda x: x["span"] == n)).select("_id", "_digest", "ws", at.alias("at"))
        one = one.select("_id", "_digest", F.explode(let(F.col("ws"), lambda ws: F.transform("at", lambda a: F.struct(
            a["start"].alias("start"), a["fp"].alias("fp"), _window(ws, a["start"], n).alias("window"))))).alias("a"))
        one = one.select("_id", "_digest", F.lit(n).alias("span"), "a.start", "a.fp", "a.window")
        out = one if out is None else out.unionByName(one)
    return out.join(small(known, 50_000), ["span", "fp", "window"]).select("_id", "_digest", "start", "span", "items")


def _covered(spans: Column) -> Column:
    """Number of words inside the union of (start, span), sorted by start."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    return F.aggregate(F.array_sort(spans), zero, lambda acc, s: let(
        (s["start"] + s["span"]).cast("bigint"), lambda end: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), end - F.greatest(acc["end"], s["start"].cast("bigint")))).alias("n"),
            F.greatest(acc["end"], end).alias("end"))), lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text, any others) with n_words, n_hit, n_items, items_sha256 and contaminated added
    (they replace columns of those names in any case of letters; other columns keep any name).

    One row per input row.  Null and wordless texts have no words and no hits; items without words
    match nothing; an item without an id counts under the empty id.  Rows with equal doc_id and text
    come out alike.  An empty benchmark or table is fine."""
    new = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    keep = [c for c in docs.columns if c.lower() not in new]
    # own names for all columns, so that none clashes
    base = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(keep)], F.col("doc_id").alias("_doc"),
                       F.md5("text").alias("_text_digest"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    found = hits(docs, items, span, gram)
    if found is None:
        n, ids = F.lit(0).cast("bigint"), F.array().cast("array<string>")
        out = base.withColumn("_n_hit", n).withColumn("_items", ids)
    else:
        per = found.groupBy("_id", "_digest").agg(
            _covered(F.collect_set(F.struct("start", "span"))).alias("_n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"))
        out = join_same(base, per, {"_doc": "_id", "_text_digest": "_digest"}, "left")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], "n_words", F.coalesce("_n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (F.coalesce("_n_hit", F.lit(0)) > 0).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that share no window with the benchmark, with columns of any name as they were.  Null, empty and
    wordless texts stay, copies stay or leave alike, texts of any length are read whole, an empty table gives no rows."""
    out = decontaminate(docs.select("doc_id", "text", F.struct(*docs.columns).alias("own")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where(~F.col("contaminated")).select("own.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents
), b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark
), known AS (
  SELECT DISTINCT item_id, least(len(ws), {SPAN}) AS span,
         array_to_string(ws[i:i + least(len(ws), {SPAN}) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {SPAN} + 1, least(len(ws), 1)) + 1)) AS i FROM b)
), spans AS (SELECT DISTINCT span FROM known
), wins AS (
  SELECT doc_id, i, span, array_to_string(ws[i:i + span - 1], ' ') AS win
  FROM (SELECT doc_id, ws, span, unnest(range(1, len(ws) - span + 2)) AS i FROM d, spans)
), hit AS (
  SELECT doc_id, i, wins.span, item_id FROM wins JOIN known ON wins.span = known.span AND wins.win = known.win
), n_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + span)) AS p FROM hit) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
