"""Line deduplication by content-defined chunks of lines.

Lines are hashed; a rolling hash over the last two line hashes chooses the chunk boundaries, so that
an inserted line moves only the boundaries next to it.  A line of ``long_words`` words or more is a
chunk of its own.  Chunks of two lines or more, and long lines, that occur more than once anywhere
are removed except where they occur first (smallest doc_id, then smallest place).  Hashes only
propose repeats; the bytes decide.

No cuts that depend on content can set a passage of two lines apart from any neighbours, so the chunks are
extended: outside the chunks that go, every two neighbouring lines are held against all others the same
way.  Thus what goes does not depend on the cuts: every run of two lines or more with a word each, and
every long line, that stands in an earlier place, and nothing else.

The stage of the pipeline leaves copies of one earlier document whole: near-dedup, the next stage, takes them, and scraps
of them would no longer resemble their original.

Everything is built-in expressions: the chunks travel as 8-byte hashes until they are known to
repeat, and the texts of repeated chunks are pre-aggregated before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import TOKEN, head, join_same, let, materialize, passing, small

DIVISOR, LONG_WORDS, COPY = 4, 50, 0.5
#: Hashes of 8 bytes are broadcast up to this number (counted), joined by shuffle above.
HASHES = 1_000_000


def _long(line: Column, long_words: int) -> Column:
    """Whether a line holds so many words; read no further than that many."""
    gap = TOKEN.replace("[^", "[")
    return (F.length(line) >= 2 * long_words - 1) & line.rlike(
        f"^{gap[:-1]}*+(?:{TOKEN}+{gap}+){{{long_words - 1}}}{TOKEN[:-1]}")


def pieces(text: Column, divisor: int = DIVISOR, long_words: int = LONG_WORDS) -> Column:
    """Array of (chunk, first, last, body) of one text; null and empty texts have none.  First the chunks that hold two lines
    with a word or are a long line, from their first to their last line with a word; then (chunk false) every line
    with a word and the next such line, with the lines between them."""
    lines = F.split(F.when(text != "", text), "\n", -1)

    def piece(ls, chunk, first, last):
        return F.struct(F.lit(chunk).alias("chunk"), first.alias("first"), last.alias("last"),
                        F.array_join(F.slice(ls, first + 1, last - first + 1), "\n").alias("body"))

    def chunks(ls, big, h, worded):
        ends = F.filter(F.sequence(F.lit(0), F.size(h) - 1),
                        lambda i: (i == F.size(h) - 1) | F.get(big, i) | F.get(big, i + 1)
                        | ((F.coalesce(F.get(h, i - 1), F.lit(0).cast("bigint")) * 31 + F.get(h, i)) % divisor == 0))
        at = let(ends, lambda e: F.transform(e, lambda last, j: F.filter(
            F.sequence(F.coalesce(F.get(e, j - 1), F.lit(-1)) + 1, last), lambda i: F.get(worded, i))))
        fit = F.filter(at, lambda a: (F.size(a) >= 2) | F.coalesce(F.get(big, F.get(a, F.lit(0))), F.lit(False)))
        return F.transform(fit, lambda a: piece(ls, True, F.get(a, F.lit(0)), F.get(a, F.size(a) - 1)))

    def neighbours(ls, worded):
        at = F.filter(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: F.get(worded, i))
        return let(at, lambda a: F.transform(head(a, 1), lambda first, k: piece(ls, False, first, F.get(a, k + 1))))

    return let(lines, lambda ls: let(F.transform(ls, lambda x: _long(x, long_words)), lambda big: let(
        F.transform(ls, lambda x: F.pmod(F.xxhash64(x), F.lit(1 << 32))), lambda h: let(
            F.transform(ls, lambda x: x.rlike(TOKEN)), lambda worded: F.concat(chunks(ls, big, h, worded), neighbours(ls, worded))))))


def _not_first(rows: DataFrame) -> DataFrame:
    """The ``rows`` whose body stands in an earlier place."""
    place = F.struct("_id", "_digest", "no")
    # the first place of every body; equal hashes of other bytes stay apart
    first = materialize(rows.groupBy("h", "body").agg(F.min(place).alias("first")))
    return materialize(rows.join(first, ["h", "body"]).where(place != F.col("first")))


def repeats(docs: DataFrame, divisor: int, long_words: int) -> DataFrame:
    """(_id, _digest, no, last, body, first, ...) of the chunks that stand in an earlier place, ``first``, and of the
    neighbouring lines that do, but for those inside such chunks."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.md5("text").alias("_digest"),
                       F.explode(pieces(F.col("text"), divisor, long_words)).alias("c"))
    rows = rows.select("_id", "_digest", "c.chunk", F.col("c.first").alias("no"), "c.last", "c.body",
                       F.xxhash64("c.chunk", "c.body").alias("h"))
    # hashes only propose; a body alone is left out and never shuffled
    repeated = materialize(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    if repeated.limit(HASHES + 1).count() <= HASHES:
        again = rows.join(F.broadcast(repeated), "h")
    else:  # the places travel without their texts; the texts are cut where places of theirs were proposed
        wanted = materialize(rows.drop("body").join(repeated, "h").groupBy("_id", "_digest").agg(
            F.collect_set(F.struct("chunk", "no", "last", "h")).alias("wanted")))
        texts = docs.select("doc_id", F.md5("text").alias("digest"), "text").dropDuplicates(["doc_id", "digest"])
        again = (join_same(wanted, texts, {"_id": "doc_id", "_digest": "digest"})
                 .select("_id", "_digest", F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w"))
                 .select("w.h", "_id", "_digest", "w.chunk", "w.no", "w.last",
                         F.array_join(F.slice("lines", F.col("w.no") + 1, F.col("w.last") - F.col("w.no") + 1), "\n").alias("body")))
    again = materialize(again)
    known = _not_first(again.where("chunk"))
    # what a chunk holds that goes stands in the first place of the chunk too, so the first places stay the same
    held = small(materialize(known.where("last > no").select(
        F.col("_id").alias("of"), F.col("_digest").alias("of_digest"), F.explode(F.sequence("no", F.col("last") - 1)).alias("at"),
        F.col("last").alias("to"))))
    rest = again.where("NOT chunk").join(held, F.col("_id").eqNullSafe(F.col("of")) & (F.col("_digest") == F.col("of_digest"))
                                         & (F.col("no") == F.col("at")) & (F.col("last") <= F.col("to")), "left_anti")
    return known.unionByName(_not_first(rest))


def _length(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)).cast("bigint")


def copies(docs: DataFrame, passages: DataFrame, share: float) -> DataFrame:
    """(_id, _digest) of documents whose lines in ``passages`` (_id, _digest, no, body, first) with first place in one other document
    have at least ``share`` of the characters that the two hold together (common lines once)."""
    lines = passages.select("_id", "_digest", F.col("first._id").alias("of"), F.col("first._digest").alias("of_digest"), "no",
                            F.posexplode(F.split("body", "\n", -1)).alias("k", "line"))
    lines = lines.where("NOT (_id <=> of AND _digest <=> of_digest)").groupBy(
        "_id", "_digest", "of", "of_digest", (F.col("no") + F.col("k")).alias("at")).agg(F.max(F.length("line")).alias("n"))
    both = lines.groupBy("_id", "_digest", "of", "of_digest").agg(F.sum("n").alias("common"))
    size = docs.select("doc_id", F.md5("text").alias("digest"), _length(F.col("text")).alias("size")).distinct()
    for to in ({"_id": "doc_id", "_digest": "digest"}, {"of": "doc_id", "of_digest": "digest"}):
        name = "own" if "_id" in to else "other"
        # documents with a passage only: the first is bounded by a count
        both = join_same(both, size.withColumnRenamed("size", name), to)
    return both.where(F.col("common") >= share * (F.col("own") + F.col("other") - F.col("common"))).select("_id", "_digest").distinct()


def dedup(docs: DataFrame, divisor: int = DIVISOR, long_words: int = LONG_WORDS, copy: float | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) without the lines of ``text`` that stand in an earlier place as a line of
    ``long_words`` words or in a run of two lines or more with a word each (the lines without a word between them go along), by bytes,
    and with columns ``n_lines`` and ``n_removed`` (lines), which replace columns of those names in any case of letters.

    One row per input row; other columns keep any name.  Null text stays null, empty text stays empty (0 lines), an empty
    table gives no rows, and texts of any length are read whole.  Rows with equal doc_id and text count as one document: they
    come out alike, and their lines do not repeat each other.  The first place of several is that of the smallest doc_id, null before all
    others, then the smallest line.  A single line under ``long_words`` words that repeats alone stays, and so do lines without a word.

    Documents that are copies of one earlier document to the share ``copy`` (of the characters of both, by common lines)
    stay whole if it is given."""
    with passing() as keep:
        passages = repeats(docs, divisor, long_words)
        gone = passages.select("_id", "_digest", F.explode(F.sequence("no", "last")).alias("no")).groupBy("_id", "_digest").agg(
            F.collect_set("no").alias("gone"))
        if copy is not None:
            whole = small(materialize(copies(docs, passages, copy).withColumnsRenamed({"_id": "of", "_digest": "of_digest"})))
            gone = gone.join(whole, gone["_id"].eqNullSafe(whole["of"]) & gone["_digest"].eqNullSafe(whole["of_digest"]), "left_anti")
        gone = keep(materialize(gone))
    # names inside a struct clash with none
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    d = docs.select(F.struct(*names).alias("row"), "doc_id", F.md5("text").alias("digest"))
    out = join_same(d, small(gone), {"doc_id": "_id", "digest": "_digest"}, "left").select("row", "gone")
    text = F.col("row.text")
    lines = F.split(F.when(text != "", text), "\n", -1)
    left = let(lines, lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "gone"), lambda i: F.get(ls, i)), "\n"))
    return out.select(
        *[F.when(F.col("gone").isNotNull(), left).otherwise(text).alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in names],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).cast("bigint").alias("n_removed"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without their repeated chunks and passages; copies of one earlier document stay whole for the next
    stage.  Documents of which nothing is left leave, as all they held stands in an earlier document; texts that were empty before stay.
    Edge rows as in ``dedup``; columns of any name are kept."""
    out = dedup(docs.select("*", F.struct(*docs.columns).alias("_own_columns")), copy=COPY)
    row = out.where((F.col("n_removed") == 0) | F.col("text").rlike(TOKEN))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("_own_columns.n_chars"))}
    return row.select(*[new.get(c.lower(), F.col("_own_columns")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs.select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_removed")


# By what goes, not by the cuts.
SQL = f"""
WITH texts AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''
), lines AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS no, unnest(ls) AS line FROM texts
), worded AS (
  SELECT doc_id, no, line, lead(no) OVER (PARTITION BY doc_id ORDER BY no) AS next
  FROM lines WHERE regexp_matches(line, '{TOKEN}')
), passages AS (
  SELECT doc_id, no AS first, next AS last, array_to_string(ls[no:next], chr(10)) AS body
  FROM worded JOIN texts USING (doc_id) WHERE next IS NOT NULL
  UNION ALL
  SELECT doc_id, no, no, line FROM worded WHERE len(regexp_extract_all(line, '{TOKEN}')) >= {LONG_WORDS}
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) > 1 AS gone FROM passages
), lost AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS no FROM judged WHERE gone
), rebuilt AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (lost.no IS NULL), '') AS text,
         count(*) AS n_lines, count(lost.no) AS n_removed
  FROM lines LEFT JOIN lost USING (doc_id, no) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.text, d.text) AS text, coalesce(r.n_lines, 0) AS n_lines,
       coalesce(r.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
"""
