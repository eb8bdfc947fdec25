"""Mixing sources to target weights by weighted fair queueing.

Every source gets a share of the budget (all words) in proportion to its weight, at most ``epochs``
times its own size; what it can't take goes to the others by weight.  Documents are shuffled by a hash
of their id, whole passes of a source follow each other, and each copy gets a virtual finish time: the
words of its source up to its end, divided by the source's target.  Copies that start before time 1
(the time at which a source meets its target) queue; they are put in the global order of their finish
times and cut where the running number of words passes the budget.

No source and no stretch of time is handled as one group: running sums are taken inside buckets of
the hash (or of the time), whose number grows with the rows, and the sums before each bucket come
from a table with one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import TOKEN, hex_number, join_same, materialize, small

WEIGHTS, EPOCHS, SEED, BUCKET_ROWS, SPREAD = (5, 2, 1), 3, "mix", 1000, 2 ** 32


def sizes(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def targets(rows: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows: one aggregate over all rows, then
    rounds over the table of sources, each capping those above ``epochs`` times their size.

    Sources are ordered by code point, null last, and take the weights in turn.  That order and the
    rounds see one row per source, never the documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")
    by = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"))
                     .withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn)))
    total, seen, level = by.agg(F.sum("source_size")).first()[0] or 0, None, 0.0
    while True:
        over = F.lit(False) if seen is None else F.lit(level) * F.col("weight") > epochs * F.col("source_size")
        n, held, free = by.select(over.alias("over"), "source_size", "weight").agg(
            F.count_if("over"), F.sum(F.when(F.col("over"), F.col("source_size"))),
            F.sum(F.when(~F.col("over"), F.col("weight")))).first()
        if n == seen or not free:
            break
        seen, level = n, (total - epochs * (held or 0)) / free
    return by.withColumn("target", F.least(F.lit(float(level)) * F.col("weight"),
                                           (epochs * F.col("source_size")).cast("double")))


def running_sum(rows: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the earlier rows of the group.  ``bucket`` must not fall along ``order``."""
    by_bucket = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(rows.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
                       .withColumn("_offset", F.coalesce(F.sum("_sum").over(by_bucket), F.lit(0))).drop("_sum"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.withColumn("_in", F.sum(value).over(inside))
    return join_same(both, small(sums), [*group, bucket]).select(
        *rows.columns, (F.col("_offset") + F.col("_in") - F.col(value)).alias(out))


def schedule(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
             bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with size and words before them in their source, copies in the mix, targets).

    The copies carry ``vft`` and ``at``, the words of the mix before them: ordered by ``at`` they are
    the mix itself."""
    label = F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(seed))
    rows = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                                   sizes(F.col("text")).alias("size"), F.md5("text").alias("_digest"),
                                   hex_number(label).alias("_u")))
    goals = targets(rows, weights, epochs)
    n, budget = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = n // bucket_rows + 1
    order = ["_u", "doc_id", "_digest", "size"]
    placed = materialize(running_sum(rows.withColumn("_b", F.floor(F.col("_u") * n / SPREAD)),
                                     ["source"], "_b", order, "size", "before").drop("_b"))
    full = placed.where("size > 0")
    start, end = F.col("_pass") * F.col("source_size") + F.col("before"), F.col("size")
    copies = (join_same(full, small(goals), ["source"])
              .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
              .where(start < F.col("target"))
              .withColumn("vft", (start + end).cast("double") / F.col("target"))
              .withColumn("_r", F.floor(F.least(F.col("vft"), F.lit(1.0)) * n)))
    mixed = running_sum(copies, [], "_r", ["vft", F.col("source").asc_nulls_last(), *order, "_pass"], "size", "at")
    return placed, mixed.where(F.col("at") + F.col("size") <= budget), goals


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source; others
    are ignored).

    ``taken``: the words the mix takes from the row, 0 to ``epochs`` times its size.  Null and blank
    texts have size 0 and take nothing.  An empty table gives no rows.  Repeated rows are documents of
    their own.  Null doc_ids shuffle first.  Reruns agree."""
    placed, mixed, goals = schedule(docs, weights, epochs, seed, bucket_rows)
    # rows of one source with words in them differ in the words before them
    key = ["source", "before", "size"]
    taken = mixed.groupBy(*key).agg(F.sum("size").alias("taken"))
    return join_same(join_same(placed, taken, key, "left"), small(goals), ["source"]).select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: how many words the mix takes of every document."""
    return mix(docs)


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "source_size", "target", "taken")


def sql(table: str = "documents") -> str:
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS BIGINT) AS size,
         ('0x' || substr(md5(doc_id || '|{SEED}'), 1, 8))::BIGINT AS u
  FROM {table}
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{', '.join(map(str, map(float, WEIGHTS)))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1)
                                                       % {len(WEIGHTS)} + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), sorted AS (
  SELECT *, row_number() OVER w AS k, sum(source_size) OVER () AS total,
         sum(source_size) OVER w - source_size AS held, sum(weight) OVER () - sum(weight) OVER w + weight AS free
  FROM sources WINDOW w AS (ORDER BY source_size / weight, source ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT *, CAST(total - {EPOCHS} * held AS BIGINT)::DOUBLE / free AS level FROM sorted
), level AS (
  SELECT level FROM levels WHERE level * weight <= {EPOCHS} * source_size ORDER BY k LIMIT 1
), goals AS (
  SELECT source, source_size, least(level * weight, ({EPOCHS} * source_size)::DOUBLE) AS target FROM sources, level
), placed AS (
  SELECT s.*, source_size, target,
         sum(size) OVER (PARTITION BY s.source ORDER BY u, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), copies AS (
  SELECT *, CAST(pass * source_size + before + size AS BIGINT)::DOUBLE / target AS vft
  FROM placed, (SELECT unnest(range({EPOCHS})) AS pass) WHERE size > 0 AND pass * source_size + before < target
), cut AS (
  SELECT *, sum(size) OVER (ORDER BY vft, source NULLS LAST, u, doc_id, pass ROWS UNBOUNDED PRECEDING) AS reached
  FROM copies
), taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM cut
  WHERE reached <= (SELECT sum(size) FROM sized) GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (doc_id)
"""


SQL = sql()
