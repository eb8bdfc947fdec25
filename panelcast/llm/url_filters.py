"""URL filters as a temporal list join.

A list is a log of dated entries (list, kind, pattern, action, at).  Per list and pattern each entry
holds until the next one, so the log becomes validity intervals.  Every capture is evaluated against
the entries active when it was fetched: an equi-join on the pattern and on a slice of time finds the
intervals that overlap the slice, and ``starts <= fetched < ends`` picks the active one.

Only the distinct patterns that a capture could match travel (its host, the parent domains and the path
prefixes), and a hot host is a skewed equi-join, which Spark can split: no window holds all its captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import hex_number, join_same, materialize, small

DAY, SLICE_DAYS, FOREVER = 86_400, 30, 253_402_300_799
#: First second of 2023 and length in days of the query's period.
EPOCH0, PERIOD = 1_672_531_200, 730


def host(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; null where there is none."""
    h = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    h = F.regexp_replace(h, r"\.$", "")
    return F.when(h != "", h)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def keys(host_: Column, path_: Column) -> Column:
    """Every pattern that covers the address: the host and its parent domains, and the host with each
    leading run of whole path segments."""
    labels = F.split(host_, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path_, "/"), lambda p: p != "")
    prefixes = F.transform(F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i > 0),
                           lambda i: F.concat(host_, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))
    return F.array_distinct(F.concat(domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, starts, ends) from the log.  Of entries of one list and pattern at one time a
    removal wins; entries without list, kind, pattern or time are void."""
    e = entries.dropna(subset=["list", "kind", "pattern", "at"]).groupBy("list", "kind", "pattern", "at").agg(
        F.max(F.col("action") != "add").alias("gone"))
    w = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    return e.select("list", "kind", F.lower("pattern").alias("pattern"), F.col("at").alias("starts"),
                    F.coalesce(F.lead("at").over(w), F.lit(FOREVER)).alias("ends"), "gone").where("NOT gone").drop("gone")


def evaluate(captures: DataFrame, entries: DataFrame, slice_days: int = SLICE_DAYS) -> DataFrame:
    """One row per capture (page_id, url, fetched in epoch seconds; other columns are ignored): host, the
    number of active entries that cover it, their lists, the most specific pattern and the verdict.

    The most specific (longest) active pattern decides; where an allow and a block entry share it, the block wins.
    Captures without a host or a time match nothing and are not blocked.  Repeated captures come out
    alike; an empty log blocks nothing."""
    width = slice_days * DAY
    c = captures.select("page_id", "url", "fetched", host(F.col("url")).alias("host"))
    last = captures.agg(F.max("fetched")).first()[0]
    spans = intervals(entries)
    if last is not None:
        spans = spans.where(F.col("starts") <= last)
    spans = materialize(spans.select("*", F.explode(F.sequence(
        F.floor(F.col("starts") / width), F.floor(F.least(F.col("ends") - 1, F.lit(last or 0)) / width))).alias("slice"))
        .where(F.col("starts") < F.col("ends")))
    wanted = (c.where("host IS NOT NULL AND fetched IS NOT NULL").distinct()
              .select("page_id", "url", "fetched", F.floor(F.col("fetched") / width).alias("slice"),
                      F.explode(keys(F.col("host"), path(F.col("url")))).alias("key")))
    # paths keep their case in the captures; patterns are compared in lower case
    wanted = wanted.withColumn("pattern", F.lower("key")).drop("key")
    hit = (wanted.join(small(spans), ["pattern", "slice"])
           .where("starts <= fetched AND fetched < ends"))
    found = hit.groupBy("page_id", "url", "fetched").agg(
        F.count("*").alias("n_active"), F.collect_set("list").alias("_lists"),
        F.max(F.struct(F.length("pattern").alias("n"), (F.col("kind") == "block").alias("block"),
                       "pattern")).alias("_top"))
    return join_same(c, found, ["page_id", "url", "fetched"], "left").select(
        "page_id", "url", "host", "fetched",
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.coalesce(F.array_join(F.array_sort("_lists"), ","), F.lit("")).alias("lists"),
        F.col("_top.pattern").alias("decided_by"), F.coalesce("_top.block", F.lit(False)).alias("blocked"))


def captures(pages: DataFrame) -> DataFrame:
    """``pages`` carry no fetch time: one in the period is derived from the page's id and address."""
    t = hex_number(F.concat_ws("|", F.col("page_id").cast("string"), "url"), 8) % (PERIOD * DAY)
    return pages.select("page_id", "url", (EPOCH0 + t).alias("fetched"))


def entries(pages: DataFrame) -> DataFrame:
    """A dated log for the hosts of ``pages``: per host three lists, of which a hash picks the entries.

    Blocks go on, off and on again; ``trusted`` allows a path of the host; ``regions`` blocks whole parent domains."""
    hosts = pages.select(host(F.col("url")).alias("h")).where("h IS NOT NULL").distinct()
    parent = F.regexp_extract("h", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    day = lambda salt, c, n: hex_number(F.concat(c, F.lit(salt)), 6) % n
    at = lambda d: EPOCH0 + d * DAY

    def rows(df, list_, kind, pattern, key, every, steps):
        df = df.where(day(list_, key, every) == 0).select(pattern.alias("pattern"), key.alias("_k"))
        out = [df.select(F.lit(list_).alias("list"), F.lit(kind).alias("kind"), "pattern",
                         F.lit(action).alias("action"), at(offset + day(f"{list_}{salt}", F.col("_k"), n)).alias("at"))
               for action, offset, salt, n in steps]
        return out

    h = F.col("h")
    parents = hosts.where(parent != "").select(parent.alias("h")).distinct()
    parts = [*rows(hosts, "spam", "block", h, h, 2, [("add", 0, "a", 200), ("remove", 200, "b", 200), ("add", 420, "c", 200)]),
             *rows(hosts, "trusted", "allow", F.concat(h, F.lit("/en")), h, 3, [("add", 30, "a", 300)]),
             *rows(parents, "regions", "block", h, h, 4, [("add", 100, "a", 100), ("remove", 400, "b", 300)])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return evaluate(captures(pages), entries(pages))


def _sql_day(salt: str, n: int) -> str:
    return f"('0x' || substr(md5(h || '{salt}'), 1, 6))::BIGINT % {n}"


def _sql_rows(table, list_, kind, pattern, every, steps) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{list_}' AS list, '{kind}' AS kind, {pattern} AS pattern, '{action}' AS action, "
        f"{EPOCH0} + ({offset} + {_sql_day(list_ + salt, n)}) * {DAY} AS since FROM {table} WHERE {_sql_day(list_, every)} = 0"
        for action, offset, salt, n in steps)


SQL = rf"""
WITH caps AS (
  SELECT page_id, url, {EPOCH0} + ('0x' || substr(md5(page_id || '|' || url), 1, 8))::BIGINT % {PERIOD * DAY} AS fetched,
         nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages
), hosts AS (SELECT DISTINCT host AS h FROM caps WHERE host IS NOT NULL
), parents AS (SELECT DISTINCT regexp_extract(h, '([^.]+\.[^.]+\.[^.]+)$', 1) AS h FROM hosts
               WHERE regexp_matches(h, '([^.]+\.[^.]+\.[^.]+)$')
), log AS (
{_sql_rows('hosts', 'spam', 'block', 'h', 2, [('add', 0, 'a', 200), ('remove', 200, 'b', 200), ('add', 420, 'c', 200)])}
UNION ALL
{_sql_rows('hosts', 'trusted', 'allow', "h || '/en'", 3, [('add', 30, 'a', 300)])}
UNION ALL
{_sql_rows('parents', 'regions', 'block', 'h', 4, [('add', 100, 'a', 100), ('remove', 400, 'b', 300)])}
), spans AS (
  SELECT *, lead(since, 1, {FOREVER}) OVER (PARTITION BY list, kind, pattern ORDER BY since) AS until FROM log
), hits AS (
  SELECT DISTINCT c.page_id, s.list, s.kind, s.pattern
  FROM caps c JOIN spans s ON s.action = 'add' AND s.since <= c.fetched AND c.fetched < s.until
   AND (CASE WHEN contains(s.pattern, '/')
             THEN starts_with(lower(c.host || rtrim(c.path, '/')) || '/', s.pattern || '/')
             ELSE ends_with('.' || c.host, '.' || s.pattern) END)
), found AS (
  SELECT page_id, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         arg_max(pattern, (length(pattern), kind = 'block', pattern)) AS decided_by,
         arg_max(kind, (length(pattern), kind = 'block', pattern)) = 'block' AS blocked
  FROM hits GROUP BY page_id
)
SELECT c.page_id, url, host, fetched, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists,
       decided_by, coalesce(blocked, false) AS blocked
FROM caps c LEFT JOIN found USING (page_id)
"""
