"""URL filter by a temporal list join, in DataFrame operations only.

A list is a table of dated entries (pattern, listed_on, action): from its day
on, ``block`` or ``allow`` holds for the pattern until the pattern's next
entry, and ``remove`` ends it. Entries become validity intervals; every
capture is joined with the entries of its own patterns that are active when
it was fetched (the as-of join), and the most specific one decides.

Patterns of a URL: its host, every parent domain of two labels or more, and
host plus first path segment (the most specific). Scheme, user, port, query
and fragment don't count; hosts are lower case.

A pattern may be named by a third of all captures, so the captures are dealt
over ``spread`` parts and the intervals, which are few beside them, are copied
to each part. An entry's date is a day and a pattern has one entry a day (of
several on a day block comes before allow and allow before remove), so the
window over a pattern is bounded by the number of days.

Results: one row per capture, repeated captures included. A null or
unparsable URL has no patterns, a null time no active entries: both are not
blocked. Entries with a null pattern, day or unknown action are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SPREAD = 16


def host_of(url: Column) -> Column:
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(bare, r"\.$", ""))


def patterns_of(url: Column) -> Column:
    """Array of (pattern, rank) of a URL; a higher rank is more specific."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(
        F.array_join(F.slice(labels, i, n), ".").alias("pattern"), (n - i + 1).cast("int").alias("rank")))
    segment = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*(/[^/?#]+)", 1)
    path = F.when(segment != "", F.array(F.struct(F.concat(host, segment).alias("pattern"), F.lit(1000).alias("rank"))))
    none = F.array().cast("array<struct<pattern:string,rank:int>>")
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(suffixes, F.coalesce(path, none))).otherwise(none)


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_until) of block and allow entries;
    valid_until is null while no later entry ends it."""
    order = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).when(F.col("action") == "remove", 1)
    daily = (entries.select("pattern", F.col("listed_on").cast("date").alias("valid_from"), order.alias("code"))
             .where("pattern is not null and valid_from is not null and code is not null")
             .groupBy("pattern", "valid_from").agg(F.max("code").alias("code")))
    until = F.lead("valid_from").over(W.partitionBy("pattern").orderBy("valid_from"))
    return (daily.withColumn("valid_until", until).where("code > 1")
            .select("pattern", F.when(F.col("code") == 3, "block").otherwise("allow").alias("action"), "valid_from", "valid_until"))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at",
             spread: int = SPREAD) -> DataFrame:
    """(id, url, fetched_at, host, pattern, action, valid_from, valid_until, blocked) per capture."""
    rows = (captures.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).cast("timestamp").alias("at"))
            .agg(F.count("*").alias("copies")))
    asked = (rows.withColumn("p", F.explode_outer(patterns_of(F.col("url"))))
             .select("id", "url", "at", "copies", F.col("p.pattern").alias("asked"), F.col("p.rank").alias("rank"),
                     F.pmod(F.xxhash64("id", "url", "at"), F.lit(spread)).cast("int").alias("part")))
    held = intervals(entries).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    active = ((F.col("asked") == F.col("pattern")) & (F.col("part") == F.col("copy")) & (F.col("at") >= F.col("valid_from"))
              & (F.col("valid_until").isNull() | (F.col("at") < F.col("valid_until"))))
    best = (asked.join(held, active, "left").groupBy("id", "url", "at", "copies")
            .agg(F.max(F.when(F.col("pattern").isNotNull(), F.struct("rank", "pattern", "action", "valid_from", "valid_until"))).alias("e")))
    return (best.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col), host_of(F.col("url")).alias("host"),
                    "e.pattern", "e.action", "e.valid_from", "e.valid_until", F.coalesce(F.col("e.action") == "block", F.lit(False)).alias("blocked")))


# The query's list and fetch times, derived from the pages table.

def _number(text: Column, below: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % below


def fetched(pages: DataFrame) -> DataFrame:
    """Pages as captures: each fetched at a second of 2024 given by its id."""
    second = _number(F.col("page_id").cast("string"), 366 * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("fetched_at"))


def derived_list(pages: DataFrame) -> DataFrame:
    """Four dated entries for every pattern that occurs, dates and actions given by the pattern."""
    of = pages.select("url").distinct().select(F.explode(patterns_of(F.col("url"))).alias("p")).select("p.pattern").distinct()
    dated = of.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(3))))
    day = _number(F.concat("pattern", F.lit(":"), F.col("v").cast("string")), 366).cast("int")
    action = F.element_at(F.array(*map(F.lit, ("block", "allow", "remove", "block"))),
                          (_number(F.concat("pattern", F.lit("#"), F.col("v").cast("string")), 4) + 1).cast("int"))
    return dated.select("pattern", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("listed_on"), action.alias("action"))


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    out = evaluate(fetched(pages), derived_list(pages))
    return out.select("page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "host", "pattern", "action",
                      F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_until").cast("string").alias("valid_until"), "blocked")


SQL = r"""
WITH parsed AS (
  SELECT page_id, url,
    TIMESTAMP '2024-01-01' + to_seconds(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 31622400) AS ts,
    lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.$', '')) AS host,
    regexp_extract(url, '^[^:/?#]+://[^/?#]*(/[^/?#]+)', 1) AS segment
  FROM pages),
asked AS (
  SELECT page_id, url, ts, host, array_to_string(string_split(host, '.')[i:], '.') AS pattern, len(string_split(host, '.')) - i + 1 AS rank
  FROM parsed, (SELECT unnest(range(1, 60)) AS i) n
  WHERE host <> '' AND i <= greatest(len(string_split(host, '.')) - 1, 1)
  UNION ALL
  SELECT page_id, url, ts, host, host || segment, 1000 FROM parsed WHERE host <> '' AND segment <> ''),
entries AS (
  SELECT pattern, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(pattern || ':' || v), 1, 8) AS BIGINT) % 366 AS INTEGER) AS day,
    max([3, 2, 1, 3][CAST('0x' || substr(md5(pattern || '#' || v), 1, 8) AS BIGINT) % 4 + 1]) AS code
  FROM (SELECT DISTINCT pattern FROM asked), (SELECT unnest(range(0, 4)) AS v) n GROUP BY ALL),
held AS (
  SELECT pattern, day AS valid_from, code, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS valid_until FROM entries),
best AS (
  SELECT a.page_id, a.url, a.ts, h.*, row_number() OVER (PARTITION BY a.page_id, a.url, a.ts ORDER BY a.rank DESC) AS k
  FROM asked a JOIN held h ON a.pattern = h.pattern AND h.code > 1 AND a.ts >= h.valid_from AND (h.valid_until IS NULL OR a.ts < h.valid_until))
SELECT p.page_id, p.url, strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS fetched_at, p.host, b.pattern,
  CASE b.code WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS action,
  CAST(b.valid_from AS VARCHAR) AS valid_from, CAST(b.valid_until AS VARCHAR) AS valid_until, coalesce(b.code = 3, false) AS blocked
FROM parsed p LEFT JOIN best b ON b.k = 1 AND p.page_id = b.page_id AND p.url = b.url AND p.ts = b.ts
"""
