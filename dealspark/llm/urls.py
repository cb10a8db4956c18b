"""URL filters by a temporal list join.

A list is a table of dated entries (list, kind, pattern, action, event, dated): on a date a pattern was added
to a list or removed from it. Entries become validity intervals, and every capture is joined, as of its fetch
date, with the entries that were active then. Kinds: d (a domain and all below it), h (one host), p (a host and the first
parts of a path). The most particular entry decides: p before h before d, then the longer pattern, then allow
before block, then the list's name.

A capture offers one key for each domain and host of its URL, and for each path prefix as deep as any entry, so matching is an
equi-join on keys with a range on dates; a hot host's rows are split by Spark's skew handling, since both sides of the join are plain shuffles.

Defined cases: a URL that is null or has no host matches nothing and passes; an entry that is
added again while active stays active; added and removed on one date is not active; entries and captures without a
date never match; repeated rows each get the verdict; other columns don't matter; empty captures give no rows and
an empty list lets everything pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.session import table

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^/?#@\]]*\]|[^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host; empty without one."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def url_keys(url: Column, depth: int) -> Column:
    """Keys d:, h: and p: under which list entries can match a URL, with path prefixes of at most ``depth`` parts."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.slice(F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != ""), 1, depth)
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.concat(F.lit("p:"), name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))
    paths = F.when(F.size(parts) > 0, prefixes).otherwise(F.array().cast("array<string>"))
    return F.when(name != "", F.array_distinct(F.concat(domains, F.array(F.concat(F.lit("h:"), name)), paths))).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """list, kind, pattern, action, valid_from, valid_to (exclusive, null while it lasts) of dated entries."""
    order = Window.partitionBy("list", "kind", "pattern", "action").orderBy("dated", "event")
    spans = entries.where("dated is not null").withColumn("valid_to", F.lead("dated").over(order)).where("event = 'add'")
    return spans.select("list", "kind", "pattern", "action", F.col("dated").alias("valid_from"), "valid_to").where("valid_to is null or valid_to > valid_from")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched, verdict (allow, block, pass), entry, list, valid_from for every capture (page_id, url, fetched)."""
    own = captures.select("page_id", "url", "fetched")
    spans = validity(entries).select(F.concat_ws(":", "kind", "pattern").alias("key"), "list", "action", "kind", "valid_from", "valid_to")
    depth = entries.where("kind = 'p'").agg(F.max(F.size(F.split("pattern", "/"))).alias("n")).first()["n"] or 0  # deeper prefixes match no entry
    offered = own.distinct().select("page_id", "url", "fetched", F.explode(url_keys(F.col("url"), depth)).alias("key"))
    active = (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    found = offered.join(spans, "key").where(active)
    rank = F.struct(
        F.when(F.col("kind") == "p", 3).when(F.col("kind") == "h", 2).otherwise(1).alias("kind"),
        F.length("key").alias("size"),
        (F.col("action") == "allow").alias("allowed"),
        F.translate("list", "\x00", "").alias("list"),
        F.col("key"),
        F.col("valid_from"),
    )
    best = found.groupBy("page_id", "url", "fetched").agg(F.max(rank).alias("best"))
    best = best.select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched").alias("f"), "best")
    out = own.join(best, F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")) & F.col("fetched").eqNullSafe(F.col("f")), "left")
    verdict = F.when(F.col("best").isNull(), "pass").when(F.col("best.allowed"), "allow").otherwise("block")
    return out.select("page_id", "url", "fetched", verdict.alias("verdict"), F.col("best.key").alias("entry"), F.col("best.list").alias("list"), F.col("best.valid_from").alias("valid_from"))


def allowed(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures that no active entry blocks."""
    return judged(captures, entries).where("verdict <> 'block'").select("page_id", "url", "fetched")


#: Entries of a small curated list: (kind, pattern, action, event, date).
CURATED = [
    ("d", "example.net", "allow", "add", "2024-03-01"),
    ("d", "example.net", "allow", "remove", "2024-10-01"),
    ("d", "example.org", "block", "add", "2024-01-15"),
    ("d", "example.org", "block", "remove", "2024-05-20"),
    ("d", "example.org", "block", "add", "2024-08-01"),
    ("h", "spam-farm.example.org", "block", "add", "2023-12-01"),
]
_DAY = "date_add(DATE'2024-01-01', CAST({} AS INT))"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched on days that follow from page_id, against a curated list and dated lists over all hosts of the table."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr(_DAY.format("page_id * 37 % 366")))
    hosts = pages.select(host(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("n", F.length("host"))
    dated = lambda rows, name, kind, pattern, event, day: rows.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit("block").alias("action"), F.lit(event).alias("event"), F.expr(_DAY.format(day)).alias("dated"))
    known = hosts.where("n % 4 = 0")
    again = hosts.where("n % 8 = 0")
    sections = hosts.where("n % 5 = 0")
    section = F.concat("host", F.lit("/de"))
    curated = spark.createDataFrame([("curated", *x) for x in CURATED], "list string, kind string, pattern string, action string, event string, dated string").withColumn("dated", F.col("dated").cast("date"))
    entries = curated
    for part in (
        dated(known, "hosts", "h", F.col("host"), "add", "n * 53 % 200"),
        dated(known, "hosts", "h", F.col("host"), "remove", "n * 53 % 200 + 90"),
        dated(again, "hosts", "h", F.col("host"), "add", "n * 53 % 200 + 150"),
        dated(sections, "sections", "p", section, "add", "100"),
    ):
        entries = entries.union(part)
    out = judged(captures, entries)
    return out.withColumn("fetched", F.col("fetched").cast("string")).withColumn("valid_from", F.col("valid_from").cast("string"))


OP1_SQL = """
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM pages),
h AS (SELECT DISTINCT host, length(host) AS n FROM p WHERE host <> ''),
e AS (
  SELECT 'curated' AS list, kind, pattern, action, event, CAST(d AS DATE) AS dated FROM (VALUES
    ('d', 'example.net', 'allow', 'add', '2024-03-01'), ('d', 'example.net', 'allow', 'remove', '2024-10-01'),
    ('d', 'example.org', 'block', 'add', '2024-01-15'), ('d', 'example.org', 'block', 'remove', '2024-05-20'),
    ('d', 'example.org', 'block', 'add', '2024-08-01'), ('h', 'spam-farm.example.org', 'block', 'add', '2023-12-01')) AS v(kind, pattern, action, event, d)
  UNION ALL SELECT 'hosts', 'h', host, 'block', 'add', DATE '2024-01-01' + CAST(n * 53 % 200 AS INTEGER) FROM h WHERE n % 4 = 0
  UNION ALL SELECT 'hosts', 'h', host, 'block', 'remove', DATE '2024-01-01' + CAST(n * 53 % 200 + 90 AS INTEGER) FROM h WHERE n % 4 = 0
  UNION ALL SELECT 'hosts', 'h', host, 'block', 'add', DATE '2024-01-01' + CAST(n * 53 % 200 + 150 AS INTEGER) FROM h WHERE n % 8 = 0
  UNION ALL SELECT 'sections', 'p', host || '/de', 'block', 'add', DATE '2024-01-01' + 100 FROM h WHERE n % 5 = 0),
s AS (SELECT * FROM (SELECT *, lead(dated) OVER (PARTITION BY list, kind, pattern, action ORDER BY dated, event) AS valid_to FROM e)
      WHERE event = 'add' AND (valid_to IS NULL OR valid_to > dated)),
m AS (
  SELECT p.page_id, s.kind || ':' || s.pattern AS entry, s.list, s.action, s.dated AS valid_from,
         row_number() OVER (PARTITION BY p.page_id ORDER BY CASE s.kind WHEN 'p' THEN 3 WHEN 'h' THEN 2 ELSE 1 END DESC,
           length(s.pattern) DESC, s.action = 'allow' DESC, s.list DESC, s.pattern DESC, s.dated DESC) AS k
  FROM p JOIN s ON p.fetched >= s.dated AND (s.valid_to IS NULL OR p.fetched < s.valid_to) AND (
    (s.kind = 'h' AND p.host = s.pattern)
    OR (s.kind = 'd' AND (p.host = s.pattern OR p.host LIKE '%.' || s.pattern))
    OR (s.kind = 'p' AND len(p.parts) > 0 AND p.host || '/' || p.parts[1] = s.pattern)))
SELECT p.page_id, p.url, CAST(p.fetched AS VARCHAR) AS fetched,
       CASE WHEN m.entry IS NULL THEN 'pass' ELSE m.action END AS verdict, m.entry, m.list, CAST(m.valid_from AS VARCHAR) AS valid_from
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.k = 1
"""
