"""URL filters by dated lists: an as-of join of captures to the entries active at fetch time.

A list is a log of dated entries: a pattern is added or removed. The log of each pattern becomes
disjoint validity intervals, from an addition to the next removal. A capture is tested for the keys
that its URL can match (its host, each parent domain, its host with each leading part of the path),
and each key is joined to the interval that was open at the capture's fetch time: the join is on the
key, and the interval bounds the time, so at most one interval of a key matches a capture.

DataFrame functions only. Captures of one frequent host share a key; both sides of the join are plain
shuffles, which adaptive execution splits, or the list is broadcast if it proves small at run time.

Nulls: a capture without a URL, without a host in it, or without a fetch time matches nothing. Entries
with a null pattern, kind or time are left out. Of entries of a pattern at the same time a removal
counts last; an addition within an open interval changes nothing. An interval begins with its addition
and ends before its removal. A very long URL has as many keys as its path has folders. Repeated captures give repeated results; empty tables give no rows or no
matches. Results hold the named columns only, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import table

# Kinds of patterns: a host alone, a domain with all below it, a host with the beginning of a path.
HOST, DOMAIN, PREFIX = "host", "domain", "prefix"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The URL's host in lower case; null if there is none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", host)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, since, until) from a log (kind, pattern, added, at); until is null if still open."""
    log = entries.select("kind", "pattern", "at", "added").dropna()
    # one entry for each moment: a removal wins over an addition
    moment = log.groupBy("kind", "pattern", "at").agg(F.min("added").alias("added"))
    order = Window.partitionBy("kind", "pattern").orderBy("at")
    turns = moment.withColumn("before", F.lag("added").over(order)).where(
        F.col("added") != F.coalesce("before", F.lit(False))
    )
    ended = turns.withColumn("until", F.lead("at").over(order))
    return ended.where("added").select("kind", "pattern", F.col("at").alias("since"), "until")


def _keys(host: Column, path: Column) -> Column:
    """(kind, pattern) of everything that a list entry for this URL could say."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit(DOMAIN).alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    prefixes = F.transform(
        F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.expr("array()").cast("array<int>")),
        lambda i: F.struct(
            F.lit(PREFIX).alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("pattern")
        ),
    )
    whole = F.array(F.struct(F.lit(HOST).alias("kind"), host.alias("pattern")))
    return F.concat(whole, domains, prefixes)


def filter_urls(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """(key, host, fetched, blocked, n_active, kind, pattern, since) for every capture.

    `n_active` counts the keys with an open interval; kind, pattern and since are those of the one
    that has been open longest, the first by kind and pattern among equals.
    """
    seen = captures.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.col(fetched).alias("fetched"),
        host_of(F.col(url)).alias("host"),
        F.regexp_extract(F.col(url), _PATH, 1).alias("path"),
    )
    # a capture without keys keeps one that no entry has
    none = F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("pattern")))
    keys = F.when(F.col("host").isNull(), none).otherwise(_keys(F.col("host"), F.coalesce("path", F.lit(""))))
    asked = seen.select("row", "key", "fetched", "host", F.explode(keys).alias("k")).select(
        "row", "key", "fetched", "host", "k.kind", "k.pattern"
    )
    spans = validity_intervals(entries)
    open_then = (
        (asked["kind"] == spans["kind"])
        & (asked["pattern"] == spans["pattern"])
        & (asked["fetched"] >= spans["since"])
        & (spans["until"].isNull() | (asked["fetched"] < spans["until"]))
    )
    found = asked.join(spans, open_then, "left").select(
        "row",
        asked["key"],
        "fetched",
        "host",
        F.when(spans["since"].isNotNull(), F.struct(spans["since"], asked["kind"], asked["pattern"])).alias("hit"),
    )
    return (
        found.groupBy("row", "key", "fetched", "host")
        .agg(F.count("hit").alias("n_active"), F.min("hit").alias("hit"))
        .select(
            F.col("key").alias(key),
            "host",
            F.col("fetched").alias(fetched),
            (F.col("n_active") > 0).alias("blocked"),
            "n_active",
            "hit.kind",
            "hit.pattern",
            "hit.since",
        )
    )


# `pages` has neither fetch times nor a list; both are derived from its own rows, as the SQL shows.
_FIRST = "2024-01-01 00:00:00"


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Each page with a fetch time within 90 days, by its id."""
    seconds = (F.coalesce(F.col("page_id"), F.lit(0)) * 7919 * 60) % (90 * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.unix_timestamp(F.lit(_FIRST)) + seconds).alias("fetched_at"))


def entries_of_pages(pages: DataFrame) -> DataFrame:
    """A log over the hosts of `pages`, their parent domains and first path parts, by digests of their names."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract("url", _PATH, 1).alias("path")).where("host IS NOT NULL")
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    first = F.regexp_extract("path", r"^/([^/]+)", 1)
    named = hosts.select(
        F.explode(
            F.array(
                F.struct(F.lit(HOST).alias("kind"), F.col("host").alias("pattern")),
                F.struct(F.lit(DOMAIN).alias("kind"), parent.alias("pattern")),
                F.struct(F.lit(PREFIX).alias("kind"), F.when(first != "", F.concat("host", F.lit("/"), first)).otherwise("").alias("pattern")),
            )
        ).alias("n")
    ).select("n.kind", "n.pattern").where("pattern <> ''").distinct()
    digest = F.conv(F.substring(F.md5(F.concat("kind", "pattern").cast("binary")), 1, 6), 16, 10).cast("long")
    day = (F.col("digest") / 16).cast("long") % 60
    step = lambda added, after, each: F.when(
        F.col("digest") % each == 0, F.struct(F.lit(added).alias("added"), (day + after).alias("day"))
    )
    log = named.withColumn("digest", digest).select(
        "kind", "pattern", F.explode(F.array(step(True, 0, 4), step(False, 20, 8), step(True, 30, 16), step(True, 35, 16))).alias("e")
    )
    return log.where("e IS NOT NULL").select(
        "kind", "pattern", "e.added", F.timestamp_seconds(F.unix_timestamp(F.lit(_FIRST)) + F.col("e.day") * 86400).alias("at")
    )


def urls_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return filter_urls(captures_of_pages(pages), entries_of_pages(pages))


ORACLE = rf"""
WITH hosts AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{_HOST}', 1)), '') AS host,
         regexp_extract(url, '{_PATH}', 1) AS path,
         TIMESTAMP '{_FIRST}' + to_seconds((coalesce(page_id, 0) * 7919 * 60) % (90 * 86400)) AS fetched_at
  FROM pages),
named AS (
  SELECT DISTINCT kind, pattern FROM (
    SELECT '{HOST}' AS kind, host AS pattern FROM hosts
    UNION ALL SELECT '{DOMAIN}', regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) FROM hosts
    UNION ALL SELECT '{PREFIX}', host || '/' || nullif(regexp_extract(path, '^/([^/]+)', 1), '') FROM hosts)
  WHERE pattern <> ''),
digests AS (SELECT *, ('0x' || md5(kind || pattern)[1:6])::BIGINT AS digest FROM named),
log AS (
  SELECT kind, pattern, added, TIMESTAMP '{_FIRST}' + to_days(CAST((digest // 16) % 60 + after AS INTEGER)) AS due
  FROM digests, (VALUES (true, 0, 4), (false, 20, 8), (true, 30, 16), (true, 35, 16)) e(added, after, each)
  WHERE digest % each = 0),
moments AS (SELECT kind, pattern, due, bool_and(added) AS added FROM log GROUP BY ALL),
states AS (  -- the state in force from each entry on
  SELECT m.*, lead(due) OVER (PARTITION BY kind, pattern ORDER BY due) AS next FROM moments m),
active AS (
  SELECT h.page_id, s.kind, s.pattern,
         -- since: the addition after the last removal up to the fetch
         (SELECT min(a.due) FROM moments a WHERE a.kind = s.kind AND a.pattern = s.pattern AND a.added AND a.due <= h.fetched_at
          AND NOT EXISTS (SELECT 1 FROM moments r WHERE r.kind = s.kind AND r.pattern = s.pattern AND NOT r.added
                          AND r.due >= a.due AND r.due <= h.fetched_at)) AS since
  FROM hosts h JOIN states s ON s.added AND s.due <= h.fetched_at AND (s.next IS NULL OR h.fetched_at < s.next)
   AND ((s.kind = '{HOST}' AND s.pattern = h.host)
        OR (s.kind = '{DOMAIN}' AND (s.pattern = h.host OR ends_with(h.host, '.' || s.pattern)))
        OR (s.kind = '{PREFIX}' AND starts_with(h.host || regexp_replace(h.path, '/+', '/', 'g') || '/', s.pattern || '/')))),
best AS (
  SELECT page_id, count(*) AS n_active, min({{'since': since, 'kind': kind, 'pattern': pattern}}) AS hit
  FROM active GROUP BY page_id)
SELECT page_id, host, fetched_at, n_active IS NOT NULL AS blocked, coalesce(n_active, 0) AS n_active,
       hit.kind AS kind, hit.pattern AS pattern, hit.since AS since
FROM hosts LEFT JOIN best USING (page_id)"""
