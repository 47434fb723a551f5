"""Line dedup by site-relative frequency.

A page's lines are its html without scripts, styles and comments, broken at block elements, tags removed
and white space trimmed. Within a host, a line's ratio is the number of pages that contain it by the
host's page total; lines above ``RATIO`` are boilerplate and are dropped, on every page of the host.

Pages are parsed once; their lines are a table from then on. Lines are counted by (host, digest) with
pre-aggregation, so a line on every page is one counter per task. A host's boilerplate digests are an array of
at most (lines per page) / RATIO entries, because the counts of its lines add up to its lines; pages are joined
with their host's array, not line by line, and the pages of a large host are dealt over several tasks.

Defined results: null html has no lines. Pages whose url has no host belong to no site and lose nothing.
A line that stands on one page only is no boilerplate, whatever its ratio, so a site of one page keeps all. A
line repeated inside a page counts once, and all its occurrences go. Rows repeating a page_id, and rows alike in
all columns, are pages of their own. Html and lines of any length are read whole. An empty table has no result. Reports read
page_id, url and html alone; other columns stay as they are where pages are cleaned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize
from .urlfilter import host_of

RATIO = 0.3

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_BREAKS = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|nav|article|section|header|footer|main|title|head|body|html|meta|pre|blockquote)\b[^>]*>"
_TAGS = r"<[^>]*>"
_EDGES = r"^[ \t\r\f]+|[ \t\r\f]+$"


def lines_of(html: Column) -> Column:
    """Array of the visible, non-empty lines."""
    plain = F.regexp_replace(F.regexp_replace(html, _HIDDEN, ""), _BREAKS, "\n")
    lines = F.split(F.regexp_replace(plain, _TAGS, ""), "\n")
    trimmed = F.transform(lines, lambda x: F.regexp_replace(x, _EDGES, ""))
    return F.coalesce(F.filter(trimmed, lambda x: x != ""), F.array().cast("array<string>"))


def boilerplate(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """host and the array of its boilerplate lines' digests, from rows (host, digests)."""
    sites = pages.filter("host <> ''")
    totals = sites.groupBy("host").agg(F.count("*").alias("pages"))
    per_line = sites.select("host", F.explode(F.array_distinct("digests")).alias("digest")).groupBy("host", "digest").agg(F.count("*").alias("n"))
    common = per_line.filter("n > 1").join(totals, "host").filter(F.col("n") > F.col("pages") * ratio)
    return common.groupBy("host").agg(F.collect_set("digest").alias("common"))


def dedup_lines(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """page_id, host, lines and kept lines for each page."""
    split = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"), lines_of(F.col("html").cast("string")).alias("lines"))
    split = materialize(split.withColumn("digests", F.transform("lines", lambda x: F.md5(x))))
    hosts = materialize(boilerplate(split.select("host", "digests"), ratio))
    joined = join_hot(split, hosts, ["host"], "left")
    # Only the page's own boilerplate is looked up line by line.
    joined = joined.withColumn("gone", F.coalesce(F.array_intersect("digests", "common"), F.array().cast("array<string>")))
    pairs = F.filter(F.arrays_zip("lines", "digests"), lambda x: ~F.array_contains(F.col("gone"), x["digests"]))
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(F.transform(pairs, lambda x: x["lines"]))
    return joined.select("page_id", "host", "lines", kept.alias("kept"))


def report(pages: DataFrame) -> DataFrame:
    """page_id, host, n_lines, n_dropped, and the digest of the kept text."""
    done = dedup_lines(pages)
    return done.select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.md5(F.array_join("kept", "\n")).alias("kept_md5"),
    )


ORACLE_SQL = r"""
WITH plain AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
      '(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|nav|article|section|header|footer|main|title|head|body|html|meta|pre|blockquote)\b[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g'), chr(10)) AS raw
  FROM pages),
split AS (SELECT row_number() OVER () AS r, page_id, host, list_filter(list_transform(raw, lambda x: regexp_replace(x, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g')), lambda x: x <> '') AS lines FROM plain),
totals AS (SELECT host, count(*) AS pages FROM split WHERE host <> '' GROUP BY host),
seen AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM split) GROUP BY ALL),
common AS (SELECT host, list(line) AS c FROM seen JOIN totals USING (host) WHERE n > 1 AND n > pages * 0.3 GROUP BY host),
kept AS (SELECT page_id, s.host, lines, CASE WHEN c IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(c, x)) END AS kept FROM split s LEFT JOIN common USING (host))
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped, md5(array_to_string(kept, chr(10))) AS kept_md5 FROM kept
"""
