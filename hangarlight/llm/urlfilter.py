"""URL filters: host and path rules, and trust spread over the link graph of hosts.

Rules judge the urls they fit; the longest wins (ties: block before allow, then the rule's text). All
other urls get their host's verdict: personalised PageRank from trusted seeds over host links, and from
blocked seeds over reversed links (who links to blocked hosts earns distrust). The mass of hosts without
links goes back to the seeds. A blocked seed is blocked; another host is if its distrust exceeds its trust and
reaches ``FLOOR`` of what an even spread over all hosts would give.

Links are the href values of a page, resolved against its <base href> or its own url; only links between
different hosts are edges. They are counted per (host, host) before anything is shuffled further; ranks are
joined to edges by the source host and summed per target, with pre-aggregation. Hosts with very many edges or
pages are dealt over several tasks. Ranks and edges are Spark tables, written in each round; the driver sees
only a sum per round. Rounds go on until ranks are exact to ``ERROR`` of that limit.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is
allowed. Null html has no links; html of any length is read whole. Repeated pages are judged alike and count their links again.
An empty table has no result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_from, hot_keys, join_hot, materialize, repeated, salted

DAMPING = 0.85
FLOOR = 0.5
#: Largest error of a host's rank, as a share of the limit ``FLOOR`` / hosts.
ERROR = 1e-3


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_BASE_TAG = r"(?i)<base\b[^>]*>"
_HREF = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
#: Host of a reference that names one; references without ``//`` are relative or of a scheme without hosts.
_REFERENCE = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)"
_OTHER_SCHEME = r"(?i)^[a-z][a-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits_host(host: Column, rule: Rule) -> Column:
    return (host == rule.host) | host.endswith("." + rule.host)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; null if none does. Rules are a short, given list."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = _fits_host(host, rule) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _lower(host: Column) -> Column:
    return F.translate(host, _UPPER, _LOWER)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, counted."""
    html = F.col("html")
    tag = F.regexp_extract(html, _BASE_TAG, 0)
    base = F.regexp_extract(F.regexp_extract(tag, _HREF, 1), _REFERENCE, 1)
    body = F.when(tag != "", F.regexp_replace(html, _BASE_TAG, "")).otherwise(html)
    links = pages.select(
        host_of(F.col("url")).alias("src"), base.alias("base"), F.explode(F.array_distinct(F.regexp_extract_all(body, F.lit(_HREF), F.lit(1)))).alias("href")
    )
    named = F.regexp_extract("href", _REFERENCE, 1)
    relative = ~F.col("href").rlike(_OTHER_SCHEME) & ~F.col("href").startswith("//")
    # Relative references leave the host only by way of a base.
    links = links.withColumn("dst", _lower(F.when(relative, F.col("base")).otherwise(named)))
    links = links.filter("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Personalised PageRank (host, rank; ranks sum to 1) from seeds (host, mass; masses sum to 1) over edges (src, dst, n).

    Goes on until a round changes the ranks by less than ``tolerance`` in sum; the error left is then at most
    ``tolerance * damping / (1 - damping)``, relative to the ranks' sum. Only a caller that gives ``rounds`` gets
    ranks that may be cut short. Handing the mass of hosts without links back to the seeds only scales the ranks,
    so it is done once at the end.
    """
    # Round t changes at most (1 - damping) * damping ** t, so twice the rounds to the tolerance are never needed.
    bound = rounds or 2 * math.ceil(max(1.0, math.log(tolerance / (1 - damping), damping))) + 10
    out = materialize(edges.groupBy("src").agg(F.sum("n").alias("total"), F.count("*").alias("_n")))
    hot = hot_from(out, ["src"], "_n")
    shares = join_hot(edges, out.drop("_n"), ["src"], hot=hot).select("src", "dst", (F.col("n") / F.col("total")).alias("w"))
    weighted = materialize(salted(shares, hot, ["src"], F.xxhash64("dst")))
    base = materialize(seeds).select("host", (F.col("mass") * (1 - damping)).alias("rank"))
    rank = base
    for _ in range(bound):
        sources = repeated(rank.withColumnRenamed("host", "src"), hot, ["src"])
        moved = weighted.join(sources, ["src", "_salt"]).select(F.col("dst").alias("host"), (F.col("rank") * F.col("w") * damping).alias("rank"))
        new = materialize(moved.union(base).groupBy("host").agg(F.sum("rank").alias("rank")))
        both = new.withColumnRenamed("rank", "now").join(rank.withColumnRenamed("rank", "then"), "host", "full")
        gap = F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("then", F.lit(0.0)))
        change, total = both.agg(F.coalesce(F.sum(gap), F.lit(0.0)), F.coalesce(F.sum("now"), F.lit(0.0))).first()
        rank = new
        if change < tolerance:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"ranks still change by {change} after {bound} rounds")
    return rank.withColumn("rank", F.col("rank") / F.lit(float(total or 1.0)))


def _even(hosts: DataFrame) -> DataFrame:
    """The hosts with equal masses that sum to 1."""
    n = hosts.count()
    return hosts.withColumn("mass", F.lit(1.0 / max(n, 1)))


def host_scores(pages: DataFrame, rules=RULES) -> DataFrame:
    """host, trust, distrust, blocked. Blocked seeds: hosts that a rule blocks whole; trusted seeds: other hosts that an allow rule names."""
    edges = materialize(host_edges(pages))
    hosts = materialize(
        pages.select(host_of(F.col("url")).alias("host")).filter("host <> ''").distinct().union(edges.select("dst")).distinct()
    )
    blocked = F.lit(False)
    trusted = F.lit(False)
    for rule in rules:
        fits = _fits_host(F.col("host"), rule)
        if rule.verdict == "block" and rule.path == "/":
            blocked = blocked | fits
        elif rule.verdict == "allow":
            trusted = trusted | fits
    good = _even(hosts.filter(trusted & ~blocked))
    bad = _even(hosts.filter(blocked))
    n = hosts.count()
    tolerance = ERROR * FLOOR / max(n, 1) * (1 - DAMPING) / DAMPING
    trust = spread(edges, good, tolerance=tolerance).withColumnRenamed("rank", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = spread(back, bad, tolerance=tolerance).withColumnRenamed("rank", "distrust")
    zero = F.lit(0.0)
    scored = (
        hosts.join(trust, "host", "left").join(distrust, "host", "left").join(bad.select("host", F.lit(True).alias("seed")), "host", "left")
        .select("host", F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"), F.coalesce("seed", F.lit(False)).alias("seed"))
    )
    found = (F.col("distrust") > F.col("trust")) & (F.col("distrust") * n >= FLOOR)
    return scored.withColumn("blocked", F.col("seed") | found).drop("seed")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for each page."""
    url = F.col("url").cast("string")
    pages = pages.select("page_id", url.alias("url"), F.col("html").cast("string").alias("html"))
    scores = materialize(host_scores(pages, rules).filter("blocked").select("host", "blocked"))
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = named.withColumn("rule", text).withColumn("ruled", verdict)
    spread_to = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return join_hot(judged, scores, ["host"], "left", hot_keys(judged.select("host"), ["host"])).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", spread_to).alias("verdict")
    )
