"""Mixing sources to target weights by hierarchical token budgets.

Weights run down a domain-language-source tree. A node's budget is divided among its children in
proportion to their weights, but no child gets more than its subtree holds (its tokens times the allowed
epochs); what a child cannot take goes to its siblings first, and only what a whole subtree cannot take
is left to the level above, because each level divides by subtree capacity. Division with capacities is
water filling: sort by capacity / weight, fill the smallest first.

Each leaf then takes whole seeded epochs and a token-prefix of the next one: documents ordered by a
seeded digest, taken while the tokens before them are below the leaf's budget. The prefix ends at a
cut-off digest per leaf, found from sums over digest ranges that get finer in each pass, so no leaf is
sorted or summed in one task; joins with the leaves deal large leaves over several tasks. Texts are not
shuffled: ``mix`` selects its rows in place (``keep_rows``).

Tokens are words unless the caller gives another column, such as op2's stored counts joined to the documents.

Defined results: null text has no tokens; null lang or source form leaves of their own ('' in the tree).
Documents without tokens cost nothing and are taken with the epochs that reach them; a leaf without any
tokens is taken whole, once, at any budget. Null ids are ordered as '' and rows repeating an id in a leaf go
together. Texts of any length are counted whole. An empty table has no result. ``mix`` keeps all columns, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, keep_rows, materialize

LEAF = ("domain", "lang", "source")
DIGEST_DIGITS = 12  # hexadecimal digits of the digest used as the order, so 48 bits
#: Bits of the digest that each pass of the search for the cut-off settles; a window holds 2^(PASS_BITS / 2) sums.
PASS_BITS = 16

#: Default weights. A domain, language or source that is not named has weight 1 among its siblings.
DOMAIN_WEIGHTS = {"crawl": 2.0, "curated": 5.0, "community": 3.0}
LANG_WEIGHTS = {"en": 4.0, "de": 2.0, "es": 2.0, "fr": 2.0}
SOURCE_DOMAINS = {"src0": "crawl", **{f"src{k}": "curated" for k in range(1, 10)}}
OTHER_DOMAIN = "community"


def lookup(column: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for key, value in values.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def token_length(text: Column) -> Column:
    """Tokens of a document: runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def leaf_columns(docs: DataFrame) -> dict[str, Column]:
    lang = F.coalesce(docs["lang"].cast("string"), F.lit(""))
    source = F.coalesce(docs["source"].cast("string"), F.lit(""))
    return {"domain": lookup(source, SOURCE_DOMAINS, OTHER_DOMAIN), "lang": lang, "source": source}


def seeded_digest(doc_id: Column, epoch: Column, seed: int) -> Column:
    """A number from the MD5 of seed, epoch and id: the order of an epoch."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DIGEST_DIGITS), 16, 10).cast("long")


def water_fill(nodes: DataFrame, parent: list[str], name: str, weight: Column, capacity: str, budget: str) -> DataFrame:
    """Divide each parent's ``budget`` among its rows by weight, none above its capacity: column ``share``."""
    order = Window.partitionBy(*parent).orderBy(F.col(capacity) / F.col("_w"), name)
    whole = Window.partitionBy(*parent)
    filled = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col(budget) - F.coalesce(F.sum(capacity).over(filled), F.lit(0.0))) / F.sum("_w").over(rest)
    at = nodes.withColumn("_w", weight).withColumn("_level", level)
    open_level = F.max(F.when(F.col(capacity) / F.col("_w") > F.col("_level"), F.col("_level"))).over(whole)
    return (
        at.withColumn("_open", open_level)
        .withColumn("share", F.coalesce(F.least(F.col(capacity), F.col("_open") * F.col("_w")), F.col(capacity)))
        .drop("_w", "_level", "_open")
    )


def leaf_budgets(leaves: DataFrame, fraction: float, max_epochs: int) -> DataFrame:
    """Budgets in whole tokens for rows (domain, lang, source, tokens); the total is ``fraction`` of all tokens."""
    leaf = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    lang = leaf.groupBy("domain", "lang").agg(F.sum("cap").alias("lang_cap"))
    domain = lang.groupBy("domain").agg(F.sum("lang_cap").alias("domain_cap"))
    total = leaf.agg((F.floor(F.sum("tokens") * fraction)).cast("double").alias("budget"))
    top = domain.crossJoin(F.broadcast(total)).withColumn("root", F.lit(0))  # one row
    top = water_fill(top, ["root"], "domain", lookup(F.col("domain"), DOMAIN_WEIGHTS, 1.0), "domain_cap", "budget")
    top = top.select("domain", F.col("share").alias("domain_budget"))
    mid = water_fill(
        lang.join(top, "domain"), ["domain"], "lang", lookup(F.col("lang"), LANG_WEIGHTS, 1.0), "lang_cap", "domain_budget"
    ).select("domain", "lang", F.col("share").alias("lang_budget"))
    low = water_fill(leaf.join(mid, ["domain", "lang"]), ["domain", "lang"], "source", F.lit(1.0), "cap", "lang_budget")
    return low.select(*LEAF, "tokens", F.floor(F.col("share") + 1e-6).cast("long").alias("budget"))


def cutoffs(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """LEAF, cutoff: the digest at which the tokens of each leaf, in digest order, reach ``rest``.

    ``rows`` (LEAF, digest, n_tokens) is materialised, ``rest`` (LEAF, rest) has 0 < rest <= the leaf's tokens.
    Each pass sums the rows of the digest range found so far over its finer ranges, and finds the one in which
    the tokens run out in two steps, over coarse and then fine sums.
    """
    leaf, half = list(LEAF), PASS_BITS // 2
    state = rest.select(*leaf, "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))

    def crossing(sums: DataFrame, name: str) -> DataFrame:
        """The row of each leaf in which ``before`` + running k reaches rest, with ``before`` moved up to it."""
        ahead = Window.partitionBy(*leaf).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        at = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("k").over(ahead), F.lit(0)))
        return at.filter("before < rest and before + k >= rest").drop("k")

    for shift in range(4 * DIGEST_DIGITS - PASS_BITS, -1, -PASS_BITS):
        inside = rows.withColumn("prefix", F.shiftright("digest", shift + PASS_BITS))
        if shift + PASS_BITS < 4 * DIGEST_DIGITS:
            inside = inside.join(state.select(*leaf, "prefix"), [*leaf, "prefix"], "left_semi")
        cells = materialize(inside.groupBy(*leaf, F.shiftright("digest", shift).alias("cell")).agg(F.sum("n_tokens").alias("k")))
        coarse = cells.withColumn("top", F.shiftright("cell", half)).groupBy(*leaf, "top").agg(F.sum("k").alias("k"))
        top = crossing(coarse.join(state.select(*leaf, "rest", "before"), leaf), "top")
        fine = cells.withColumn("top", F.shiftright("cell", half)).join(top, [*leaf, "top"])
        state = materialize(crossing(fine.drop("top"), "cell").withColumnRenamed("cell", "prefix"))
    return state.select(*leaf, F.col("prefix").alias("cutoff"))


def plan(docs: DataFrame, fraction: float = 0.6, max_epochs: int = 2, seed: int = 7, tokens: Column | None = None):
    """(narrow rows, leaf cut-offs): leaf, whole epochs, and the last epoch's last digest."""
    n_tokens = token_length(docs["text"]) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))
    narrow = materialize(docs.select("doc_id", *(c.alias(k) for k, c in leaf_columns(docs).items()), n_tokens.alias("n_tokens")))
    leaves = materialize(narrow.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")))
    budgets = (
        leaf_budgets(leaves.filter("tokens > 0"), fraction, max_epochs)
        .withColumn("whole", F.expr("budget div tokens").cast("int"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    )
    none = F.lit(0).cast("long")
    free = leaves.filter("tokens = 0").select(*LEAF, "tokens", none.alias("budget"), F.lit(1).alias("whole"), none.alias("rest"))
    budgets = materialize(budgets.unionByName(free))
    open_leaves = budgets.filter("rest > 0").select(*LEAF, "whole")
    digest = seeded_digest(F.col("doc_id"), F.col("whole"), seed).alias("digest")
    partial = materialize(join_hot(narrow, open_leaves, list(LEAF)).select(*LEAF, digest, "n_tokens"))
    cut = cutoffs(partial, budgets.filter("rest > 0").select(*LEAF, "rest"))
    return narrow, materialize(budgets.join(cut, list(LEAF), "left").select(*LEAF, "tokens", "budget", "whole", "cutoff"))


def times_taken(narrow: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Narrow rows with their leaf's columns and ``times``: in how many epochs the document is taken."""
    inside = seeded_digest(F.col("doc_id"), F.col("whole"), seed) <= F.col("cutoff")
    return join_hot(narrow, leaves, list(LEAF)).withColumn("times", F.col("whole") + F.coalesce(inside, F.lit(False)).cast("int"))


def selection(docs: DataFrame, fraction: float = 0.6, max_epochs: int = 2, seed: int = 7, tokens: Column | None = None) -> DataFrame:
    """doc_id, epoch, leaf, n_tokens and the leaf's budget for every document and epoch taken."""
    narrow, leaves = plan(docs, fraction, max_epochs, seed, tokens)
    taken = times_taken(narrow, leaves, seed).filter("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    return taken.select("doc_id", "epoch", *LEAF, "n_tokens", F.col("budget").alias("leaf_budget"), F.col("tokens").alias("leaf_tokens"))


def mix(docs: DataFrame, fraction: float = 0.6, max_epochs: int = 1, seed: int = 7, tokens: Column | None = None) -> DataFrame:
    """The selected documents with all their columns; a document taken in several epochs stands as often."""
    narrow, leaves = plan(docs, fraction, max_epochs, seed, tokens)
    key = ["doc_id", "lang", "source"]
    times = materialize(times_taken(narrow, leaves, seed).groupBy(*key).agg(F.max("times").alias("times")))
    leaf = leaf_columns(docs)
    on = {"doc_id": docs["doc_id"], "lang": leaf["lang"], "source": leaf["source"]}
    mixed = None
    for epoch in range(max_epochs):
        part = keep_rows(docs, times.withColumn("keep", F.col("times") > epoch), on)
        mixed = part if mixed is None else mixed.unionByName(part)
    return mixed


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN source IN ('src1','src2','src3','src4','src5','src6','src7','src8','src9')
      THEN 'curated' ELSE 'community' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE * 2 AS cap FROM docs GROUP BY ALL),
langs AS (SELECT domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'es' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM leaf GROUP BY ALL),
domains AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'crawl' THEN 2.0 WHEN 'curated' THEN 5.0 ELSE 3.0 END::DOUBLE AS w FROM langs GROUP BY ALL),
d1 AS (SELECT *, ((SELECT floor(sum(tokens) * 0.6::DOUBLE)::DOUBLE FROM leaf) - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM domains),
d2 AS (SELECT domain, coalesce(least(cap, w * max(CASE WHEN cap / w > level THEN level END) OVER ()), cap) AS budget FROM d1),
l1 AS (SELECT l.*, (d.budget - coalesce(sum(l.cap) OVER (PARTITION BY l.domain ORDER BY l.cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (PARTITION BY l.domain ORDER BY l.cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM langs l JOIN d2 d USING (domain)),
l2 AS (SELECT domain, lang, coalesce(least(cap, w * max(CASE WHEN cap / w > level THEN level END) OVER (PARTITION BY domain)), cap) AS budget FROM l1),
s1 AS (SELECT s.*, (l.budget - coalesce(sum(s.cap) OVER (PARTITION BY s.domain, s.lang ORDER BY s.cap, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / count(*) OVER (PARTITION BY s.domain, s.lang ORDER BY s.cap, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM leaf s JOIN l2 l USING (domain, lang)),
s2 AS (SELECT domain, lang, source, tokens, floor(coalesce(least(cap, max(CASE WHEN cap > level THEN level END) OVER (PARTITION BY domain, lang)), cap) + 1e-6)::BIGINT AS budget FROM s1),
b AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE budget // tokens END AS whole, CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM s2),
ranked AS (SELECT d.*, b.tokens, b.budget, b.whole, b.rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY ('0x' || substr(md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead
  FROM docs d JOIN b USING (domain, lang, source)),
taken AS (SELECT *, whole + CASE WHEN coalesce(ahead, 0) < rest THEN 1 ELSE 0 END AS n FROM ranked)
SELECT doc_id, unnest(range(0, n))::INTEGER AS epoch, domain, lang, source, n_tokens::BIGINT AS n_tokens, budget AS leaf_budget, tokens AS leaf_tokens
FROM taken WHERE n > 0
"""
