"""Sampling, census and scorecard reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import census_reason, classify_registrant, corporate_reason, distinctive_core, normalize_name


def seeded_order(key: Column, seed: int) -> Column:
    """A portable pseudo-random order: the digest of seed and key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key))


def harvest_analysis(hits: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """n_number, ciks, hits, and whether one company alone claims the tail; an empty allow-list lets all in."""
    rows = hits if allow is None or not allow.limit(1).count() else hits.join(allow.select("n_number").distinct(), "n_number", "left_semi")
    return rows.groupBy("n_number").agg(F.countDistinct("cik").alias("ciks"), F.count("*").alias("hits")).withColumn("unique_cik", F.col("ciks") == 1)


def top_tickers(rows: DataFrame, k: int = 15) -> DataFrame:
    return rows.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(k)


def stratified_sample(rows: DataFrame, stratum: str, key: str, quotas: dict[str, int], seed: int) -> DataFrame:
    """The first rows of each stratum in seeded order, as many as its quota; strata without quota give none."""
    quota = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]), F.col(stratum)), F.lit(0))
    order = Window.partitionBy(stratum).orderBy(seeded_order(F.col(key), seed), key)
    # Spark filters by rank inside each task before the shuffle.
    ranked = rows.withColumn("pick", F.row_number().over(order)).filter(F.col("pick") <= max([0, *quotas.values()]))
    return ranked.filter(F.col("pick") <= quota)


def stress_sample(rows: DataFrame, sampled: DataFrame, k: int = 10) -> DataFrame:
    """The hardest unsampled rows: shortest core, fewest tokens, exchange-listed first, then tail."""
    norm = normalize_name(F.col("registrant_name"))
    core = F.regexp_replace(distinctive_core(norm), " ", "")
    left = rows.join(sampled.select("n_number"), "n_number", "left_anti")
    scored = left.withColumn("core_len", F.length(core)).withColumn("n_tokens", F.when(norm == "", 0).otherwise(F.size(F.split(norm, " "))))
    return scored.withColumn("is_otc", (F.upper("exchange") == "OTC").cast("int")).orderBy("core_len", "n_tokens", "is_otc", "n_number").limit(k)


def with_registry_address(sample: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Sample rows with street, city and state of their tail."""
    place = aircraft.groupBy("n_number").agg(F.min(F.struct("street", "city", "state")).alias("p")).select("n_number", "p.*")
    return sample.withColumn("n_number", F.trim("n_number")).join(place, "n_number", "left")


def gold_names(companies: DataFrame) -> DataFrame:
    """ticker, raw registrant name, norm; with the company name where one is given."""
    given = F.filter(F.array("company_name"), lambda x: x != "")
    names = companies.select(F.upper("ticker").alias("ticker"), "cik", F.explode(F.concat("registrant_names", given)).alias("name"))
    return names.withColumn("norm", normalize_name(F.col("name"))).filter("norm <> ''")


#: Least length of a gold name that may stand inside a longer name, and so the length of the grams that index it.
GRAM = 6


def _grams(text: Column) -> Column:
    """The distinct stretches of GRAM characters; none of shorter texts."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(places, lambda k: F.substring(text, k, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def names_within(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(norm, text) of all pairs where the text is the name, or holds it and the name has GRAM characters or more.

    ``texts``: text; ``names``: norm. Both are made distinct. A text that holds a name holds each of the name's grams, so
    each name waits at one gram alone, the one that the fewest texts hold, and a text meets the names that wait at
    its own grams: joins by equality, with about as many rows as the texts have characters. Names with a gram that no text
    holds are in no text.
    """
    texts, names = texts.select("text").distinct(), names.select("norm").distinct()
    held = texts.select("text", F.explode(_grams(F.col("text"))).alias("gram"))
    asked = names.select("norm", F.explode(_grams(F.col("norm"))).alias("gram"))
    counts = held.join(asked.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = asked.join(counts, "gram", "left").groupBy("norm").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    waiting = rarest.filter("r.n > 0").select("norm", "r.gram")
    inside = held.join(waiting, "gram").filter(F.col("text").contains(F.col("norm"))).select("norm", "text")
    equal = texts.join(names, F.col("text") == F.col("norm")).filter(F.length("norm") < GRAM).select("norm", "text")
    return inside.unionByName(equal)


def gold_miss_buckets(companies: DataFrame, published: DataFrame, review: DataFrame, aircraft: DataFrame, trusts: DataFrame) -> DataFrame:
    """ticker, bucket and counters: where each gold company got stuck, by precedence.

    Names meet aircraft by equal norm. Unresolved trusts may also contain a name of 6 or more characters. A name shared by many
    companies and many aircraft is counted by name: a tail under one norm alone, as all but odd ones are, counts for its norm, and
    only tails under several norms are paired with tickers.
    """
    names = gold_names(companies).select("ticker", "norm").distinct()
    keyed = aircraft.select("n_number", normalize_name(F.col("registrant_name")).alias("norm"), census_reason(F.col).alias("airframe"))
    on_feed = published.groupBy("ticker").agg(F.count("*").alias("published_tails"))
    held = review.groupBy("ticker").agg(F.count("*").alias("review_n"))
    keyed = keyed.filter("norm <> ''")
    tails = keyed.groupBy("n_number").agg(F.min("norm").alias("norm"), F.max("norm").alias("last"), F.min("airframe").alias("airframe"))
    passed = F.count(F.when(F.col("airframe").isNull(), 1)).alias("airframe_pass_n")
    by_norm = tails.filter("norm = last").groupBy("norm").agg(F.count("*").alias("master_n"), passed)
    several = keyed.join(tails.filter("norm <> last").select(F.col("n_number").alias("odd")), F.col("n_number").eqNullSafe(F.col("odd")), "left_semi")
    pairs = names.join(several, "norm").groupBy("ticker", "n_number").agg(F.min("airframe").alias("airframe"))
    counts = names.join(by_norm, "norm").drop("norm").unionByName(pairs.groupBy("ticker").agg(F.count("*").alias("master_n"), passed))
    met = counts.groupBy("ticker").agg(F.sum("master_n").alias("master_n"), F.sum("airframe_pass_n").alias("airframe_pass_n"))
    trust = trusts.select(normalize_name(F.col("registrant_name")).alias("text"))
    within = names_within(trust, names).select("norm").distinct()
    in_trust = names.join(within, "norm", "left_semi").select("ticker").distinct().withColumn("in_trust", F.lit(True))
    every = companies.select(F.upper("ticker").alias("ticker")).distinct()
    for part in (on_feed, held, met, in_trust):
        every = every.join(part, "ticker", "left")
    counted = every.fillna(0)
    bucket = (
        F.when(F.col("published_tails") > 0, "published")
        .when(F.col("review_n") > 0, "review_queue")
        .when(F.col("airframe_pass_n") > 0, "master_name_not_published")
        .when(F.col("master_n") > 0, "airframe_filtered")
        .when(F.col("in_trust"), "trust_name_only")
        .otherwise("no_master_legal_name")
    )
    fail = (F.col("master_n") - F.col("airframe_pass_n")).alias("airframe_fail_n")
    return counted.select("ticker", bucket.alias("bucket"), "published_tails", "review_n", "master_n", "airframe_pass_n", fail)


def name_precision(companies: DataFrame, published: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Name precision over eligible corporate aircraft; empty keys do not count."""
    from .evaluate import name_hits

    eligible = aircraft.filter(corporate_reason(F.col).isNull()).filter(
        classify_registrant(F.col("registrant_name"), F.trim("type_registrant") == "1", F.col("fractional_owner")) == "eligible"
    )
    hits = name_hits(companies, published, eligible).filter("norm <> ''")
    tp, fp = F.count(F.when(F.col("got") == F.col("expected"), 1)), F.count(F.when(F.col("got") != F.col("expected"), 1))
    return hits.agg(F.count("*").alias("hits"), tp.alias("tp"), fp.alias("fp")).withColumn(
        "precision", F.when(F.col("tp") + F.col("fp") == 0, 1.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fp")))
    )


#: Over so many parts the tails of one name are dealt where they meet its companies.
DEALT = 16


def alias_reasons(companies: DataFrame, names: DataFrame, aircraft: DataFrame, published: DataFrame, review: DataFrame, forbidden: DataFrame) -> DataFrame:
    """ticker, cik, name, n_number, reason: why a gold registrant name's tail needs no alias, or ``addable``.

    ``names`` is the brief name index. The reasons are an ordered chain. The result has a row for each pair of a company and a
    tail of one name, so all that is known of a tail or of a company is joined before they meet; nothing is joined or
    shuffled after that. The tails of a name are dealt over ``DEALT`` parts, which each hold its companies.
    """
    raw = companies.select(F.upper("ticker").alias("ticker"), "cik", F.explode(F.array_distinct("registrant_names")).alias("name"))
    known = names.select(F.col("key").alias("norm"), "n", "only")
    state = F.when((F.col("n") == 1) & (F.col("only") == F.col("ticker")), "already_in_name_index").when(F.col("n").isNotNull(), "uniqueness_collision").otherwise("addable")
    keyed = (
        raw.withColumn("norm", normalize_name(F.col("name")))
        .filter("norm <> ''")
        .join(known, "norm", "left")
        .select("ticker", "cik", "name", "norm", state.alias("state"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("part"))
    )
    kind = classify_registrant(F.col("registrant_name"), F.trim("type_registrant") == "1", F.col("fractional_owner"))
    tails = aircraft.select("n_number", normalize_name(F.col("registrant_name")).alias("norm"), census_reason(F.col).alias("airframe"), kind.alias("class"))
    own = F.when(F.col("airframe").isNotNull(), F.concat(F.lit("airframe:"), "airframe")).when(F.col("class") != "eligible", F.concat(F.lit("class:"), "class"))
    looked = (
        tails.select("n_number", "norm", own.alias("own"))
        .join(published.select("n_number", F.col("ticker").alias("pub")), "n_number", "left")
        .join(review.select("n_number", F.lit(True).alias("held")).distinct(), "n_number", "left")
        .join(forbidden.select("n_number", F.upper("must_not_ticker").alias("barred")), "n_number", "left")
        .withColumn("part", F.coalesce(F.pmod(F.xxhash64("n_number"), F.lit(DEALT)), F.lit(0)).cast("int"))
    )
    reason = (
        F.when(F.col("own").isNotNull(), F.col("own"))
        .when(F.col("barred") == F.col("ticker"), "unpublished_suppress")
        .when(F.col("pub") == F.col("ticker"), "already_published_same_ticker")
        .when(F.col("pub").isNotNull(), "published_other_ticker")
        .when(F.col("held"), "review_queue")
        .otherwise(F.col("state"))
    )
    return looked.join(keyed, ["norm", "part"]).select("ticker", "cik", "name", "n_number", reason.alias("reason"))


def alias_candidates(reasons: DataFrame) -> DataFrame:
    """ticker, name, tails (sorted): names whose alias would add tails."""
    addable = reasons.filter("reason = 'addable'")
    return addable.groupBy("ticker", F.upper("name").alias("name")).agg(F.array_sort(F.collect_set("n_number")).alias("tails"))


def unpublished_false_positives(forbidden: DataFrame, published: DataFrame) -> DataFrame:
    """Forbidden (tail, ticker) pairs that are published."""
    barred = forbidden.select("n_number", F.upper("must_not_ticker").alias("ticker")).distinct()
    return published.join(barred, ["n_number", "ticker"]).select("n_number", "ticker")


class CoverageError(ValueError):
    """Verdicts and sample do not cover each other."""


def merge_verdicts(sample: DataFrame, verdicts: DataFrame, stratum: str) -> DataFrame:
    """stratum, verdict, n; every sampled tail must have a verdict and every verdict a sampled tail."""
    missing = sample.join(verdicts, "n_number", "left_anti").count()
    extra = verdicts.join(sample, "n_number", "left_anti").count()
    if missing or extra:
        raise CoverageError(f"{missing} sampled tails without verdict, {extra} verdicts outside the sample")
    return sample.join(verdicts, "n_number").groupBy(F.col(stratum).alias("stratum"), "verdict").agg(F.count("*").alias("n"))


#: Registrants that are a generic aviation word.
GENERIC_REGISTRANTS = ("HELICOPTERS INC", "TURBINES LTD")


def default_verdicts(review: DataFrame, explicit: DataFrame) -> DataFrame:
    """n_number, verdict: the explicit one, else the rule chain."""
    name = F.upper(F.coalesce("registrant_name", F.lit("")))
    rule = (
        F.when(F.col("match_method") == "address_cluster", "hold_address_cluster")
        .when(name.isin(*GENERIC_REGISTRANTS), "hold_generic_ex21")
        .when(F.arrays_overlap(F.split(name, r"\s+"), F.array(F.lit("HOLDING"), F.lit("HOLDINGS"))), "hold_identity_suffix")
        .otherwise("hold_uncorroborated_ex21")
    )
    return review.join(explicit.select("n_number", F.col("verdict").alias("given")), "n_number", "left").select(
        "n_number", F.coalesce("given", rule).alias("verdict")
    )


def reopen_rule(misses: DataFrame, least: int = 3) -> DataFrame:
    """reason, issuers, verdict: a reason is reopened once that many distinct issuers suffer from it."""
    return misses.groupBy("reason").agg(F.countDistinct("ticker").alias("issuers")).withColumn(
        "verdict", F.when(F.col("issuers") >= least, "REOPEN").otherwise("KILLED")
    )
