"""The resolution cascade: one lazy plan that decides every aircraft by strict precedence of evidence.

All evidence is aggregated to one row per key first, so the joins are many-to-one. One CASE expression
then picks the destination; the outputs are filters of the one decided DataFrame, which callers persist.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dicts as D
from ..functions.exprs import (
    canonical_n_number,
    classify_registrant,
    corporate_reason,
    name_match_corroborated,
    normalize_address,
    normalize_name,
    pad_cik,
)
from ..sources.schemas import MAPPING_COLUMNS, TRUST_COLUMNS
from .indexes import address_rows, brief, name_index, name_rows, subsidiary_index, subsidiary_rows
from .listings import primary_listings


@dataclass
class Evidence:
    """Inputs of the cascade besides the aircraft; any of them may be empty."""

    companies: DataFrame
    subsidiaries: DataFrame
    edgar_hits: DataFrame
    licences: DataFrame
    overrides: DataFrame
    unpublished: DataFrame


def last_per_tail(rows: DataFrame, *columns: str) -> DataFrame:
    """Dictionaries: the last row of a tail wins."""
    return rows.groupBy("n_number").agg(F.max_by(F.struct(*columns), "ord").alias("r")).select("n_number", "r.*")


def edgar_evidence(hits: DataFrame, aircraft: DataFrame, primary: DataFrame) -> DataFrame:
    """n_number, tickers, first: filing hits of known tails, by tail. The first in input order stands for all."""
    usable = hits.filter("keyword_hit").withColumn("n_number", canonical_n_number(F.col("n_number")))
    known = usable.join(aircraft.select("n_number").distinct(), "n_number", "left_semi")
    listed = primary.select(F.col("cik").alias("p_cik"), F.col("ticker").alias("p_ticker"), F.col("name").alias("p_name"))
    padded = known.withColumn("p_cik", pad_cik(F.coalesce("cik", F.lit(""))))
    named = padded.join(listed, "p_cik", "left").withColumn("t", F.upper(F.coalesce(F.when(F.col("ticker") != "", F.col("ticker")), "p_ticker")))
    first = F.struct("t", "p_cik", F.coalesce("p_name", F.lit("")).alias("name"), F.coalesce("filing_url", F.lit("")).alias("url"))
    return (
        named.filter("t is not null")
        .groupBy("n_number")
        .agg(F.array_sort(F.collect_set("t")).alias("edgar_tickers"), F.min_by(first, "ord").alias("edgar"))
    )


#: The indexes whose list of tickers a conflict may name instead of holding it.
NAMES, SUBSIDIARIES = "names", "subsidiaries"


def licence_evidence(licences: DataFrame, names: DataFrame, subs: DataFrame) -> DataFrame:
    """n_number -> the ordered fold over its licences (by licence id): struct licence(outcome, tickers, many, one).

    ``names`` and ``subs`` are brief indexes. The first licence whose key has several tickers is a conflict; so is a later licence
    with another ticker than the first hit. Names are looked up before subsidiaries. Both events are minima over the
    licence order, so the fold is an aggregate: the first ambiguous one, the first hit, and the first hit that differs.
    An ambiguous one is told by its key; ``tickers`` are the two that differ.
    """
    usable = licences.filter("n_number <> ''").filter(
        classify_registrant(F.col("licensee_name"), F.lit(False), F.lit(False)) != "trustee"
    )
    keyed = usable.withColumn("key", normalize_name(F.col("licensee_name")))
    by_name = names.select("key", F.col("n").alias("nn"), F.col("hit").alias("nh"))
    by_sub = subs.select("key", F.col("n").alias("sn"), F.col("hit").alias("sh"))
    met = keyed.join(by_name, "key", "left").join(by_sub, "key", "left").withColumn("sub", F.col("nn").isNull())
    met = met.withColumn("n", F.coalesce("nn", "sn")).withColumn("hit", F.coalesce("nh", "sh")).filter("n is not null")
    many, one = F.col("n") > 1, F.col("n") == 1
    event = F.struct("uls_id", "key", "hit", "sub", "licensee_name")
    # The first licence of every ticker: the second smallest is where the tickers first differ.
    each = met.groupBy("n_number", "n", F.when(one, F.col("hit.ticker")).alias("ticker")).agg(
        F.min("uls_id").alias("at"), F.min_by(event, "uls_id").alias("event")
    )
    order = F.array_sort(F.collect_list(F.when(one, F.struct("at", "ticker"))))
    first = each.groupBy("n_number").agg(
        F.min_by("event", F.when(many, F.col("at"))).alias("many"),
        F.min_by("event", F.when(one, F.col("at"))).alias("one"),
        F.get(order, F.lit(1)).alias("differs"),
    )
    ambiguous_first = F.col("many").isNotNull() & (F.col("differs").isNull() | (F.col("many.uls_id") < F.col("differs.at")))
    outcome = F.when(ambiguous_first, "many").when(F.col("differs").isNotNull(), "differs").otherwise("one")
    tickers = F.when(~ambiguous_first & F.col("differs").isNotNull(), F.array_sort(F.array(F.col("one.hit.ticker"), F.col("differs.ticker"))))
    return first.select("n_number", F.struct(outcome.alias("outcome"), tickers.alias("tickers"), "many", "one").alias("licence"))


def _decision(
    dest: str, method: str | Column | None = None, hit: Column | None = None, source: Column | None = None,
    tickers: Column | None = None, reason: str | None = None, index: str | Column | None = None, key: Column | None = None,
) -> Column:
    """One decision; ``hit`` has cik, ticker, name. The tickers of a conflict are given, or are those of ``key`` in ``index``."""
    text = F.lit(None).cast("string")
    part = (lambda k: hit[k]) if hit is not None else (lambda k: text)
    return F.struct(
        F.lit(dest).alias("dest"),
        (F.lit(method) if method else text).alias("method"),
        F.upper(part("ticker")).alias("ticker"),
        part("cik").alias("cik"),
        part("name").alias("company_name"),
        (source if source is not None else text).alias("source_url"),
        (tickers if tickers is not None else F.lit(None).cast("array<string>")).alias("tickers"),
        (F.lit(reason) if reason else text).alias("reason"),
        (text if index is None else F.lit(index) if isinstance(index, str) else index).alias("index"),
        (key if key is not None else text).alias("key"),
    )


def _when(chain: Column | None, condition: Column, decision: Column) -> Column:
    return F.when(condition, decision) if chain is None else chain.when(condition, decision)


def decide(aircraft: DataFrame, evidence: Evidence, faa_source: str, publish_address_cluster: bool = False) -> DataFrame:
    """Aircraft columns plus ``d``: the decision of every corporate aircraft.

    A key may have as many tickers as there are companies, and very many aircraft: no row here holds the list of its
    key, conflicts name it. ``conflicts`` joins the lists.
    """
    primary = primary_listings(evidence.companies)
    names, subs = brief(name_rows(primary)), brief(subsidiary_rows(evidence.subsidiaries, primary))
    places = brief(address_rows(primary, evidence.subsidiaries))
    listed = primary.select(F.col("cik").alias("o_cik"), F.col("name").alias("o_listed"))
    override = (
        last_per_tail(evidence.overrides, "ticker", "cik", "company_name", "citation")
        .withColumn("o_cik", pad_cik(F.col("cik")))
        .join(listed, "o_cik", "left")
        .select(
            "n_number",
            F.struct(
                "cik", "ticker", F.coalesce(F.nullif("company_name", F.lit("")), "o_listed", F.lit("")).alias("name"), "citation"
            ).alias("override"),
        )
    )
    forbidden = last_per_tail(evidence.unpublished, "must_not_ticker").withColumnRenamed("must_not_ticker", "forbidden")
    # The cheap gate on airframes comes before any join.
    corporate = aircraft.filter(corporate_reason(F.col).isNull())
    keyed = corporate.withColumns(
        {
            "class": classify_registrant(F.col("registrant_name"), F.trim("type_registrant") == "1", F.col("fractional_owner")),
            "name_key": normalize_name(F.col("registrant_name")),
            "place_key": normalize_address(F.col("street"), F.col("city"), F.col("state")),
        }
    )
    # Licences decide trustees only.
    trustees = keyed.filter(F.col("class") == "trustee").select("n_number").distinct()
    licences = evidence.licences.join(trustees, "n_number", "left_semi")
    joined = (
        keyed.join(override, "n_number", "left")
        .join(edgar_evidence(evidence.edgar_hits, aircraft, primary), "n_number", "left")
        .join(licence_evidence(licences, names, subs), "n_number", "left")
        .join(forbidden, "n_number", "left")
        .join(names.select(F.col("key").alias("name_key"), F.col("n").alias("name_n"), F.col("hit").alias("name_h")), "name_key", "left")
        .join(subs.select(F.col("key").alias("name_key"), F.col("n").alias("sub_n"), F.col("hit").alias("sub_h")), "name_key", "left")
        .join(places.select(F.col("key").alias("place_key"), F.col("n").alias("place_n"), F.col("hit").alias("place_h")), "place_key", "left")
    )

    def one(n: str | Column) -> Column:
        return F.coalesce((F.col(n) if isinstance(n, str) else n) == 1, F.lit(False))

    def many(n: str | Column) -> Column:
        return F.coalesce((F.col(n) if isinstance(n, str) else n) > 1, F.lit(False))

    source = F.lit(faa_source)
    edgar_hit = F.struct(F.col("edgar.t").alias("ticker"), F.col("edgar.p_cik").alias("cik"), F.col("edgar.name").alias("name"))
    edgar_source = F.when(F.col("edgar.url") != "", F.col("edgar.url")).otherwise(source)
    trustee = F.col("class") == "trustee"
    outcome, licence_hit = F.col("licence.outcome"), F.col("licence.one.hit")
    licence_index = F.when(F.col("licence.many.sub"), SUBSIDIARIES).otherwise(NAMES)
    licence_source = F.concat(F.lit("fcc-uls-aircraft:"), F.col("licence.one.uls_id"))
    licence_ok = ~F.col("licence.one.sub") | name_match_corroborated(
        normalize_name(F.col("licence.one.licensee_name")), licence_hit["name"], licence_hit["ticker"]
    )
    sub_ok = name_match_corroborated(F.col("name_key"), F.col("sub_h.name"), F.col("sub_h.ticker"))
    steps = [
        (F.col("class").isin("fractional", "faa_fractional_flag", "airline", "individual"), _decision("excluded")),
        (F.col("override").isNotNull(), _decision("published", D.MANUAL_OVERRIDE, F.col("override"), F.col("override.citation"))),
        (one(F.size("edgar_tickers")), _decision("published", D.EDGAR_NNUMBER, edgar_hit, edgar_source)),
        (many(F.size("edgar_tickers")), _decision("conflict", D.EDGAR_NNUMBER, tickers=F.col("edgar_tickers"))),
        (trustee & (outcome == "many"), _decision("conflict", D.FCC_LICENSEE_EXACT, index=licence_index, key=F.col("licence.many.key"))),
        (trustee & (outcome == "differs"), _decision("conflict", D.FCC_LICENSEE_EXACT, tickers=F.col("licence.tickers"))),
        (trustee & (outcome == "one") & licence_ok, _decision("published", D.FCC_LICENSEE_EXACT, licence_hit, licence_source)),
        (trustee & (outcome == "one"), _decision("review", D.FCC_LICENSEE_EXACT, licence_hit, licence_source)),
        (trustee, _decision("unresolved", reason="trustee")),
        (F.col("name_key") == "", _decision("unresolved", reason="empty_name")),
        (one("name_n"), _decision("published", D.EXACT_LEGAL_NAME, F.col("name_h"), source)),
        (many("name_n"), _decision("conflict", D.EXACT_LEGAL_NAME, index=NAMES, key=F.col("name_key"))),
        (one("sub_n") & sub_ok, _decision("published", D.EX21_SUBSIDIARY, F.col("sub_h"), F.lit("pudl:exhibit21"))),
        (one("sub_n"), _decision("review", D.EX21_SUBSIDIARY, F.col("sub_h"), F.lit("pudl:exhibit21"))),
        (many("sub_n"), _decision("conflict", D.EX21_SUBSIDIARY, index=SUBSIDIARIES, key=F.col("name_key"))),
        (one("place_n"), _decision("published" if publish_address_cluster else "review", D.ADDRESS_CLUSTER, F.col("place_h"), source)),
    ]
    chain = None
    for condition, decision in steps:
        chain = _when(chain, condition, decision)
    chain = chain.otherwise(_decision("unresolved", reason="unmatched"))
    held = (F.col("d.dest") == "published") & F.coalesce(F.upper("forbidden") == F.col("d.ticker"), F.lit(False))
    decided = joined.withColumn("d", chain).withColumn("dest", F.when(held, "review").otherwise(F.col("d.dest")))
    return decided.select(*aircraft.columns, "class", "dest", "d")


def _mappings(decided: DataFrame, dest: str, as_of: str) -> DataFrame:
    return decided.filter(F.col("dest") == dest).select(
        "n_number", "icao24", "serial", "make", "model",
        "d.ticker", "d.cik", "d.company_name", "registrant_name",
        F.col("d.method").alias("match_method"), F.lit(as_of).alias("as_of_date"), "d.source_url",
    )


def published(decided: DataFrame, as_of: str) -> DataFrame:
    """Published mappings with their fleet size, counted after the gate."""
    rows = _mappings(decided, "published", as_of)
    # Counts are combined before the shuffle; a window would gather every row of a large fleet in one task.
    fleets = rows.groupBy("ticker").agg(F.count("*").alias("fleet_size"))
    return rows.join(fleets, "ticker").withColumn("aviation_issuer", F.lit(False)).select(*MAPPING_COLUMNS)


def review_queue(decided: DataFrame, as_of: str) -> DataFrame:
    return _mappings(decided, "review", as_of)


def conflicts(decided: DataFrame, evidence: Evidence) -> DataFrame:
    """Conflicts with all their tickers; ``evidence`` is that of the decisions."""
    primary = primary_listings(evidence.companies)
    indexes = {NAMES: name_index(primary), SUBSIDIARIES: subsidiary_index(evidence.subsidiaries, primary)}
    names, subs = (rows.select(F.lit(k).alias("index"), "key", F.col("tickers").alias("listed")) for k, rows in indexes.items())
    rows = decided.filter("dest = 'conflict'").select("n_number", "registrant_name", "d.tickers", "d.method", "d.index", "d.key")
    met = rows.join(names.unionByName(subs), ["index", "key"], "left")
    return met.select("n_number", "registrant_name", F.coalesce("tickers", "listed").alias("tickers"), "method")


def unresolved(decided: DataFrame, as_of: str) -> DataFrame:
    return decided.filter("dest = 'unresolved'").select(
        "n_number", "icao24", "make", "model", "registrant_name", "d.reason", F.lit(as_of).alias("as_of_date")
    ).select(*TRUST_COLUMNS)


def funnel(decided: DataFrame) -> DataFrame:
    """Rows by destination, method and reason."""
    return decided.groupBy("dest", F.coalesce("d.method", F.lit("")).alias("method"), F.coalesce("d.reason", F.lit("")).alias("reason")).agg(
        F.count("*").alias("n")
    )
