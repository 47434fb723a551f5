"""Registered queries: each operator over the derived registry universe or the text tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import analytics, changefeed, evaluate, feed, gates, harvest, indexes, listings, resolve
from ..sources.schemas import MAPPING_COLUMNS
from . import universe as U

AS_OF, SOURCE = "2026-09-01", "registry"
AVIATION_TICKERS, AVIATION_NEEDLES = ["TAAA", "TEAA"], ["RING"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def joined(column: str) -> Column:
    """Arrays as text, so that results compare across engines."""
    return F.coalesce(F.array_join(column, "|"), F.lit("")).alias(column)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; a temporary one only where none is set and Spark is local."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, short in plans, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/world_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class World:
    """The universe with the usual preparation steps. Inputs, listings and decisions are stored, since every report reads them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = U.Universe(spark, sf_dir)

    @cached_property
    def aircraft(self) -> DataFrame:
        return stored(self.t["aircraft"])

    @cached_property
    def filled(self) -> DataFrame:
        return listings.fill_addresses(U.listed(self.t), U.addresses(self.t))

    @cached_property
    def companies(self) -> DataFrame:
        return stored(listings.apply_aliases(self.filled, self.t["aliases"]))

    @cached_property
    def primary(self) -> DataFrame:
        return listings.primary_listings(self.companies)

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return U.gold(self.t)

    @cached_property
    def evidence(self) -> resolve.Evidence:
        t = self.t
        return resolve.Evidence(self.companies, t["subsidiaries"], t["edgar_hits"], t["licences"], t["overrides"], t["unpublished"])

    @cached_property
    def _decided(self) -> DataFrame:
        return stored(resolve.decide(self.aircraft, self.evidence, SOURCE))

    def decided(self) -> DataFrame:
        return self._decided

    def published(self) -> DataFrame:
        rows = resolve.published(self.decided(), AS_OF)
        return gates.annotate_aviation_issuer(rows, AVIATION_TICKERS, AVIATION_NEEDLES)

    def review(self) -> DataFrame:
        return resolve.review_queue(self.decided(), AS_OF)

    def trusts(self) -> DataFrame:
        return resolve.unresolved(self.decided(), AS_OF).filter("reason = 'trustee'")


_worlds: dict[tuple[str, str], World] = {}


def world(spark: SparkSession, sf_dir: str) -> World:
    """The world of a folder; one at a time is kept."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _worlds:
        forget()
        _worlds[key] = World(spark, sf_dir)
    return _worlds[key]


def forget() -> None:
    """Drop what earlier queries have stored, so that the next one starts cold."""
    _worlds.clear()


@query
def normalize_names(spark, sf_dir):
    norm = E.normalize_name(F.col("registrant_name"))
    return world(spark, sf_dir).aircraft.select("n_number", norm.alias("norm"), E.distinctive_core(norm).alias("core"))


@query
def normalize_addresses(spark, sf_dir):
    key = E.normalize_address(F.col("street"), F.col("city"), F.col("state"))
    return world(spark, sf_dir).aircraft.select("n_number", key.alias("address"))


@query
def canonical_keys(spark, sf_dir):
    return world(spark, sf_dir).t["edgar_hits"].select(
        "ord",
        E.canonical_n_number(F.col("n_number")).alias("n_number"),
        E.pad_cik(F.col("cik")).alias("cik"),
        E.canonical_icao24(F.col("accession")).alias("icao24"),
    )


@query
def corporate_filter_reasons(spark, sf_dir):
    return world(spark, sf_dir).aircraft.select("n_number", F.coalesce(E.corporate_reason(F.col), F.lit("")).alias("reason"))


@query
def classify_registrants(spark, sf_dir):
    kind = E.classify_registrant(F.col("registrant_name"), F.trim("type_registrant") == "1", F.col("fractional_owner"))
    return world(spark, sf_dir).aircraft.select("n_number", kind.alias("class"))


@query
def primary_listings(spark, sf_dir):
    return world(spark, sf_dir).primary.select("cik", "ticker", "name", "exchange")


@query
def omitted_preferred(spark, sf_dir):
    return listings.omitted_preferred_only(world(spark, sf_dir).companies).select("cik", "ticker")


@query
def fill_addresses(spark, sf_dir):
    return world(spark, sf_dir).filled.select("ord", "cik", "ticker", "street", "city", "state", joined("former_names"))


@query
def apply_aliases(spark, sf_dir):
    return world(spark, sf_dir).companies.select("ord", "cik", "ticker", joined("former_names"))


def _hits(index: DataFrame) -> DataFrame:
    return index.select("key", joined("tickers"), "hit.ticker", "hit.cik")


@query
def name_index(spark, sf_dir):
    return _hits(indexes.name_index(world(spark, sf_dir).primary))


@query
def subsidiary_index(spark, sf_dir):
    w = world(spark, sf_dir)
    return _hits(indexes.subsidiary_index(w.t["subsidiaries"], w.primary))


@query
def address_index(spark, sf_dir):
    w = world(spark, sf_dir)
    return _hits(indexes.address_index(w.primary, w.t["subsidiaries"]))


@query
def corroboration(spark, sf_dir):
    w = world(spark, sf_dir)
    index = indexes.subsidiary_index(w.t["subsidiaries"], w.primary)
    verdict = E.name_match_corroborated(F.col("key"), F.col("hit.name"), F.col("hit.ticker"))
    return index.select("key", "hit.ticker", verdict.alias("corroborated"))


@query
def resolve_published(spark, sf_dir):
    return world(spark, sf_dir).published().drop("aviation_issuer")


@query
def resolve_review(spark, sf_dir):
    return world(spark, sf_dir).review()


@query
def resolve_conflicts(spark, sf_dir):
    w = world(spark, sf_dir)
    return resolve.conflicts(w.decided(), w.evidence).select("n_number", "registrant_name", joined("tickers"), "method")


@query
def resolve_unresolved(spark, sf_dir):
    return resolve.unresolved(world(spark, sf_dir).decided(), AS_OF)


@query
def resolve_funnel(spark, sf_dir):
    return resolve.funnel(world(spark, sf_dir).decided())


@query
def resolve_by_method(spark, sf_dir):
    return world(spark, sf_dir).published().groupBy("match_method").agg(F.count("*").alias("tails"), F.countDistinct("ticker").alias("tickers"))


@query
def aviation_issuer(spark, sf_dir):
    return world(spark, sf_dir).published().select("n_number", "ticker", "aviation_issuer")


@query
def flight_departments(spark, sf_dir):
    live = world(spark, sf_dir).published().withColumn("deleted_at", F.lit(None).cast("long"))
    return feed.flight_departments(live).select("n_number", "ticker", "fleet_size")


def _feed_rows(rows: DataFrame, as_of: str, fleet: int) -> DataFrame:
    """Feed rows from the latest order of each customer."""
    status = F.when(F.col("o_custkey") % 50 == 0, F.col("o_orderstatus")).otherwise(F.lit(""))
    values = {
        "n_number": F.concat(F.lit("N"), F.col("o_custkey").cast("string")),
        "ticker": F.col("ticker"),
        "cik": F.lpad((F.col("o_custkey") % 7).cast("string"), 10, "0"),
        "registrant_name": F.concat(F.lit("OWNER "), F.col("o_custkey").cast("string"), status),
        "match_method": F.lit("exact_legal_name"),
        "as_of_date": F.lit(as_of),
        "fleet_size": F.lit(fleet).cast("long"),
        "aviation_issuer": F.lit(False),
    }
    return rows.filter("rn = 1").select(*(values.get(c, F.lit("")).alias(c) for c in MAPPING_COLUMNS), "o_custkey")


def _feeds(spark, sf_dir):
    t = U.Universe(spark, sf_dir)
    gone = F.when(F.col("o_custkey") % 40 == 0, F.lit(1_700_000_000)).cast("long")
    old = _feed_rows(t["feed_old"], "2026-08-31", 1).withColumn("deleted_at", gone).drop("o_custkey")
    return old, _feed_rows(t["feed_new"], AS_OF, 2).drop("o_custkey")


@query
def scd_changelog(spark, sf_dir):
    return feed.changelog(feed.diff(*_feeds(spark, sf_dir)), AS_OF)


@query
def scd_current(spark, sf_dir):
    old, new = _feeds(spark, sf_dir)
    now = feed.next_current(feed.match(old, new), 1_800_000_000)
    return now.select("n_number", "ticker", "registrant_name", "fleet_size", "as_of_date", "deleted_at")


@query
def scd_change_counts(spark, sf_dir):
    return feed.diff(*_feeds(spark, sf_dir)).groupBy("change").agg(F.count("*").alias("n"))


@query
def changelog_for_day(spark, sf_dir):
    return feed.changelog_for(scd_changelog(spark, sf_dir), AS_OF)


@query
def lookup(spark, sf_dir):
    old, new = _feeds(spark, sf_dir)
    now = feed.next_current(feed.match(old, new), 1_800_000_000)
    return feed.lookup(now, " n-11.").select("n_number", "ticker", "registrant_name")


def _two_days(spark, sf_dir) -> feed.Feed:
    """A feed of its own in the shared folder, to which the older and the newer rows were published one after the other."""
    old, new = _feeds(spark, sf_dir)
    kept = feed.Feed(spark, f"{shared_folder(spark)}/feed_{uuid.uuid4().hex}")
    rest = [spark.createDataFrame([], kept.TABLES[t]) for t in ("review_queue", "unresolved_trusts")]
    kept.publish("2026-08-31", "2026-08-31T06:00:00Z", 1_700_000_000, old.drop("deleted_at"), *rest)
    kept.publish(AS_OF, f"{AS_OF}T06:00:00Z", 1_800_000_000, new, *rest)
    return kept


@query
def feed_after_two_days(spark, sf_dir):
    """The current table of a feed after two publications, read from its buckets."""
    now = _two_days(spark, sf_dir).table("mappings_current")
    return now.select("n_number", "ticker", "registrant_name", "fleet_size", "as_of_date", "deleted_at")


@query
def feed_change_records(spark, sf_dir):
    """The change feed of the same two publications."""
    records = changefeed.changes(spark, _two_days(spark, sf_dir).root)
    image = {c: F.get_json_object("after", f"$.{c}").alias(c) for c in ("ticker", "registrant_name", "deleted_at", "change", "recorded_at")}
    was = F.get_json_object("before", "$.ticker").alias("ticker_before")
    return records.select("version", F.col("table").alias("source"), "op", "key", "as_of_date", was, *image.values())


@query
def eval_gold(spark, sf_dir):
    w = world(spark, sf_dir)
    return evaluate.evaluate_gold(w.gold, w.published(), w.aircraft, w.trusts())


@query
def eval_rubric(spark, sf_dir):
    w = world(spark, sf_dir)
    return evaluate.evaluate_rubric(w.t["rubric"], w.published(), w.aircraft)


@query
def scorecard_coverage(spark, sf_dir):
    return evaluate.coverage(world(spark, sf_dir).published().withColumn("deleted_at", F.lit(None).cast("long")))


@query
def gold_miss_buckets(spark, sf_dir):
    w = world(spark, sf_dir)
    return analytics.gold_miss_buckets(w.gold["companies"], w.published(), w.review(), w.aircraft, w.trusts())


@query
def name_precision(spark, sf_dir):
    w = world(spark, sf_dir)
    return analytics.name_precision(w.gold["companies"], w.published(), w.aircraft)


@query
def alias_reasons(spark, sf_dir):
    w = world(spark, sf_dir)
    names = indexes.brief(indexes.name_rows(w.primary))
    return analytics.alias_reasons(w.gold["companies"], names, w.aircraft, w.published(), w.review(), w.t["unpublished"])


@query
def alias_candidates(spark, sf_dir):
    """The names whose alias would add tails, with these tails."""
    return analytics.alias_candidates(alias_reasons(spark, sf_dir)).select("ticker", "name", joined("tails"))


@query
def unpublished_fps(spark, sf_dir):
    w = world(spark, sf_dir)
    # Pairs of the rubric: those of the unpublished list are suppressed before publication.
    return analytics.unpublished_false_positives(w.t["rubric"].filter("must_not_ticker <> ''"), w.published())


@query
def harvest_stats(spark, sf_dir):
    return analytics.harvest_analysis(world(spark, sf_dir).t["edgar_hits"])


@query
def top_tickers(spark, sf_dir):
    return analytics.top_tickers(world(spark, sf_dir).published())


@query
def harvest_top_tickers(spark, sf_dir):
    return analytics.top_tickers(world(spark, sf_dir).t["edgar_hits"].filter("ticker <> ''"))


@query
def sample_addresses(spark, sf_dir):
    """The stratified sample with the registry's addresses."""
    sample = stratified_sample(spark, sf_dir).select("n_number", "match_method")
    return analytics.with_registry_address(sample, world(spark, sf_dir).aircraft).select("n_number", "match_method", "street", "city", "state")


@query
def stratified_sample(spark, sf_dir):
    quotas = {"exact_legal_name": 20, "ex21_subsidiary": 10, "edgar_nnumber": 15}
    picked = analytics.stratified_sample(world(spark, sf_dir).published(), "match_method", "n_number", quotas, 43)
    return picked.select("n_number", "match_method", "pick")


@query
def stress_sample(spark, sf_dir):
    w = world(spark, sf_dir)
    rows = w.published()
    listed = w.primary.select("cik", "exchange")
    sampled = rows.filter("match_method = 'edgar_nnumber'")
    return analytics.stress_sample(rows.join(listed, "cik"), sampled).select("n_number", "core_len", "n_tokens", "is_otc")


@query
def review_default_verdicts(spark, sf_dir):
    w = world(spark, sf_dir)
    explicit = w.t["unpublished"].select("n_number", F.lit("operator_tp").alias("verdict"))
    return analytics.default_verdicts(w.review(), explicit)


@query
def verdict_merge(spark, sf_dir):
    w = world(spark, sf_dir)
    rows = w.published().select("n_number", "match_method")
    known = w.t["unpublished"].select("n_number", F.lit(True).alias("bad"))
    verdicts = rows.select("n_number").join(known, "n_number", "left").select(
        "n_number", F.when(F.col("bad"), "namesake").otherwise("true_positive").alias("verdict")
    )
    return analytics.merge_verdicts(rows, verdicts, "match_method")


@query
def reopen_rule(spark, sf_dir):
    misses = world(spark, sf_dir).decided().select(F.col("dest").alias("reason"), "d.ticker")
    return analytics.reopen_rule(misses)


@query
def validate_rubric(spark, sf_dir):
    return gates.rubric_violations(world(spark, sf_dir).t["rubric"])


def _spliced(spark, sf_dir) -> DataFrame:
    """The whole text of every document, null as empty, with mentions at its front, quarter, middle and end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body, doc = F.coalesce("text", F.lit("")), F.coalesce("doc_id", F.lit(0))
    n = F.length(body)

    def piece(start: Column, end: Column) -> Column:
        return F.substring(body, start + 1, end - start)

    def mention(words: str, low: int, count: int) -> Column:
        return F.concat(F.lit(f" {words} N"), (low + doc % count).cast("string"), F.lit(" "))

    quarter, middle = F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int")
    text = F.concat(
        mention("The corporate aircraft", 100, 900), piece(F.lit(0), quarter), mention("dry lease of", 3000, 6000), piece(quarter, middle),
        mention("bond series", 10000, 80000), piece(middle, n), mention("n-number", 2000, 7),
    )
    return docs.select("doc_id", text.alias("text"))


@query
def edgar_extract(spark, sf_dir):
    """Registration numbers of the registry's aircraft in whole documents."""
    return harvest.extract_hits(_spliced(spark, sf_dir), world(spark, sf_dir).aircraft)


@query
def edgar_extract_documents(spark, sf_dir):
    """All registration numbers in whole documents."""
    return harvest.extract_hits(_spliced(spark, sf_dir))


@query
def html_plain_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = F.col("html")
    return pages.select(
        "page_id", F.length(harvest.strip_tags(html)).cast("long").alias("n_chars"), F.md5(harvest.to_plain_text(html)).alias("text_md5")
    )


@query
def keyword_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", harvest.keyword_hit(F.coalesce("text", F.lit(""))).alias("keyword"))


@query
def valid_dates(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        "o_orderkey",
        E.is_calendar_day(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_ok"),
        E.is_calendar_day(F.date_format("o_orderdate", "yyyy/MM/dd")).alias("slash_ok"),
        E.is_utc_instant(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("instant_ok"),
    )
