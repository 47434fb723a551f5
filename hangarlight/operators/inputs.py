"""The inputs of a refresh from files, by source mode: what must be there, what may be missing, and what stands in."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources import dictionaries, filings, registry
from ..sources.modes import Cache, Fetch, Mode, exists, resolve
from ..sources.schemas import ADDRESS, ALIAS, EDGAR_HIT, LICENCE, OVERRIDE, SUBSIDIARY_COLUMNS
from .gates import check_subsidiaries
from .refresh import Inputs

log = logging.getLogger(__name__)

# Names of cached inputs.
TICKERS, SUBSIDIARIES, SUBSIDIARIES_CSV, ADDRESSES, REGISTRY = "company_tickers_exchange.json", "ex21.parquet", "ex21.csv", "sec_addresses.json", "faa-registry.sqlite"


@dataclass
class Sources:
    """Paths of a refresh; ``fetch`` has functions by input name. ``work`` is a folder that all executors share."""

    cache: str
    work: str
    mode: Mode = Mode.FRESH
    fetch: dict[str, Fetch] = field(default_factory=dict)
    registry_zip: str | None = None
    registry_db: str | None = None
    licences_db: str | None = None
    tickers: str | None = None
    subsidiaries: str | None = None
    addresses: str | None = None
    filing_hits: str | None = None
    overrides: str | None = None
    aliases: str | None = None
    gold: str | None = None
    aviation_issuers: str | None = None
    skip_subsidiaries: bool = False


def _optional(path: str | None, what: str) -> str | None:
    """A path that exists; a warning and None for one that does not."""
    if path is not None and exists(path):
        return path
    log.warning("%s is missing: %s", what, path)
    return None


def load_aircraft(spark: SparkSession, at: Sources) -> tuple[DataFrame, str]:
    """(aircraft, path): the named zip, else the named or cached database. The registry is never fetched."""
    cache = Cache(at.cache)
    if at.registry_zip is not None:
        path = resolve(cache, REGISTRY, Mode.OFFLINE, explicit=at.registry_zip)
        return registry.read_zip(spark, path, f"{at.work}/registry"), path
    path = resolve(cache, REGISTRY, Mode.OFFLINE, explicit=at.registry_db)
    return registry.read_sqlite(spark, path), path


def load_companies(spark: SparkSession, at: Sources) -> DataFrame:
    return filings.read_tickers(spark, resolve(Cache(at.cache), TICKERS, at.mode, at.fetch.get(TICKERS), at.tickers))


def load_addresses(spark: SparkSession, at: Sources) -> DataFrame:
    """The named file, else the cached one, else none."""
    path = at.addresses if at.addresses is not None else f"{at.cache}/{ADDRESSES}"
    if at.addresses is None and not exists(path):
        return spark.createDataFrame([], ADDRESS)
    return filings.read_addresses(spark, resolve(Cache(at.cache), ADDRESSES, Mode.OFFLINE, explicit=at.addresses))


def load_subsidiaries(spark: SparkSession, at: Sources) -> DataFrame:
    """The named file, even with none in it; none where they are skipped; else by mode, Parquet before CSV. Without a named
    file an empty table is refused."""
    if at.subsidiaries is None and at.skip_subsidiaries:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in SUBSIDIARY_COLUMNS))
    path = resolve(Cache(at.cache), SUBSIDIARIES, at.mode, at.fetch.get(SUBSIDIARIES), at.subsidiaries, (SUBSIDIARIES_CSV,))
    rows = filings.read_subsidiaries(spark, path)
    if at.subsidiaries is None:
        check_subsidiaries(rows.limit(1).count())
    return rows


def load_licences(spark: SparkSession, at: Sources) -> DataFrame:
    """Optional: a missing or unreadable file counts as none."""
    none = spark.createDataFrame([], LICENCE)
    if at.licences_db is None or not exists(at.licences_db):
        log.info("no radio licences: %s", at.licences_db)
        return none
    try:
        rows = filings.read_licences(spark, at.licences_db)
        rows.write.mode("overwrite").parquet(f"{at.work}/licences")
    except Exception as error:  # whatever makes the file unreadable
        log.warning("radio licences are unreadable (%s) and count as none", error)
        return none
    return spark.read.schema(rows.schema).parquet(f"{at.work}/licences")


def load(spark: SparkSession, at: Sources) -> tuple[Inputs, str, dict]:
    """(inputs, source label, options of ``refresh``)."""
    aircraft, path = load_aircraft(spark, at)
    hits, overrides, aliases = (_optional(p, what) for p, what in ((at.filing_hits, "filing hits"), (at.overrides, "overrides"), (at.aliases, "issuer aliases")))
    gold_path, issuers = _optional(at.gold, "gold file"), _optional(at.aviation_issuers, "aviation issuers")
    gold = dictionaries.load_gold(spark, gold_path) if gold_path else dictionaries.gold(spark, {})
    tickers, needles = dictionaries.load_aviation_issuers(issuers) if issuers else ([], [])
    subsidiaries = load_subsidiaries(spark, at)
    inputs = Inputs(
        aircraft,
        load_companies(spark, at),
        load_addresses(spark, at),
        dictionaries.load_aliases(spark, aliases) if aliases else spark.createDataFrame([], ALIAS),
        subsidiaries,
        filings.read_edgar_hits(spark, hits) if hits else spark.createDataFrame([], f"{EDGAR_HIT}, ord long"),
        load_licences(spark, at),
        dictionaries.load_overrides(spark, overrides) if overrides else spark.createDataFrame([], OVERRIDE),
        gold["unpublished_tails"],
        gold,
        tickers,
        needles,
    )
    # A named subsidiary file may be empty.
    return inputs, f"faa:{path}", {"offline": at.mode is Mode.OFFLINE, "skip_subsidiaries": at.skip_subsidiaries or at.subsidiaries is not None}
