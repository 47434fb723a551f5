"""The daily run: gates of the inputs, cascade, gates of the result, feed and snapshot, in this order."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from . import evaluate, gates, listings, resolve
from .feed import Feed, check_dates


@dataclass
class Inputs:
    """The day's tables as the readers in ``sources`` give them."""

    aircraft: DataFrame
    companies: DataFrame
    addresses: DataFrame
    aliases: DataFrame
    subsidiaries: DataFrame
    edgar_hits: DataFrame
    licences: DataFrame
    overrides: DataFrame
    unpublished: DataFrame
    gold: dict[str, DataFrame]
    aviation_tickers: list[str]
    aviation_needles: list[str]


def refresh(
    feed: Feed, inputs: Inputs, source: str, as_of: str, recorded_at: str, deleted_at: int, *, offline: bool = False, skip_subsidiaries: bool = False
) -> dict:
    """Decide every aircraft, run all gates, publish a version and its snapshot; returns the gold report.

    The run holds the feed from its first step on. Dates and the gates of the inputs come first, before the cascade. The
    decisions are a table in a folder of this run, because gates and all outputs read them. A gate that refuses raises
    ``GateError`` before anything is published, and leaves feed and snapshots as they were.
    """
    spark = feed.spark
    check_dates(spark, as_of, recorded_at)
    with feed.locked():
        aircraft, subsidiaries = inputs.aircraft.count(), inputs.subsidiaries.count()
        gates.check_master_floor(aircraft, offline)
        gates.check_subsidiaries(subsidiaries, skip_subsidiaries)
        companies = listings.apply_aliases(listings.fill_addresses(inputs.companies, inputs.addresses), inputs.aliases)
        evidence = resolve.Evidence(companies, inputs.subsidiaries, inputs.edgar_hits, inputs.licences, inputs.overrides, inputs.unpublished)
        decided = resolve.decide(inputs.aircraft, evidence, source)
        path = f"{feed.root}/decided/as_of={as_of}/run-{uuid.uuid4().hex}"
        decided.write.parquet(path)
        decided = spark.read.schema(decided.schema).parquet(path)
        published = gates.annotate_aviation_issuer(resolve.published(decided, as_of), inputs.aviation_tickers, inputs.aviation_needles)
        unresolved = resolve.unresolved(decided, as_of)
        report = evaluate.evaluate_gold(inputs.gold, published, inputs.aircraft, unresolved.filter("reason = 'trustee'")).first().asDict()
        feed.apply(
            as_of,
            recorded_at,
            deleted_at,
            published,
            resolve.review_queue(decided, as_of),
            unresolved,
            aircraft=aircraft,
            subsidiaries=subsidiaries,
            gold=report,
            conflicts=resolve.conflicts(decided, evidence),
            offline=offline,
            skip_subsidiaries=skip_subsidiaries,
        )
    return report
