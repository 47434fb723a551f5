"""Annotation of aviation issuers, and the gates that stop a publication before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dicts import MASTER_FLOOR, RUBRIC_STRATA, SMALL_FEED
from ..functions.exprs import any_needle


class GateError(RuntimeError):
    """A gate refused the new feed; the old one stays."""


def is_aviation_issuer(ticker: Column, registrant: Column, tickers: list[str], needles: list[str]) -> Column:
    by_ticker = F.upper(F.trim(ticker)).isin(*tickers) if tickers else F.lit(False)
    wanted = [n for n in needles if n]
    return by_ticker | any_needle(F.upper(registrant), wanted) if wanted else by_ticker


def annotate_aviation_issuer(rows: DataFrame, tickers: list[str], needles: list[str]) -> DataFrame:
    return rows.withColumn("aviation_issuer", is_aviation_issuer(F.col("ticker"), F.col("registrant_name"), tickers, needles))


def published_row_floor(previous: int) -> int | None:
    return None if previous < SMALL_FEED else max(previous // 2, SMALL_FEED)


def check_published_floor(previous: int, new: int) -> None:
    floor = published_row_floor(previous)
    if floor is not None and new < floor:
        raise GateError(f"{new} published rows; the previous feed of {previous} allows no fewer than {floor}")


def check_master_floor(rows: int, offline: bool = False) -> None:
    if rows == 0:
        raise GateError("the aircraft registry is empty")
    if rows < MASTER_FLOOR and not offline:
        raise GateError(f"the aircraft registry has {rows} rows, fewer than {MASTER_FLOOR}")


def check_subsidiaries(rows: int, skipped: bool = False) -> None:
    if rows == 0 and not skipped:
        raise GateError("the subsidiary table is empty")


def check_gold(report: dict) -> None:
    if report["tail_false_positives"]:
        raise GateError(f"{report['tail_false_positives']} forbidden tails would be published")


def rubric_violations(rubric: DataFrame) -> DataFrame:
    """(n_number, problem) of a rubric table that breaks its rules."""
    pos, neg = F.col("ticker") != "", F.col("must_not_ticker") != ""
    outside = F.col("stratum") == "not_our_join"
    checks = [
        (F.col("n_number") == "", "missing n_number"),
        (F.trim("citation") == "", "missing citation"),
        (~F.col("split").isin("train", "holdout"), "bad split"),
        (~F.col("stratum").isin(*RUBRIC_STRATA), "unknown stratum"),
        (outside & (pos | neg), "not_our_join names a ticker"),
        (~outside & (pos == neg), "needs exactly one ticker"),
    ]
    own = rubric.select("n_number", F.explode(F.filter(F.array(*(F.when(c, F.lit(p)) for c, p in checks)), lambda x: x.isNotNull())).alias("problem"))
    twice = rubric.groupBy("n_number").count().filter("count > 1").select("n_number", F.lit("duplicate").alias("problem"))
    named = rubric.filter(pos | neg).groupBy(F.when(pos, F.col("ticker")).otherwise(F.col("must_not_ticker")).alias("n_number")).count()
    return own.unionByName(twice).unionByName(named.filter("count > 2").select("n_number", F.lit("more than 2 tails").alias("problem")))
