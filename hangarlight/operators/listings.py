"""Company listings: addresses and aliases filled in, then one primary listing per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import major_exchange, normalize_name, pad_cik, preferred_or_warrant


def fill_addresses(companies: DataFrame, addresses: DataFrame) -> DataFrame:
    """Addresses fill companies without a street (street, city, state together), former names fill those without any."""
    one = addresses.groupBy(pad_cik(F.col("cik")).alias("cik")).agg(
        F.max_by(F.struct("street", "city", "state", "former_names"), "ord").alias("a")
        if "ord" in addresses.columns
        else F.max(F.struct("street", "city", "state", "former_names")).alias("a")
    )
    joined = companies.join(one, "cik", "left")
    lacks = (F.col("street") == "") & F.col("a").isNotNull()
    filled = {c: F.when(lacks, F.coalesce(F.col(f"a.{c}"), F.lit(""))).otherwise(F.col(c)) for c in ("street", "city", "state")}
    no_names = (F.size("former_names") == 0) & F.col("a.former_names").isNotNull()
    filled["former_names"] = F.when(no_names, F.col("a.former_names")).otherwise(F.col("former_names"))
    return joined.withColumns(filled).drop("a")


def apply_aliases(companies: DataFrame, aliases: DataFrame) -> DataFrame:
    """Alias names join the former names of companies with the same cik or the same ticker, in alias order.

    The disjunction is two equi-joins; an alias whose normalised name the company already has adds nothing,
    and of several equal ones the first does.
    """
    alias = aliases.select(
        pad_cik(F.col("cik")).alias("a_cik"),
        F.upper(F.trim("ticker")).alias("a_ticker"),
        F.col("name").alias("a_name"),
        normalize_name(F.col("name")).alias("a_norm"),
        F.col("ord").alias("a_ord"),
    ).filter("a_norm <> ''")
    keys = companies.select("cik", "ticker", "ord")
    by_cik = keys.join(alias, F.col("cik") == F.col("a_cik"))
    by_ticker = keys.join(alias.filter("a_ticker <> ''"), F.upper(F.trim("ticker")) == F.col("a_ticker"))
    added = (
        by_cik.unionByName(by_ticker)
        .groupBy("ord", "a_norm")
        .agg(F.min(F.struct("a_ord", "a_name")).alias("first"))
        .groupBy("ord")
        .agg(F.array_sort(F.collect_list(F.struct("first.a_ord", "a_norm", "first.a_name"))).alias("added"))
    )
    have = F.transform(F.concat(F.array("name"), "former_names"), lambda x: normalize_name(x))
    fresh = F.filter("added", lambda x: ~F.array_contains("have", x["a_norm"]))
    names = F.concat("former_names", F.transform(fresh, lambda x: x["a_name"]))
    return (
        companies.join(added, "ord", "left")
        .withColumn("have", have)
        .withColumn("former_names", F.when(F.col("added").isNull(), F.col("former_names")).otherwise(names))
        .select(*companies.columns)
    )


def _ranked(companies: DataFrame) -> DataFrame:
    """The best listing per cik: common form, major exchange, no preferred or warrant, shorter, alphabetical, first."""
    t = F.upper(F.trim("ticker"))

    def no(flag: Column) -> Column:
        return flag.cast("int")

    rank = F.struct(
        no(t.rlike("[-.]")).alias("r1"),
        no(~major_exchange(F.col("exchange"))).alias("r2"),
        no(preferred_or_warrant(t)).alias("r3"),
        F.length(t).alias("r4"),
        t.alias("r5"),
        F.col("ord").alias("r6"),
    )
    rest = F.struct(*[c for c in companies.columns if c != "cik"])
    # An aggregate with map-side combine; a window would shuffle and sort every row.
    best = companies.groupBy("cik").agg(F.min_by(rest, rank).alias("best"))
    return best.select("cik", "best.*")


def primary_listings(companies: DataFrame) -> DataFrame:
    """One row per company; companies with nothing but preferreds or warrants are left out."""
    return _ranked(companies).filter(~preferred_or_warrant(F.col("ticker")))


def omitted_preferred_only(companies: DataFrame) -> DataFrame:
    """What ``primary_listings`` leaves out, ordered by ticker and cik."""
    return _ranked(companies).filter(preferred_or_warrant(F.col("ticker"))).orderBy("ticker", "cik")


