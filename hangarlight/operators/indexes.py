"""Key -> ticker indexes, aggregated to one row per key so that joins with them never fan out.

A row holds the distinct tickers of its key, sorted, and the first hit: of equal tickers the smallest cik. Lists grow
with the companies of a key; joins with many rows take ``brief``, whose rows have a fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ex21_indexable, normalize_address, normalize_name

HIT = ("ticker", "cik", "name")


def _index(rows: DataFrame) -> DataFrame:
    """key, tickers, hit for rows (key, ticker, cik, name)."""
    return (
        rows.filter("key <> ''")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("ticker")).alias("tickers"), F.min(F.struct("cik", "ticker", "name")).alias("hit"))
    )


def brief(rows: DataFrame) -> DataFrame:
    """key, n (distinct tickers: 0, 1, or 2 for more), only (the ticker, if n is 1), hit: an index without its lists."""
    low, high = F.col("low"), F.col("high")
    found = rows.filter("key <> ''").groupBy("key").agg(
        F.min("ticker").alias("low"), F.max("ticker").alias("high"), F.min(F.struct("cik", "ticker", "name")).alias("hit")
    )
    n = F.when(low.isNull(), 0).when(low == high, 1).otherwise(2)
    return found.select("key", n.alias("n"), F.when(low == high, low).alias("only"), "hit")


def name_rows(primary: DataFrame) -> DataFrame:
    names = primary.select(*HIT, F.explode(F.concat(F.array("name"), "former_names")).alias("n"))
    return names.select(*HIT, normalize_name(F.col("n")).alias("key"))


def name_index(primary: DataFrame) -> DataFrame:
    return _index(name_rows(primary))


def parents(subsidiaries: DataFrame, primary: DataFrame) -> DataFrame:
    """Subsidiaries with their listed parent's hit."""
    listed = primary.select(F.col("cik").alias("parent_cik"), "cik", "ticker", "name")
    return subsidiaries.join(listed, "parent_cik")


def subsidiary_rows(subsidiaries: DataFrame, primary: DataFrame) -> DataFrame:
    keyed = parents(subsidiaries, primary).select(*HIT, normalize_name(F.col("subsidiary_name")).alias("key"))
    return keyed.filter(ex21_indexable(F.col("key")))


def subsidiary_index(subsidiaries: DataFrame, primary: DataFrame) -> DataFrame:
    return _index(subsidiary_rows(subsidiaries, primary))


def address_rows(primary: DataFrame, subsidiaries: DataFrame) -> DataFrame:
    """Company addresses and the parent addresses that the subsidiary table gives."""
    own = primary.select(*HIT, normalize_address(F.col("street"), F.col("city"), F.col("state")).alias("key"))
    given = parents(subsidiaries, primary).select(
        *HIT, normalize_address(F.col("parent_street"), F.col("parent_city"), F.col("parent_state")).alias("key")
    )
    return own.unionByName(given)


def address_index(primary: DataFrame, subsidiaries: DataFrame) -> DataFrame:
    return _index(address_rows(primary, subsidiaries))
