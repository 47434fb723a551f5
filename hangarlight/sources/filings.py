"""Listed companies, addresses, subsidiaries, filing hits and radio licences."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import canonical_n_number, pad_cik
from .lines import line_order
from .registry import read_sqlite_table
from .schemas import ADDRESS, EDGAR_HIT, SUBSIDIARY_COLUMNS

# Long column names of the subsidiary tables, by field.
LONG_NAMES = {
    "parent_cik": "parent_company_central_index_key", "parent_name": "parent_company_name", "subsidiary_name": "subsidiary_company_name",
    "parent_street": "parent_company_business_street_address", "parent_city": "parent_company_business_city",
    "parent_state": "parent_company_business_state",
}


def _company(cik: Column, ticker: Column, name: Column, exchange: Column) -> list[Column]:
    empty = [F.lit("").alias(c) for c in ("street", "city", "state")]
    text = [F.coalesce(c, F.lit("")) for c in (cik, ticker, name, exchange)]
    return [
        pad_cik(text[0]).alias("cik"),
        F.upper(F.trim(text[1])).alias("ticker"),
        text[2].alias("name"),
        text[3].alias("exchange"),
        *empty,
        F.array().cast("array<string>").alias("former_names"),
    ]


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Companies of a ticker file in either shape: {fields, data} or {"0": {cik_str, ticker, title}}.

    The file is one JSON value; it is read as text, and rows are exploded by Spark. Rows without a ticker
    are dropped; ``ord`` is the row's place.
    """
    text = spark.read.text(path, wholetext=True)
    columnar = text.select(F.from_json("value", "fields array<string>, data array<array<string>>").alias("j")).filter(
        "j.fields is not null and j.data is not null"
    )
    if columnar.limit(1).count():
        names = F.transform(F.col("j.fields"), lambda x: F.lower(F.trim(x)))
        rows = columnar.select(names.alias("f"), F.posexplode("j.data").alias("ord", "row"))

        def field(name: str) -> Column:
            at = F.array_position("f", F.lit(name)).cast("int")
            return F.when(at > 0, F.get("row", at - 1))

        out = rows.select(*_company(field("cik"), field("ticker"), field("name"), field("exchange")), F.col("ord").cast("long").alias("ord"))
    else:
        entries = text.select(F.from_json("value", "map<string, struct<cik_str:string, ticker:string, title:string>>").alias("m"))
        rows = entries.select(F.explode("m").alias("k", "v")).filter("v.cik_str is not null")
        if not rows.limit(1).count():
            raise ValueError(f"unknown shape of ticker file {path}")
        out = rows.select(*_company(F.col("v.cik_str"), F.col("v.ticker"), F.col("v.title"), F.lit("")), F.col("k").cast("long").alias("ord"))
    return out.filter("ticker <> ''")


def write_tickers(companies: DataFrame, path: str) -> None:
    """The columnar shape again, {fields, data} as one JSON value in the order of ``ord``; the format has no smaller unit."""
    fields = ("cik", "name", "ticker", "exchange")
    rows = F.array_sort(F.collect_list(F.struct("ord", F.array(*fields).alias("row"))))
    value = F.to_json(F.struct(F.array(*map(F.lit, fields)).alias("fields"), F.col("rows.row").alias("data")))
    companies.agg(rows.alias("rows")).select(value.alias("value")).write.mode("overwrite").text(path)


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """cik, street, city, state, former_names of a JSON array; nulls become '' and []."""
    rows = spark.read.schema(ADDRESS).json(path, multiLine=True, mode="FAILFAST")
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("street", "city", "state")]
    return rows.select(pad_cik(F.coalesce("cik", F.lit(""))).alias("cik"), *text, F.coalesce("former_names", F.array().cast("array<string>")).alias("former_names"))


def _subsidiaries(columns: dict[str, Column], rows: DataFrame) -> DataFrame:
    named = [F.coalesce(columns[c].cast("string"), F.lit("")).alias(c) for c in SUBSIDIARY_COLUMNS]
    out = rows.select(*named).filter(F.trim("subsidiary_name") != "")
    return out.withColumn("parent_cik", pad_cik(F.col("parent_cik")))


def read_subsidiaries_csv(spark: SparkSession, path: str) -> DataFrame:
    """Short column names first, long ones where the short is missing or empty."""
    rows = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)

    def value(short: str) -> Column:
        options = [F.nullif(F.col(f"`{c}`"), F.lit("")) for c in (short, LONG_NAMES[short]) if c in rows.columns]
        return F.coalesce(*options, F.lit(""))

    return _subsidiaries({c: value(c) for c in SUBSIDIARY_COLUMNS}, rows)


def read_subsidiaries_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The first existing column of long name, short name, or a name ending in either; '' if none."""
    rows = spark.read.parquet(path)

    def value(short: str) -> Column:
        for wanted in (LONG_NAMES[short], short):
            if wanted in rows.columns:
                return F.col(f"`{wanted}`")
        fuzzy = [c for c in rows.columns if c.endswith(LONG_NAMES[short]) or c.endswith(short)]
        return F.col(f"`{fuzzy[0]}`") if fuzzy else F.lit("")

    return _subsidiaries({c: value(c) for c in SUBSIDIARY_COLUMNS}, rows)


def read_subsidiaries(spark: SparkSession, path: str) -> DataFrame:
    """By suffix; other files are tried as Parquet, then as CSV."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix == ".csv":
        return read_subsidiaries_csv(spark, path)
    if suffix in (".parquet", ".pq"):
        return read_subsidiaries_parquet(spark, path)
    try:
        return read_subsidiaries_parquet(spark, path)
    except Exception:  # not Parquet: the format decides, not the error
        return read_subsidiaries_csv(spark, path)


def read_edgar_hits(spark: SparkSession, path: str) -> DataFrame:
    """Filing hits of a JSONL file with their line's place as ``ord``; malformed lines are errors."""
    return spark.read.schema(EDGAR_HIT).json(path, mode="FAILFAST").withColumn("ord", line_order())


def read_licences(spark: SparkSession, path: str) -> DataFrame:
    """Live radio licences of a SQLite file, canonical n-numbers."""
    live = "deleted_at IS NULL AND n_number <> '' AND licensee_name <> ''"
    rows = read_sqlite_table(spark, path, "licenses", "n_number string, licensee_name string, uls_id string", "n_number, licensee_name, uls_id", live)
    return rows.withColumn("n_number", canonical_n_number(F.col("n_number"))).filter("n_number <> ''")
