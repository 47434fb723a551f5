"""A deterministic registry universe derived from the test tables, so that every operator has input.

The derivation is plain SQL that Spark and DuckDB both run: it only makes inputs. Operators work on its
tables on the Spark side; the comparison SQL restates them on its own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = ("part", "supplier", "customer", "orders", "events")


def _letters(k: str) -> str:
    digits = [f"cast(floor(({k}) / {d}.0) as bigint) % 26" for d in (1, 26, 676)]
    return "'T' || " + " || ".join(f"chr(cast(65 + {d} as int))" for d in digits)


def _cik(k: str) -> str:
    return f"lpad(cast({k} as string), 10, '0')"


_STREET = "case when {k} % 11 = 0 then '1 Shared Plaza' else cast(100 + {k} as string) || ' Main Street' end"

#: name -> SQL; later ones may use earlier ones.
TABLES: dict[str, str] = {
    "base": "select p_partkey as k, upper(p_name) || ' ' || chr(cast(65 + p_partkey % 7 as int)) || 'X' as nm from part",
    "sizes": "select (select count(*) from supplier) as n_sup, (select count(*) from part) as n_part",
    "company_rows": f"""
        select s_suppkey as s, nm, {_letters('s_suppkey')} as tick from supplier join base on k = s_suppkey""",
    "companies_flat": f"""
        select {_cik('s')} as cik, tick || case when s % 10 = 3 then 'P' else '' end as ticker,
          nm || case s % 4 when 0 then ' INC' when 1 then ', Inc.' when 2 then ' CORP' else ' HOLDINGS CO' end as name,
          case s % 3 when 0 then 'NYSE' when 1 then 'Nasdaq' else 'OTC' end as exchange,
          case when s % 6 = 0 then '' else {_STREET.format(k='s')} end as street,
          case when s % 6 = 0 then '' else 'Town ' || cast(s % 20 as string) end as city,
          case when s % 6 = 0 then '' else 'tx' end as state,
          case when s % 5 = 0 then 'Old ' || nm || ' Inc' else '' end as former, s * 2 as ord
        from company_rows
        union all
        select {_cik('s')}, tick || '-PA', nm || ' PREFERRED', 'NYSE', '', '', '', '', s * 2 + 1 from company_rows where s % 4 = 1""",
    "addresses_flat": f"""
        select {_cik('s')} as cik, {_STREET.format(k='s')} as street, 'Town ' || cast(s % 20 as string) as city, 'TX' as state,
          case when s % 9 = 0 then 'Prior ' || nm || ' Co' else '' end as former from company_rows""",
    "aliases": f"""
        select case when s % 16 = 2 then '9999999999' else {_cik('s')} end as cik, 'The Alias ' || nm || ' LLC' as name,
          case when s % 16 = 2 then tick else '' end as ticker, 'filing ' || cast(s as string) as citation, s as ord
        from company_rows where s % 8 = 2""",
    "aircraft": f"""
        select 'N' || cast(100 + c_custkey as string) as n_number, 'S' || cast(c_custkey as string) as serial,
          case when c_custkey % 23 = 0 then '1' else '3' end as type_registrant,
          case when c_custkey % 17 = 3 then 'NetJets Sales ' || cast(c_custkey as string)
            when c_custkey % 19 = 4 then 'UNITED AIRLINES INC'
            when c_custkey % 13 = 5 then nm || ' TRUSTEE'
            when c_custkey % 7 = 2 then 'LONE STAR ' || cast(c_custkey as string) || ' HOLDINGS'
            when c_custkey % 29 = 11 then 'LLC'
            when c_custkey % 5 = 0 then 'The ' || nm || ' LLC' else nm || ', Inc.' end as registrant_name,
          {_STREET.format(k='(c_custkey % (select n_sup from sizes))').replace('Street', 'ST')} as street,
          'TOWN ' || cast((c_custkey % (select n_sup from sizes)) % 20 as string) as city, 'TX' as state,
          case when c_custkey % 37 = 2 then '4' else '5' end as type_aircraft,
          case when c_custkey % 31 = 1 then '1' else '5' end as type_engine,
          case when c_custkey % 41 = 3 then 'A' else 'V' end as status_code,
          'a' || lpad(cast(c_custkey as string), 5, '0') as icao24,
          case when c_custkey % 43 = 5 or c_custkey % 47 = 6 then 'BOEING' else 'GULFSTREAM AEROSPACE' end as make,
          case when c_custkey % 43 = 5 then '737-800' when c_custkey % 47 = 6 then '737 BBJ' else 'G' || cast(c_custkey % 10 as string) end as model,
          c_custkey % 53 = 7 as fractional_owner
        from customer join base on k = c_custkey""",
    "subsidiaries": f"""
        select {_cik('cast(floor(k / 5.0) as bigint) % (select n_sup from sizes)')} as parent_cik, 'Parent' as parent_name, nm || ' Aviation LLC' as subsidiary_name,
          case when k % 15 = 0 then cast(5000 + k as string) || ' Long Road' else '' end as parent_street,
          case when k % 15 = 0 then 'Ville' else '' end as parent_city, 'TX' as parent_state
        from base where k % 5 = 0
        union all
        select {_cik('cast(floor(k / 3.0) as bigint) % (select n_sup from sizes)')}, 'Parent', nm || ' LLC', '', '', ''
        from base where k % 3 = 0""",
    "edgar_hits": f"""
        select {_cik('((event_id % 5000) + case when event_id % 7 = 0 then 1 else 0 end) % (select n_sup from sizes)')} as cik,
          case when event_id % 13 = 0 then 'tev' else null end as ticker, 'acc' || cast(event_id as string) as accession, '10-K' as form,
          'n-' || cast(100 + event_id % 5000 as string) as n_number, '' as snippet,
          case when event_id % 22 = 0 then '' else 'https://filings.example/' || cast(event_id as string) end as filing_url,
          event_id % 11 = 0 as keyword_hit, event_id as ord
        from events""",
    "licensed": """
        select o_custkey, o_orderkey, (o_custkey * 3 + case when o_orderkey % 9 = 0 then 1 else 0 end) % (select n_part from sizes) as pk from orders""",
    "licences": """
        select 'N' || cast(100 + o_custkey as string) as n_number,
          nm || case when o_orderkey % 7 = 0 then ' TRUSTEE' else ' INC' end as licensee_name,
          lpad(cast(o_orderkey as string), 10, '0') as uls_id
        from licensed join base on k = pk""",
    "overrides": f"""
        select 'N' || cast(100 + c_custkey as string) as n_number, 'OVR' || cast(c_custkey % 5 as string) as ticker,
          {_cik('c_custkey % (select n_sup from sizes)')} as cik, case when c_custkey % 2 = 0 then '' else 'NAMED CO' end as company_name,
          'doc ' || cast(c_custkey as string) as citation, c_custkey as ord
        from customer where c_custkey % 59 = 8""",
    "unpublished": f"""
        select 'N' || cast(100 + c_custkey as string) as n_number, {_letters('c_custkey')} as must_not_ticker, 'audit' as citation, c_custkey as ord
        from customer where c_custkey % 9 = 1""",
    "gold_flat": f"""
        select lower(tick) as ticker, {_cik('s')} as cik, case when s % 2 = 0 then nm || ' Corp' else '' end as company_name,
          nm || ' LLC' as registrant, s as ord from company_rows where s % 3 = 0""",
    "gold_tails": f"""
        select 'N' || cast(100 + c_custkey as string) as n_number, {_letters('c_custkey % (select n_sup from sizes)')} as ticker, {_cik('c_custkey % (select n_sup from sizes)')} as cik,
          '' as company_name, 'gold' as citation, c_custkey as ord from customer where c_custkey % 21 = 4
        union all select 'N99999', 'TAAA', '0000000001', '', 'gold', 999999999""",
    "rubric": f"""
        select 'N' || cast(100 + c_custkey as string) as n_number,
          case when c_custkey % 6 = 5 or c_custkey % 4 = 1 then '' else {_letters('c_custkey % (select n_sup from sizes)')} end as ticker,
          case when c_custkey % 6 <> 5 and c_custkey % 4 = 1 then {_letters('c_custkey % (select n_sup from sizes)')} else '' end as must_not_ticker,
          case c_custkey % 6 when 0 then 'identity_easy' when 1 then 'identity_hard' when 2 then 'subsidiary_tp' when 3 then 'filing'
            when 4 then 'namesake' else 'not_our_join' end as stratum,
          case when c_custkey % 5 < 2 then 'train' else 'holdout' end as split, 'cited' as citation, c_custkey as ord
        from customer""",
    "feed_old": """
        select o_custkey, o_orderpriority as ticker, o_orderkey, o_orderstatus,
          row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
        from orders where o_orderdate < timestamp '1998-01-01 00:00:00'""",
    "feed_new": """
        select o_custkey, o_orderpriority as ticker, o_orderkey, o_orderstatus,
          row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
        from orders where o_orderdate >= timestamp '1998-01-01 00:00:00'""",
}


def cte(*names: str) -> str:
    """The WITH list of tables up to the last one named, for the comparison SQL."""
    keep = list(TABLES)[: max(list(TABLES).index(n) for n in names) + 1]
    return ",\n".join(f"{n} AS ({TABLES[n]})" for n in keep)


class Universe(dict):
    """name -> DataFrame over ``sf_dir``; a table and what it is made of are built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in SOURCES:
            self[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        else:
            sql = TABLES[name]
            used = {k: self[k] for k in (*SOURCES, *TABLES) if _uses(sql, k)}
            for k in used:
                sql = _replace(sql, k)
            self[name] = self.spark.sql(sql, **used)
        return self[name]


def _uses(sql: str, name: str) -> bool:
    return re.search(rf"\b(?:from|join)\s+{name}\b", sql) is not None


def _replace(sql: str, name: str) -> str:
    return re.sub(rf"\b(from|join)\s+{name}\b", rf"\1 {{{name}}}", sql)


def listed(frames: dict[str, DataFrame]) -> DataFrame:
    """Companies with their former name as an array."""
    names = F.when(F.col("former") != "", F.array("former")).otherwise(F.array().cast("array<string>"))
    return frames["companies_flat"].withColumn("former_names", names).drop("former")


def addresses(frames: dict[str, DataFrame]) -> DataFrame:
    names = F.when(F.col("former") != "", F.array("former")).otherwise(F.array().cast("array<string>"))
    return frames["addresses_flat"].withColumn("former_names", names).drop("former")


def gold(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    companies = frames["gold_flat"].withColumn("registrant_names", F.array("registrant")).drop("registrant")
    return {"companies": companies, "tails": frames["gold_tails"], "unpublished_tails": frames["unpublished"]}
