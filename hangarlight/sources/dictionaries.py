"""Hand-kept YAML dictionaries, validated on load. They are small by nature: people edit them."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from ..functions.dicts import RUBRIC_STRATA
from .schemas import ALIAS, FORBIDDEN, GOLD_COMPANY, OVERRIDE, RUBRIC


class DictionaryError(ValueError):
    """A dictionary breaks one of its rules."""


def _load(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML dictionaries needs the yaml library") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def canonical(n: str) -> str:
    bare = re.sub("[- .]", "", str(n).strip().upper())
    return bare if not bare or bare.startswith("N") else "N" + bare


def padded(cik) -> str:
    return re.sub("[^0-9]", "", str(cik)).rjust(10, "0")


def _text(row: dict, key: str, upper: bool = False) -> str:
    value = str(row.get(key) or "").strip()
    return value.upper() if upper else value


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], schema)


def overrides(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """n_number, ticker, cik, company_name, citation; the last row of a tail wins downstream by ``ord``."""
    return _frame(
        spark,
        [(canonical(r["n_number"]), _text(r, "ticker", True), padded(r.get("cik", "")), _text(r, "company_name"), _text(r, "citation")) for r in rows],
        OVERRIDE,
    )


def aliases(spark: SparkSession, rows: list[dict]) -> DataFrame:
    for r in rows:
        if not _text(r, "name"):
            raise DictionaryError("issuer alias without a name")
        if not _text(r, "citation"):
            raise DictionaryError(f"issuer alias {r['name']} without a citation")
    return _frame(spark, [(padded(r.get("cik", "")), _text(r, "name"), _text(r, "ticker", True), _text(r, "citation")) for r in rows], ALIAS)


def gold(spark: SparkSession, file: dict) -> dict[str, DataFrame]:
    """companies, tails and unpublished tails."""
    companies = [
        (_text(r, "ticker", True), padded(r.get("cik", "")), _text(r, "company_name"), [str(x) for x in r.get("registrant_names") or []])
        for r in file.get("companies") or []
    ]
    forbidden = [(canonical(r["n_number"]), _text(r, "must_not_ticker", True), _text(r, "citation")) for r in file.get("unpublished_tails") or []]
    return {
        "companies": _frame(spark, companies, GOLD_COMPANY),
        "tails": overrides(spark, file.get("tails") or []),
        "unpublished_tails": _frame(spark, forbidden, FORBIDDEN),
    }


def rubric_errors(rows: list[dict]) -> list[str]:
    """What is wrong with rubric rows, in the order of the rules."""
    errors, seen, per_ticker = [], set(), Counter()
    for r in rows:
        n, ticker, not_ticker = canonical(r.get("n_number") or ""), _text(r, "ticker", True), _text(r, "must_not_ticker", True)
        stratum, split = _text(r, "stratum"), _text(r, "split").lower()
        if not n:
            errors.append("row without n_number")
            continue
        if n in seen:
            errors.append(f"{n}: duplicate")
        seen.add(n)
        if not _text(r, "citation"):
            errors.append(f"{n}: no citation")
        if split not in ("train", "holdout"):
            errors.append(f"{n}: split {split}")
        if stratum not in RUBRIC_STRATA:
            errors.append(f"{n}: stratum {stratum}")
        if stratum == "not_our_join":
            if ticker or not_ticker:
                errors.append(f"{n}: not_our_join names a ticker")
        elif bool(ticker) == bool(not_ticker):
            errors.append(f"{n}: needs exactly one of ticker and must_not_ticker")
        per_ticker[ticker or not_ticker] += bool(ticker or not_ticker)
    errors += [f"{t}: more than 2 tails" for t, k in per_ticker.items() if t and k > 2]
    return errors


def rubric(spark: SparkSession, rows: list[dict]) -> DataFrame:
    if errors := rubric_errors(rows):
        raise DictionaryError("; ".join(errors))
    return _frame(
        spark,
        [
            (canonical(r["n_number"]), _text(r, "ticker", True), _text(r, "must_not_ticker", True), _text(r, "stratum"), _text(r, "split").lower(), _text(r, "citation"))
            for r in rows
        ],
        RUBRIC,
    )


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    return overrides(spark, _load(path).get("mappings") or [])


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    return aliases(spark, _load(path).get("aliases") or [])


def load_gold(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return gold(spark, _load(path))


def load_rubric(spark: SparkSession, path: str) -> DataFrame:
    return rubric(spark, _load(path).get("rows") or [])


def load_aviation_issuers(path: str) -> tuple[list[str], list[str]]:
    """(tickers, name needles), upper-cased; empty needles are dropped."""
    file = _load(path)
    clean = [[str(x).strip().upper() for x in file.get(k) or []] for k in ("tickers", "needles")]
    return clean[0], [x for x in clean[1] if x]
