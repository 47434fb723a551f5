"""Readers and writers of the sources, on small files written here."""

import json
import sqlite3
import zipfile

import pytest

from hangarlight.sources import dictionaries, filings, registry

HEADER = (
    "N-NUMBER,SERIAL NUMBER,MFR MDL CODE,ENG MFR MDL,YEAR MFR,TYPE REGISTRANT,NAME,STREET,STREET2,CITY,STATE,ZIP CODE,REGION,COUNTY,COUNTRY,"
    "LAST ACTION DATE,CERT ISSUE DATE,CERTIFICATION,TYPE AIRCRAFT,TYPE ENGINE,STATUS CODE,MODE S CODE,FRACT OWNER,AIR WORTH DATE,OTHER NAMES(1),"
    "OTHER NAMES(2),OTHER NAMES(3),OTHER NAMES(4),OTHER NAMES(5),EXPIRATION DATE,UNIQUE ID,KIT MFR,KIT MODEL,MODE S CODE HEX"
)
REFERENCE = "CODE,MFR,MODEL,TYPE-ACFT\nabc1 ,OLD MAKER,X1,5\nABC1,GULFSTREAM,G650,5\n"
# n_number, serial, type_registrant, registrant_name, street, city, state, type_aircraft, type_engine, status_code, icao24, make, model, fractional_owner
JET = ("N123AB", "S1", "3", "ALPHA, INC", "1 MAIN ST", "RENO", "NV", "5", "5", "V", "a1b2c3", "GULFSTREAM", "G650", True)
BARE = ("N7XY", "S2", "5", "BETA LLC", "", "", "", "4", "1", "V", "a0", "", "", False)


def master(first_line, hex_at):
    """A MASTER file with two whole rows and one of too few fields; the address code stands in field ``hex_at``."""
    lines = [first_line]
    for tail, serial, code, kind, name, place, flag, hex_code, rest in (
        ("123AB ", "S1", "abc1", "3", '"ALPHA, INC"', ("1 MAIN ST", "RENO", "NV"), "Y", "A1B2C3 ", ("5", "5", "V")),
        ("n7xy", "S2", "ZZZ", "5", "BETA LLC", ("", "", ""), "", "A0", ("4", "1", "V")),
    ):
        cells = [""] * 34
        cells[0:3], cells[5], cells[6], cells[7], cells[9], cells[10] = (tail, serial, code), kind, name, *place
        cells[18:21], cells[22], cells[hex_at] = rest, flag, hex_code
        lines.append(",".join(cells))
    return "\n".join([*lines, "9SHORT,S3,ABC1"]) + "\n"


def aircraft(df):
    columns = "n_number serial type_registrant registrant_name street city state type_aircraft type_engine status_code icao24 make model fractional_owner"
    return sorted(tuple(r) for r in df.select(*columns.split()).collect())


def test_tickers_of_both_shapes_and_back(spark, tmp_path):
    columnar = tmp_path / "columnar.json"
    columnar.write_text(json.dumps({"fields": ["cik", "Name", "ticker", "exchange"], "data": [[12, "Alpha Inc", " aa ", "NYSE"], [7, "No Ticker", "", "OTC"], [9, "Beta", "bb", None]]}))
    read = filings.read_tickers(spark, str(columnar))
    rows = [("0000000012", "AA", "Alpha Inc", "NYSE", 0), ("0000000009", "BB", "Beta", "", 2)]
    assert [(r.cik, r.ticker, r.name, r.exchange, r.ord) for r in read.orderBy("ord").collect()] == rows
    filings.write_tickers(read, str(tmp_path / "out"))
    again = filings.read_tickers(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [(r.cik, r.ticker, r.name, r.exchange) for r in again] == [r[:4] for r in rows]
    keyed = tmp_path / "keyed.json"
    keyed.write_text(json.dumps({"0": {"cik_str": 12, "ticker": "aa", "title": "Alpha Inc"}, "1": {"cik_str": 9, "ticker": "bb", "title": "Beta"}}))
    assert [(r.cik, r.ticker, r.name, r.exchange) for r in filings.read_tickers(spark, str(keyed)).orderBy("ord").collect()] == [
        ("0000000012", "AA", "Alpha Inc", ""), ("0000000009", "BB", "Beta", "")
    ]
    (tmp_path / "odd.json").write_text("[1, 2]")
    with pytest.raises(ValueError):
        filings.read_tickers(spark, str(tmp_path / "odd.json"))


def test_sqlite_tables_are_read_in_ranges(spark, tmp_path):
    path = str(tmp_path / "copy.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("create table t (a integer, b text, c integer)")
        db.executemany("insert into t values (?, ?, ?)", [(k, None if k % 7 == 0 else f"b{k}", k % 2) for k in range(1000)])
        db.execute("delete from t where a between 300 and 649")
        db.execute("create table none (a integer)")
    found = registry.read_sqlite_table(spark, path, "t", "a int, b string", "a, b", "c = 1", rows=100)
    assert found.rdd.getNumPartitions() == 10
    wanted = [(k, None if k % 7 == 0 else f"b{k}") for k in range(1, 1000, 2) if not 300 <= k < 650]
    assert sorted(map(tuple, found.collect())) == wanted
    assert registry.read_sqlite_table(spark, path, "none", "a int", "a").count() == 0


def test_registry_zip_with_and_without_header(spark, tmp_path):
    for name, first, at in (("named", HEADER, 33), ("bare", "made-up first line", 29)):
        path = tmp_path / f"{name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            archive.writestr("MASTER.txt", master(first, at))
            archive.writestr("ACFTREF.txt", REFERENCE)
        assert aircraft(registry.read_zip(spark, str(path), str(tmp_path / name))) == [JET, BARE]
    with zipfile.ZipFile(tmp_path / "half.zip", "w") as archive:
        archive.writestr("MASTER.txt", master(HEADER, 33))
    with pytest.raises(ValueError):
        registry.read_zip(spark, str(tmp_path / "half.zip"), str(tmp_path / "half"))


def test_registry_and_licences_from_sqlite(spark, tmp_path):
    path = str(tmp_path / "registry.sqlite")
    names = "n_number, serial_number, type_registrant, owner_name, street, city, state, type_aircraft, type_engine, status_code, fractional_owner, icao24, mfr_mdl_code"
    row = ("123AB", "S1", "3", "ALPHA, INC", "1 MAIN ST", "RENO", "NV", "5", "5", "V", "Y", "A1B2C3", "ABC1")
    with sqlite3.connect(path) as db:
        db.execute(f"create table aircraft ({names}, is_current integer)")
        db.executemany(f"insert into aircraft values ({','.join('?' * 14)})", [(*row, 1), ("9OLD", *row[1:], 0)])
        db.execute("create table aircraft_ref (code text primary key, mfr text, model text)")
        db.execute("insert into aircraft_ref values ('ABC1', 'GULFSTREAM', 'G650')")
        db.execute("create table licenses (uls_id text primary key, n_number text, licensee_name text, deleted_at integer)")
        db.executemany("insert into licenses values (?, ?, ?, ?)", [("1", "425mp", "GAMMA INC", None), ("2", "N1", "GONE", 5), ("3", "", "BLANK", None), ("4", "N2", None, None)])
    assert aircraft(registry.read_sqlite(spark, path)) == [JET]
    assert [tuple(r) for r in filings.read_licences(spark, path).collect()] == [("N425MP", "GAMMA INC", "1")]


def test_addresses_and_hits(spark, tmp_path):
    (tmp_path / "hq.json").write_text(json.dumps([{"cik": "12", "street": "1 Main", "former_names": ["OLD CO"]}, {"cik": "9", "city": None, "state": "NV"}]))
    found = sorted(tuple(r) for r in filings.read_addresses(spark, str(tmp_path / "hq.json")).collect())
    assert found == [("0000000009", "", "", "NV", []), ("0000000012", "1 Main", "", "", ["OLD CO"])]
    hit = {"cik": "12", "ticker": None, "accession": "0-1", "form": "10-K", "n_number": "N1WM", "snippet": "jet", "filing_url": "u", "keyword_hit": True}
    (tmp_path / "hits.jsonl").write_text(json.dumps(hit) + "\n" + json.dumps(hit | {"ticker": "AA"}) + "\n")
    rows = filings.read_edgar_hits(spark, str(tmp_path / "hits.jsonl")).orderBy("ord").collect()
    assert [(r.ticker, r.n_number, r.keyword_hit) for r in rows] == [(None, "N1WM", True), ("AA", "N1WM", True)]
    (tmp_path / "torn.jsonl").write_text(json.dumps(hit) + '\n{"cik": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        filings.read_edgar_hits(spark, str(tmp_path / "torn.jsonl")).collect()


def test_subsidiaries_of_every_format(spark, tmp_path):
    wanted = [("0000000012", "Alpha Inc", "Alpha Air LLC", "1 Main", "Reno", "NV")]
    (tmp_path / "short.csv").write_text(
        "parent_cik,parent_name,subsidiary_name,parent_street,parent_city,parent_state\n12, Alpha Inc ,Alpha Air LLC,1 Main,Reno,NV\n12,Alpha Inc, ,1 Main,Reno,NV\n"
    )
    long_names = ",".join(filings.LONG_NAMES[c] for c in filings.SUBSIDIARY_COLUMNS)
    (tmp_path / "long.data").write_text(f"{long_names}\n12,Alpha Inc,Alpha Air LLC,1 Main,Reno,NV\n")
    for name in ("short.csv", "long.data"):
        assert [tuple(r) for r in filings.read_subsidiaries(spark, str(tmp_path / name)).collect()] == wanted
    frame = spark.createDataFrame([(12, *wanted[0][1:])], "parent_cik long, parent_name string, subsidiary_name string, parent_street string, parent_city string, parent_state string")
    for name, renamed in (("a.parquet", frame.withColumnsRenamed(filings.LONG_NAMES)), ("b.pq", frame), ("c", frame.withColumnRenamed("parent_city", "x_parent_city"))):
        renamed.write.parquet(str(tmp_path / name))
        assert [tuple(r) for r in filings.read_subsidiaries(spark, str(tmp_path / name)).collect()] == wanted
    frame.drop("parent_state").write.parquet(str(tmp_path / "less.parquet"))
    assert filings.read_subsidiaries(spark, str(tmp_path / "less.parquet")).first().parent_state == ""


def test_dictionaries_are_validated(spark):
    rows = [{"n_number": "1-23", "ticker": "aa", "cik": 12, "company_name": " Alpha ", "citation": "c"}]
    assert [tuple(r) for r in dictionaries.overrides(spark, rows).collect()] == [("N123", "AA", "0000000012", "Alpha", "c", 0)]
    alias = {"cik": 12, "ticker": "aa", "name": "ALPHA AIR", "citation": "c"}
    assert [tuple(r) for r in dictionaries.aliases(spark, [alias]).collect()] == [("0000000012", "ALPHA AIR", "AA", "c", 0)]
    for lacking in ("name", "citation"):
        with pytest.raises(dictionaries.DictionaryError):
            dictionaries.aliases(spark, [alias | {lacking: " "}])
    gold = dictionaries.gold(spark, {"companies": [{"ticker": "aa", "cik": 12, "registrant_names": ["A", 7]}], "tails": rows, "unpublished_tails": [{"n_number": "9", "must_not_ticker": "aa"}]})
    assert tuple(gold["companies"].first()) == ("AA", "0000000012", "", ["A", "7"], 0)
    assert gold["tails"].count() == 1 and tuple(gold["unpublished_tails"].first()) == ("N9", "AA", "", 0)
    good = {"n_number": "N1", "ticker": "AA", "stratum": "vanity", "split": "Train", "citation": "c"}
    assert tuple(dictionaries.rubric(spark, [good]).first()) == ("N1", "AA", "", "vanity", "train", "c", 0)
    bad = [[good, good], [good | {"citation": ""}], [good | {"split": "x"}], [good | {"stratum": "x"}], [good | {"must_not_ticker": "BB"}], [good | {"ticker": ""}]]
    bad += [[good | {"stratum": "not_our_join"}], [good | {"n_number": ""}], [good | {"n_number": f"N{k}"} for k in (1, 2, 3)]]
    for rows in bad:
        with pytest.raises(dictionaries.DictionaryError):
            dictionaries.rubric(spark, rows)


def test_dictionary_files(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "d.yaml").write_text("tickers: [aa, bb]\nneedles: [' ring ', '']\nmappings:\n- {n_number: N5, ticker: aa, cik: 12}\n")
    assert dictionaries.load_aviation_issuers(str(tmp_path / "d.yaml")) == (["AA", "BB"], ["RING"])
    assert [r.n_number for r in dictionaries.load_overrides(spark, str(tmp_path / "d.yaml")).collect()] == ["N5"]
    assert dictionaries.load_aliases(spark, str(tmp_path / "d.yaml")).count() == 0
