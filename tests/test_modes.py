"""Source modes: every branch of where an input comes from; headers and records of registry files; the order of lines."""

import json
import sqlite3
import zipfile

import pytest

from hangarlight.operators import inputs, resolve
from hangarlight.operators.gates import GateError
from hangarlight.sources import filings, lines, modes, registry
from hangarlight.sources.modes import Cache, ChangedSource, MissingSource, Mode, Refused

from .test_sources import HEADER, REFERENCE, aircraft


def test_modes_of_flags():
    assert [Mode.of(*f) for f in ((False, False), (False, True), (True, False), (True, True))] == [Mode.FRESH, Mode.CACHE, Mode.OFFLINE, Mode.OFFLINE]
    assert [[m.local(e, t) for e, t in ((False, False), (False, True), (True, False), (True, True))] for m in Mode] == [
        [False, False, False, True], [False, True, False, True], [True, True, True, True]
    ]


def text(path):
    with open(path) as f:
        return f.read()


def test_an_input_is_fetched_cached_or_refused(tmp_path):
    cache = Cache(str(tmp_path / "cache"))
    calls = []

    def fetch(data=b"one"):
        calls.append(data)
        return data

    def refused():
        raise Refused("403")

    def broken():
        raise OSError("reset")

    get = lambda mode, f=fetch, **k: modes.resolve(cache, "t.json", mode, f, **k)
    for mode, f, error in ((Mode.OFFLINE, fetch, MissingSource), (Mode.FRESH, refused, Refused), (Mode.FRESH, broken, OSError), (Mode.FRESH, None, MissingSource)):
        with pytest.raises(error):
            get(mode, f)
    assert not calls and not cache.manifest()
    assert text(get(Mode.CACHE)) == "one" and calls == [b"one"]  # nothing cached yet
    assert text(get(Mode.CACHE, lambda: fetch(b"two"))) == text(get(Mode.OFFLINE)) == "one" and calls == [b"one"]
    assert text(get(Mode.FRESH, lambda: fetch(b"two"))) == "two"
    assert text(get(Mode.FRESH, refused)) == "two"
    with pytest.raises(OSError):
        get(Mode.FRESH, broken)
    named = tmp_path / "named.json"
    with pytest.raises(MissingSource):
        get(Mode.FRESH, explicit=str(named))
    named.write_text("own")
    assert {text(get(m, explicit=str(named))) for m in Mode} == {"own"} and len(calls) == 2
    (tmp_path / "cache" / "t.json").write_text("tampered")
    for mode, f in ((Mode.OFFLINE, None), (Mode.CACHE, fetch), (Mode.FRESH, refused)):
        with pytest.raises(ChangedSource):
            get(mode, f)
    assert text(get(Mode.FRESH)) == "one"
    (tmp_path / "cache" / "u.csv").write_text("by hand")
    assert text(modes.resolve(cache, "u.parquet", Mode.CACHE, fetch, others=("u.csv",))) == "by hand"


def test_inputs_of_a_refresh(spark, tmp_path):
    """What must be there, what may be missing, and what a missing or broken file counts as."""
    cache = tmp_path / "cache"
    cache.mkdir()
    at = inputs.Sources(str(cache), str(tmp_path / "work"), Mode.OFFLINE)
    with pytest.raises(MissingSource):
        inputs.load_aircraft(spark, at)
    with pytest.raises(MissingSource):
        inputs.load_companies(spark, at)
    with pytest.raises(MissingSource):
        inputs.load_subsidiaries(spark, at)
    assert inputs.load_addresses(spark, at).count() == inputs.load_licences(spark, at).count() == 0
    (cache / inputs.SUBSIDIARIES_CSV).write_text("parent_cik,parent_name,subsidiary_name\n")
    with pytest.raises(GateError):
        inputs.load_subsidiaries(spark, at)
    at.skip_subsidiaries = True
    assert inputs.load_subsidiaries(spark, at).count() == 0
    at.skip_subsidiaries = False
    at.subsidiaries = str(cache / inputs.SUBSIDIARIES_CSV)
    assert inputs.load_subsidiaries(spark, at).count() == 0  # a named file may be empty
    at.subsidiaries = None
    (cache / inputs.SUBSIDIARIES_CSV).write_text("parent_cik,parent_name,subsidiary_name\n12,Alpha Inc,Alpha Air LLC\n")
    assert inputs.load_subsidiaries(spark, at).count() == 1
    (cache / inputs.ADDRESSES).write_text(json.dumps([{"cik": "12", "street": "1 Main"}]))
    assert inputs.load_addresses(spark, at).first().street == "1 Main"
    at.licences_db = str(tmp_path / "broken.sqlite")
    (tmp_path / "broken.sqlite").write_text("no database")
    assert inputs.load_licences(spark, at).count() == 0
    with sqlite3.connect(tmp_path / "l.sqlite") as db:
        db.execute("create table licenses (uls_id text, n_number text, licensee_name text, deleted_at integer)")
        db.execute("insert into licenses values ('1', '5x', 'GAMMA INC', null)")
    at.licences_db = str(tmp_path / "l.sqlite")
    assert [r.n_number for r in inputs.load_licences(spark, at).collect()] == ["N5X"]
    tickers = json.dumps({"fields": ["cik", "name", "ticker", "exchange"], "data": [[12, "Alpha Inc", "AA", "NYSE"]]}).encode()
    at.mode, at.fetch = Mode.FRESH, {inputs.TICKERS: lambda: tickers}
    assert inputs.load_companies(spark, at).first().ticker == "AA"

    def refused():
        raise Refused("403")

    at.fetch = {inputs.TICKERS: refused}
    assert inputs.load_companies(spark, at).first().ticker == "AA"
    archive = tmp_path / "r.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("docs/MASTER.pdf", "x")
        z.writestr("a/Master.txt", f"{HEADER}\n1WM,9,ABC1,,,3,ALPHA INC,,,,,,,,,,,,5,5,V\n")
        z.writestr("MASTER2.txt", "later")
        z.writestr("acftref.TXT", REFERENCE)
    at.registry_zip = str(archive)
    at.mode, at.gold = Mode.OFFLINE, str(tmp_path / "none.yaml")
    found, label, options = inputs.load(spark, at)
    assert label == f"faa:{archive}" and options == {"offline": True, "skip_subsidiaries": False}
    assert [r[0] for r in aircraft(found.aircraft)] == ["N1WM"] and found.aircraft.first().make == "GULFSTREAM"
    assert found.overrides.count() == found.edgar_hits.count() == found.gold["tails"].count() == 0 and found.aviation_tickers == []
    decided = resolve.decide(found.aircraft, resolve.Evidence(found.companies, found.subsidiaries, found.edgar_hits, found.licences, found.overrides, found.unpublished), label)
    assert resolve.published(decided, "2026-09-01").first().ticker == "AA"
    archive.write_bytes(archive.read_bytes().replace(b"PK\x03\x04", b"PK\x03\x05"))
    with pytest.raises(Exception, match="BadZipFile|magic"):
        registry.unpack(spark, str(archive), str(tmp_path / "w"))


MASTER = HEADER + """
1WM,12345,GULG650,12345,2018,3,WALMART INC,702 SW 8TH ST,,BENTONVILLE,AR,72716,C,007,US,20240101,20180101,1N,5,5,V,12345678,N,20180101,,,,,,20280101,1,,,A00B1C
123AA,737,BOE737,1,2010,3,"AMERICAN ""AIR"", INC",1 SKYVIEW,,FORT WORTH,TX,76155,2,439,US,20240101,20100101,1T,5,5,V,1,Y,20100101,,,,,,20280101,2,,,A11111

9TEN,S9,X,,,,,,,,,,,,,,,,,,,,
7SEVEN,S7,X,,,,
6SIX,S6,X,,,
N-NUMBER,S,X,,,,,
,S,X,,,,,
"""
PARTS = "CODE,MFR,MODEL,TYPE-ACFT\nGULG650,GULFSTREAM AEROSPACE,GVI G650,5,5\nBOE737,BOEING,737-700\nBOE737,BOEING , 737-800,,,\n,X,Y\n"


def read(spark, tmp_path, master, parts=PARTS):
    for name, content in (("m.txt", master), ("r.txt", parts)):
        (tmp_path / name).write_text(content)
    rows = registry.read_master(spark, str(tmp_path / "m.txt"), registry.read_reference(spark, str(tmp_path / "r.txt")))
    return {r.n_number: r for r in rows.collect()}


def test_every_record_of_seven_fields_is_kept(spark, tmp_path):
    rows = read(spark, tmp_path, MASTER)
    assert sorted(rows) == ["N123AA", "N1WM", "N7SEVEN", "N9TEN"]
    one, two = rows["N1WM"], rows["N123AA"]
    assert (one.registrant_name, one.make, one.model, one.icao24, one.fractional_owner) == ("WALMART INC", "GULFSTREAM AEROSPACE", "GVI G650", "a00b1c", False)
    assert (two.registrant_name, two.make, two.model, two.fractional_owner, two.city) == ('AMERICAN "AIR", INC', "BOEING", "737-800", True, "FORT WORTH")
    assert (rows["N9TEN"].serial, rows["N9TEN"].status_code, rows["N9TEN"].make) == ("S9", "", "")


def test_a_file_without_names_is_read_by_position(spark, tmp_path):
    first = ",".join("x" * 30)
    row = "N1HD,99,GULG650,e,2017,3,HOME DEPOT INC,st,,ATLANTA,GA,30339,r,c,US,20240101,20170101,cert,5,5,V,ms,N,20170101,o1,o2,o3,o4,o5,A00FFF"
    rows = read(spark, tmp_path, f"﻿{first}\n{row}\n{first}\nN-Number ,{row[5:]}\n", "made up\nGULG650,G,650\ncode,x,y\n")
    assert sorted(rows) == ["N1HD", "NX"]  # a later line like the first is a record
    assert (rows["N1HD"].registrant_name, rows["N1HD"].icao24, rows["N1HD"].make) == ("HOME DEPOT INC", "a00fff", "G")


def test_headers_are_found_by_name(spark, tmp_path):
    """Columns that lack are empty; of equal names the last counts, of model codes the first; a reference in another order."""
    assert registry.resolve_header(HEADER.split(","))["icao24"] == 33
    lacking = "N-NUMBER,SERIAL,CODE,MFR MDL CODE,NAME,MODE S CODE,NAME,STREET\n1A,S1,ABC,XYZ,FIRST,77,LAST,1 MAIN\n"
    row = read(spark, tmp_path, lacking, "MFR,MODEL,CODE\nMAKER,M1,ABC\nOTHER,M2,XYZ\n")["N1A"]
    assert (row.serial, row.registrant_name, row.street, row.make, row.model) == ("S1", "LAST", "1 MAIN", "MAKER", "M1")
    assert (row.status_code, row.icao24, row.city, row.type_registrant) == ("", "", "", "")
    row = read(spark, tmp_path, lacking, "MFR,CODE\nMAKER,ABC\n")["N1A"]
    assert (row.make, row.model) == ("MAKER", "")
    assert read(spark, tmp_path, "", "") == read(spark, tmp_path, HEADER + "\n", "") == {}


def test_order_of_lines_does_not_depend_on_splits(spark, tmp_path):
    hit = {"cik": "12", "ticker": "AA", "accession": "0-1", "form": "10-K", "n_number": "N1WM", "snippet": "jet", "filing_url": "u", "keyword_hit": True}
    rows = [hit | {"accession": str(k), "n_number": f"N{100 + k % 7}"} for k in range(3000)]
    path = str(tmp_path / "hits.jsonl")
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (1 << 30, 150_000, 9_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            found = filings.read_edgar_hits(spark, path)
            assert found.rdd.getNumPartitions() >= (1 if size > 1 << 20 else 3)
            assert [r.accession for r in found.orderBy("ord").collect()] == [r["accession"] for r in rows]
            assert [r.value for r in lines.read_lines(spark, path).orderBy("ord").collect()] == [json.dumps(r) for r in rows]
            companies = spark.createDataFrame([("0000000012", "AA", "ALPHA")], "cik string, ticker string, name string")
            tails = spark.createDataFrame([(f"N{100 + k}",) for k in range(7)], "n_number string")
            first = resolve.edgar_evidence(found.withColumn("filing_url", found.accession), tails, companies)
            assert {r.n_number: r.edgar.url for r in first.collect()} == {f"N{100 + k}": str(k) for k in range(7)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
