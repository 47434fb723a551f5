"""Aircraft registry sources: the published zip of CSV files, the CSV files themselves, or a SQLite copy.

The zip is inflated by a task into a shared folder. CSV lines are split by column expressions that know how many fields a
line has, so empty fields at its end count; the driver sees the header line alone.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import canonical_icao24, canonical_n_number
from .files import filesystem
from .lines import read_lines
from .schemas import AIRCRAFT_COLUMNS

# Field positions of files without a header.
POSITIONS = {
    "n_number": 0, "serial": 1, "mfr_mdl_code": 2, "type_registrant": 5, "registrant_name": 6, "street": 7, "city": 9, "state": 10,
    "type_aircraft": 18, "type_engine": 19, "status_code": 20, "icao24": 29, "fractional_owner": 22,
}
REFERENCE_POSITIONS = {"code": 0, "make": 1, "model": 2}
# Header names after upper-casing and removal of everything but letters and digits.
HEADERS = {
    "n_number": ("NNUMBER",), "serial": ("SERIALNUMBER", "SERIAL"), "mfr_mdl_code": ("MFRMDLCODE", "CODE"), "type_registrant": ("TYPEREGISTRANT",),
    "registrant_name": ("NAME",), "street": ("STREET",), "city": ("CITY",), "state": ("STATE",), "type_aircraft": ("TYPEAIRCRAFT",),
    "type_engine": ("TYPEENGINE",), "status_code": ("STATUSCODE",), "icao24": ("MODESCODEHEX",), "fractional_owner": ("FRACTOWNER",),
}
REFERENCE_HEADERS = {"code": ("MFRMDLCODE", "CODE"), "make": ("MFR",), "model": ("MODEL",)}
#: Fields of which the first of several columns counts; of the others the last.
FIRST_COUNTS = ("mfr_mdl_code", "code")
MIN_FIELDS = 7
#: A field with its comma: quoted, with doubled quotes inside and whatever follows the last quote, or plain.
_FIELD = r'("(?:[^"]++|"")*+"[^,]*+|[^,]*+),'


def unpack(spark: SparkSession, zip_path: str, folder: str) -> dict[str, str]:
    """Inflate the registry and reference members into ``folder``, which all executors share: {'MASTER': path, 'ACFTREF': path}.

    One task streams the members and checks their CRC; its paths alone reach the driver. The first member whose name holds a
    kind and ends in .txt counts. A task that runs again writes files of other names.
    """

    def run(batches):
        import io
        import shutil
        import zipfile

        import pyarrow as pa

        store, target = filesystem(folder)
        store.create_dir(target, recursive=True)
        for content in (c for batch in batches for c in batch.column(0)):
            rows = []
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                for member in archive.namelist():
                    upper = member.upper()
                    for kind in ("MASTER", "ACFTREF"):
                        if kind in upper and upper.endswith(".TXT") and kind not in {r["kind"] for r in rows}:
                            name = f"{kind}-{uuid.uuid4().hex}.txt"
                            with archive.open(member) as source, store.open_output_stream(f"{target}/{name}") as out:
                                shutil.copyfileobj(source, out, 1 << 20)
                            rows.append({"kind": kind, "name": name})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    made = spark.read.format("binaryFile").load(zip_path).select("content").mapInArrow(run, "kind string, name string").collect()
    found = {r.kind: f"{folder}/{r.name}" for r in made}
    for kind in ("MASTER", "ACFTREF"):
        if kind not in found:
            raise ValueError(f"{os.path.basename(zip_path)} has no {kind} member")
    return found


def split_fields(line: Column) -> Column:
    """All fields of a CSV line, unquoted and trimmed, empty ones at its end as well."""

    def value(field: Column) -> Column:
        inner = F.regexp_extract(field, r'^"((?:[^"]++|"")*+)"', 1)
        rest = F.regexp_extract(field, r'^"(?:[^"]++|"")*+"(.*)$', 1)
        plain = F.when(field.rlike(r'^"(?:[^"]++|"")*+"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(field)
        return F.regexp_replace(plain, r"^\s+|\s+$", "")

    return F.transform(F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(_FIELD), F.lit(1)), value)


def resolve_header(names: list[str], headers: dict[str, tuple[str, ...]] = HEADERS) -> dict[str, int | None]:
    """The place of each field by its header name; None for fields that no column names."""
    bare = [re.sub("[^A-Z0-9]", "", n.upper()) for n in names]
    places = {field: [k for k, name in enumerate(bare) if name in wanted] for field, wanted in headers.items()}
    return {field: (p[0] if field in FIRST_COUNTS else p[-1]) if p else None for field, p in places.items()}


def read_records(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """(fields of the first line, later lines): cells (array of all fields) and ord (the line's place).

    A record is one line. Blank lines are no records.
    """
    lines = read_lines(spark, path).select("ord", F.regexp_replace("value", "^\ufeff", "").alias("value")).filter(F.trim("value") != "")
    first = lines.agg(F.min(F.struct("ord", "value")).alias("r")).select("r.value", split_fields(F.col("r.value")).alias("names")).first()
    if first.value is None:
        return [], spark.createDataFrame([], "cells array<string>, ord long")
    # Of lines that are spelt like the first one, the first is the header.
    alike = lines.filter(F.col("value") == first.value).withColumn("_k", F.row_number().over(Window.orderBy("ord"))).filter("_k > 1").drop("_k")
    later = lines.filter(F.col("value") != first.value).unionByName(alike)
    return first.names, later.select(split_fields(F.col("value")).alias("cells"), "ord")


def _cell(place: int | None) -> Column:
    """The field at ``place``; '' where the line or the header has none."""
    return F.lit("") if place is None else F.regexp_replace(F.coalesce(F.get("cells", place), F.lit("")), ",+$", "")


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """code, make, model of an aircraft reference file, by its header's names, else by position; later rows win."""
    names, rows = read_records(spark, path)
    named = any(n.strip().upper() in ("CODE", "MFR") for n in names)
    at = resolve_header(names, REFERENCE_HEADERS) if named else REFERENCE_POSITIONS
    cells = rows.select(F.upper(_cell(at["code"])).alias("code"), _cell(at["make"]).alias("make"), _cell(at["model"]).alias("model"), "ord")
    kept = cells.filter("code <> '' and code <> 'CODE'")
    return kept.groupBy("code").agg(F.max_by(F.struct("make", "model"), "ord").alias("r")).select("code", "r.*")


def read_master(spark: SparkSession, path: str, reference: DataFrame) -> DataFrame:
    """Aircraft rows of a MASTER file: every line of seven fields or more. The first line is the header; where it
    names columns, fields are found by name and those it lacks are empty, else they are found by position."""
    names, rows = read_records(spark, path)
    named = any(n.replace(" ", "").upper() == "N-NUMBER" for n in names)
    at = resolve_header(names) if named else POSITIONS
    key = _cell(at["n_number"])
    kept = rows.filter(F.size("cells") >= MIN_FIELDS).filter((key != "") & (F.upper(key) != "N-NUMBER"))
    if not named:
        kept = kept.filter(F.upper(F.replace(F.get("cells", 0), F.lit(" "), F.lit(""))) != "N-NUMBER")
    plain = kept.select(
        canonical_n_number(key).alias("n_number"),
        *(_cell(at[f]).alias(f) for f in AIRCRAFT_COLUMNS[1:10]),
        canonical_icao24(_cell(at["icao24"])).alias("icao24"),
        (F.upper(_cell(at["fractional_owner"])) == "Y").alias("fractional_owner"),
        F.upper(_cell(at["mfr_mdl_code"])).alias("code"),
    )
    return _with_reference(plain, reference)


def _with_reference(plain: DataFrame, reference: DataFrame) -> DataFrame:
    """Left lookup of make and model; unknown codes give empty strings."""
    joined = plain.join(reference, "code", "left")
    named = [F.coalesce(c, F.lit("")).alias(c) if c in ("make", "model") else F.col(c) for c in AIRCRAFT_COLUMNS]
    return joined.select(*named, "fractional_owner")


def read_zip(spark: SparkSession, zip_path: str, folder: str) -> DataFrame:
    paths = unpack(spark, zip_path, folder)
    return read_master(spark, paths["MASTER"], read_reference(spark, paths["ACFTREF"]))


def from_tables(aircraft: DataFrame, reference: DataFrame) -> DataFrame:
    """Aircraft from the tables of a database copy: current rows only, codes joined as they are.

    Nulls in required columns raise, as a typed read would.
    """
    required = ["n_number", "serial_number", "type_registrant", "owner_name", "street", "city", "state", "type_aircraft", "type_engine", "status_code", "icao24"]
    strict = [F.coalesce(c, F.raise_error(F.lit(f"null in {c}"))).alias(c) for c in required]
    plain = aircraft.filter("is_current = 1").select(*strict, "fractional_owner", F.col("mfr_mdl_code").alias("code"))
    renamed = plain.withColumnsRenamed({"serial_number": "serial", "owner_name": "registrant_name"})
    renamed = renamed.withColumn("n_number", canonical_n_number(F.col("n_number"))).withColumn("icao24", canonical_icao24(F.col("icao24")))
    flag = F.upper(F.trim(F.col("fractional_owner").cast("string"))).isin("Y", "1", "TRUE")
    once = reference.select("code", F.col("mfr").alias("make"), "model")
    return _with_reference(renamed.withColumn("fractional_owner", F.coalesce(flag, F.lit(False))), once)


def read_sqlite_table(spark: SparkSession, path: str, name: str, schema: str, columns: str, where: str = "1=1", rows: int = 200_000) -> DataFrame:
    """A table of a SQLite file in a folder that all executors share, read by tasks in ranges of row ids.

    The driver asks for the range of row ids only; each task streams its own ``rows`` of it, read-only.
    """
    import sqlite3

    import pyarrow as pa

    target = spark.createDataFrame([], schema).schema
    names = target.names
    types = [{"int": pa.int32(), "bigint": pa.int64()}.get(f.dataType.simpleString(), pa.string()) for f in target]

    def opened():
        return sqlite3.connect(f"file:{path}?mode=ro", uri=True)

    with opened() as db:
        low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {name}").fetchone()
    if low is None:
        return spark.createDataFrame([], schema)

    def run(batches):
        with opened() as db:
            for start in (s for batch in batches for s in batch.column(0).to_pylist()):
                cursor = db.execute(f"SELECT {columns} FROM {name} WHERE ({where}) AND rowid >= ? AND rowid < ?", (start, start + rows))
                while found := cursor.fetchmany(20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

    starts = spark.range(low, high + 1, rows, numPartitions=(high - low) // rows + 1)
    return starts.mapInArrow(run, target)


def read_sqlite(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft from a SQLite registry copy with tables aircraft and aircraft_ref."""
    columns = "n_number, serial_number, type_registrant, owner_name, street, city, state, type_aircraft, type_engine, status_code, fractional_owner, icao24, mfr_mdl_code, is_current"
    schema = ", ".join(f"{c.strip()} string" for c in columns.split(",")[:-1]) + ", is_current int"
    aircraft = read_sqlite_table(spark, path, "aircraft", schema, columns, "is_current = 1")
    reference = read_sqlite_table(spark, path, "aircraft_ref", "code string, mfr string, model string", "code, mfr, model")
    return from_tables(aircraft, reference)
