"""Token ids in length-delimited binary records with masked checksums, and a separate offset index.

Format of a folder: data files ``*.rec``, an index file ``*.idx`` beside each, and the table ``manifest``, which names
the files that count, in order, with the records and tokens of each. All numbers are little-endian.

* A data file starts with ``RECORD_MAGIC`` and one byte, the width of an id (2 or 4). A record is the length of its
  payload (8 bytes), the masked CRC-32 of these 8 bytes, the payload, and the masked CRC-32 of the payload. A payload
  is the document's id (8 bytes), a byte that is 1 where that id is null, and the token ids.
* An index file starts with ``INDEX_MAGIC``; each entry has the record's offset, its document's id, the null byte
  and the number of tokens. The masked CRC-32 of all entries ends it.

Masking (rotate by 15 bits, add a constant) keeps checksums of data that hold checksums apart from their own.

Documents are range-partitioned by id, sorted in each task, encoded and written there; only one row a file reaches
the driver. A task that runs again writes files of other names, and only those of the attempt that ended are in the
manifest, which is written last. Readers take slices of files by the index, in order or in a shuffled order.

Defined results: null text counts as empty, its record holds the end id alone. Null ids come first. Rows that repeat an
id are ordered by a digest of their text; equal rows are interchangeable. An empty table gives a manifest without
files. Texts of any length are one record. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .subwords import encoder

RECORD_MAGIC, INDEX_MAGIC = b"TOKREC1\n", b"TOKIDX1\n"
#: A data file is closed once it holds so many bytes.
FILE_BYTES = 128 << 20
#: Bytes of data that one task reads back, and bytes of ids in one batch.
SLICE_BYTES, BATCH_BYTES = 32 << 20, 2 << 20
#: Pieces whose ids a process keeps; about 200 MB, beside 100 MB of words.
CACHE = 1 << 20
MANIFEST = "file string, part int, number int, width int, records long, tokens long, bytes long"
TOKENS = "doc_id long, start long, n_tokens long, ids binary"

_LENGTH, _CRC, _ID = "<Q", "<I", "<qB"
#: Bytes of a payload before its ids, and of a record around its payload.
_HEAD, _AROUND = struct.calcsize(_ID), 16
_ENTRY = np.dtype([("offset", "<u8"), ("doc_id", "<i8"), ("null", "u1"), ("tokens", "<u8")])


def masked(data: bytes) -> int:
    """The masked CRC-32."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(_LENGTH, len(payload))
    return b"".join((length, struct.pack(_CRC, masked(length)), payload, struct.pack(_CRC, masked(payload))))


class CorruptRecord(ValueError):
    """A checksum or a length does not fit."""


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """(payload, offset of the next record)."""
    head = bytes(data[at : at + 12])
    if len(head) < 12 or struct.unpack_from(_CRC, head, 8)[0] != masked(head[:8]):
        raise CorruptRecord(f"length at {at}")
    end = at + 12 + struct.unpack_from(_LENGTH, head)[0]
    payload = data[at + 12 : end]
    if end + 4 > len(data) or struct.unpack(_CRC, data[end : end + 4])[0] != masked(payload):
        raise CorruptRecord(f"payload at {at}")
    return payload, end + 4


def filesystem(path: str):
    """(file system, path on it) for a folder that all tasks share."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class _FileWriter:
    """One data file and its index."""

    def __init__(self, store, folder: str, name: str, width: int):
        self.store, self.base, self.name = store, f"{folder}/{name}", name
        self.out = store.open_output_stream(f"{self.base}.rec")
        self.at = self.out.write(RECORD_MAGIC + bytes([width]))
        self.entries, self.tokens = [], 0

    def add(self, doc_id: int | None, ids: bytes, n: int) -> None:
        record = frame(struct.pack(_ID, doc_id or 0, doc_id is None) + ids)
        self.entries.append((self.at, doc_id or 0, doc_id is None, n))
        self.at += self.out.write(record)
        self.tokens += n

    def close(self) -> tuple:
        self.out.close()
        entries = np.array(self.entries, dtype=_ENTRY).tobytes()
        with self.store.open_output_stream(f"{self.base}.idx") as index:
            index.write(INDEX_MAGIC + entries + struct.pack(_CRC, masked(entries)))
        return len(self.entries), self.tokens, self.at


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every document of ``docs`` (doc_id, text), each followed by ``end_id``, in ascending doc_id order."""
    spark = docs.sparkSession
    doc = F.col("doc_id").cast("long").alias("doc_id")
    docs = docs.select(doc, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("_digest", F.xxhash64("text"))
    store, folder = filesystem(path)
    store.create_dir(folder, recursive=True)

    def run(batches):
        from pyspark import TaskContext

        model, part = encoder(tokenizer_path, most=CACHE), TaskContext.get().partitionId()
        store, folder = filesystem(path)
        if end_id > 0xFFFF and model.dtype.itemsize == 2:
            raise ValueError("the end id is wider than the tokenizer's ids")
        end, width = model.pack([end_id]), model.dtype.itemsize
        done, writer = [], None

        def finish():
            done.append((f"{writer.name}.rec", part, len(done), width, *writer.close()))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    writer = _FileWriter(store, folder, f"part-{part:06d}-{len(done):06d}-{uuid.uuid4().hex}", width)
                ids = model.encode(text) + end
                writer.add(doc_id, ids, len(ids) // width)
                if writer.at >= file_bytes:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if done:
            columns = ("file", "part", "number", "width", "records", "tokens", "bytes")
            yield pa.RecordBatch.from_pylist([dict(zip(columns, d, strict=True)) for d in done], schema=_arrow(spark_schema))

    spark_schema = spark.createDataFrame([], MANIFEST).schema
    # Equal ids, and equal rows, are dealt over neighbouring tasks.
    order = [F.col("doc_id").asc_nulls_first(), F.col("_digest")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *order, F.col("_row"))
    sorted_ = dealt.sortWithinPartitions(*order, "text").select("doc_id", "text")
    files = sorted_.mapInArrow(run, spark_schema).collect()  # one row a file
    spark.createDataFrame(files, spark_schema).coalesce(1).write.parquet(f"{path}/manifest")


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _index(store, path: str) -> np.ndarray:
    with store.open_input_stream(path) as f:
        data = f.read()
    entries = data[len(INDEX_MAGIC) : -4]
    if data[: len(INDEX_MAGIC)] != INDEX_MAGIC or len(entries) % _ENTRY.itemsize or struct.unpack(_CRC, data[-4:])[0] != masked(entries):
        raise CorruptRecord(path)
    return np.frombuffer(entries, dtype=_ENTRY)


def _manifest(spark: SparkSession, path: str) -> list:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("part", "number").collect()  # one row a file


def _slices(spark: SparkSession, path: str, slice_bytes: int) -> DataFrame:
    """file, width, start, first, stop: ranges of records of about ``slice_bytes``, one a task; start counts all tokens
    of earlier files."""
    rows, start = [], 0
    for f in _manifest(spark, path):
        step = max(1, f.records * slice_bytes // f.bytes)
        rows += [(len(rows) + k, f.file, f.width, start, low, min(low + step, f.records)) for k, low in enumerate(range(0, f.records, step))]
        start += f.tokens
    slices = spark.createDataFrame(rows, "slice int, file string, width int, start long, first long, stop long")
    return slices.repartitionById(max(1, len(rows)), F.col("slice"))


def _batches(found, width: int):
    """Arrow batches of (doc_id, start, n_tokens, ids) for (doc_id, start, packed ids)."""

    def batch():
        ids = [x if width == 4 else np.frombuffer(x, "<u2").astype("<u4").tobytes() for _, _, x in rows]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += len(row[2])
        if size >= BATCH_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _document(payload: memoryview) -> tuple[int | None, bytes]:
    doc_id, null = struct.unpack_from(_ID, payload)
    return None if null else doc_id, bytes(payload[_HEAD:])


def _width(store, file: str) -> int:
    with store.open_input_stream(file) as f:
        head = f.read(len(RECORD_MAGIC) + 1)
    if head[:-1] != RECORD_MAGIC or head[-1] not in (2, 4):
        raise CorruptRecord(file)
    return head[-1]


def read_tokens(spark: SparkSession, path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, start (tokens of all records before it), n_tokens and ids (unsigned 32-bit, little-endian) of each record,
    read from the data files; both checksums of each record are tested."""

    def run(batches):
        store, folder = filesystem(path)

        def records(s):
            index = _index(store, f"{folder}/{s['file'][:-4]}.idx")
            starts = s["start"] + np.cumsum(index["tokens"]) - index["tokens"]
            at, first, stop = index["offset"].astype(np.int64), s["first"], s["stop"]
            if _width(store, f"{folder}/{s['file']}") != s["width"]:
                raise CorruptRecord(s["file"])
            with store.open_input_file(f"{folder}/{s['file']}") as f:
                size = f.size()
                while first < stop:
                    # Whole records of about a batch, or one long record.
                    last = max(first + 1, min(stop, int(np.searchsorted(at, at[first] + BATCH_BYTES))))
                    end = int(at[last]) if last < len(at) else size
                    data = memoryview(f.read_at(end - int(at[first]), int(at[first])))
                    place = 0
                    for k in range(first, last):
                        payload, place = unframe(data, place)
                        doc_id, ids = _document(payload)
                        if len(ids) != index["tokens"][k] * s["width"]:
                            raise CorruptRecord(f"{s['file']}: record {k}")
                        yield doc_id, int(starts[k]), ids
                    first = last

        for batch in batches:
            for s in batch.to_pylist():
                yield from _batches(records(s), s["width"])

    return _slices(spark, path, slice_bytes).mapInArrow(run, TOKENS)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """file, width, record, offset, doc_id, start, n_tokens of all records, from the index files alone."""

    def run(batches):
        store, folder = filesystem(path)
        for batch in batches:
            for s in batch.to_pylist():
                index = _index(store, f"{folder}/{s['file'][:-4]}.idx")
                for low in range(0, len(index), 1 << 16):
                    part = index[low : low + (1 << 16)]
                    n, tokens = len(part), index["tokens"].astype(np.int64)
                    starts = s["start"] + np.cumsum(tokens) - tokens
                    columns = [
                        pa.array([s["file"]] * n), pa.array([s["width"]] * n, pa.int32()), pa.array(np.arange(low, low + n)), pa.array(part["offset"].astype(np.int64)),
                        pa.array(part["doc_id"].astype(np.int64), mask=part["null"] > 0), pa.array(starts[low : low + n]), pa.array(part["tokens"].astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "width", "record", "offset", "doc_id", "start", "n_tokens"])

    schema = "file string, width int, record long, offset long, doc_id long, start long, n_tokens long"
    whole = 1 << 62
    return _slices(spark, path, whole).mapInArrow(run, schema)


def read_shuffled(spark: SparkSession, path: str, seed: int, parts: int) -> DataFrame:
    """All records in a pseudo-random order over ``parts`` ordered partitions: the index is shuffled, and each task
    fetches its records by offset."""
    place = F.xxhash64(F.lit(seed), F.col("file"), F.col("record"))
    index = read_index(spark, path).withColumn("_place", place).repartitionByRange(parts, "_place").sortWithinPartitions("_place")

    def run(batches):
        store, folder = filesystem(path)
        opened = {}
        for batch in batches:
            rows = batch.to_pylist()

            def fetch(rows=rows):
                for r in rows:
                    if r["file"] not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened))).close()
                        opened[r["file"]] = store.open_input_file(f"{folder}/{r['file']}")
                    payload = _HEAD + r["n_tokens"] * r["width"]
                    data = memoryview(opened[r["file"]].read_at(payload + _AROUND, r["offset"]))
                    doc_id, ids = _document(unframe(data, 0)[0])
                    yield doc_id, r["start"], ids

            widths = {r["width"] for r in rows}
            yield from _batches(fetch(), widths.pop() if widths else 4)

    return index.select("file", "width", "offset", "n_tokens", "start").mapInArrow(run, TOKENS)
