"""Token counts behind a digest cache.

A text's key is the SHA-256 of its content; a stored count also carries the digest of the tokenizer
file, so a new tokenizer version never meets old counts. Narrow (id, digest) rows are joined to the
stored counts; of the digests that miss, one document each is encoded, and the new counts are appended.
Texts are not shuffled: the documents to encode are selected in place by bitmaps of (id, digest), see
``keep_rows``. A text that very many documents repeat is dealt over several tasks in both joins.

Defined results: null text counts as empty, 0 tokens. Rows may repeat ids or texts, and ids may be null; every
row gets its text's count. Texts of any length are encoded whole. Normalisation is the tokenizer's own, so that counts are exactly its counts.
An empty table has no result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, hot_from, join_hot, keep_rows, materialize
from .wordhash import chunks

CACHE_SCHEMA = "digest string, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


_loaded: dict[str, object] = {}


def encoder(path: str):
    """texts -> token counts, by the library that the file's suffix names; loaded once per process."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _loaded[path] = lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            raise ValueError(f"no library for {path}")
    return _loaded[path]


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """digest, n_tokens for rows (digest, text); whole texts, in batches of about 1 MB."""

    def run(batches):
        count = encoder(path)
        for batch in batches:
            digest, text = batch.column(0), batch.column(1)
            for row, _, offsets in chunks(text):
                n = len(offsets) - 1
                counts = count(text.slice(row, n).to_pylist())
                yield pa.RecordBatch.from_arrays([digest.slice(row, n), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest string, n_tokens long")


class CountCache:
    """Stored counts: an appended Parquet table of (digest, version, n_tokens) in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, version: str) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        stored = self.spark.read.schema(CACHE_SCHEMA).parquet(self.path) if there else self.spark.createDataFrame([], CACHE_SCHEMA)
        return stored.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        counts.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(self.path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache: CountCache, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of ``docs`` (doc_id, text)."""
    version = tokenizer_version(tokenizer_path)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.sha2("text", 256))
    keyed = materialize(docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    texts = materialize(keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("_n")))
    hot = hot_from(texts, ["digest"], "_n")
    missing = texts.join(cache.read(version), "digest", "left_anti").select("digest", "first_id", F.lit(True).alias("missing"))
    # Of every digest that is not stored, the row with the smallest id is encoded.
    keys = join_hot(keyed.select("doc_id", "digest"), missing, ["digest"], "left", hot).groupBy("doc_id", "digest")
    chosen = F.coalesce(F.col("missing") & F.col("doc_id").eqNullSafe(F.col("first_id")), F.lit(False))
    decided = keys.agg(F.max(chosen).alias("keep"))
    misses = keep_rows(docs, decided, {"doc_id": F.col("doc_id"), "digest": F.col("digest")})
    # Rows alike in id and text cannot be told apart; their counts are the same.
    cache.append(encode_counts(misses, tokenizer_path).dropDuplicates(["digest"]), version)
    return join_hot(keyed, cache.read(version), ["digest"], hot=hot).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def scratch_cache(spark: SparkSession) -> CountCache:
    """An empty cache of its own in the shared folder, for a run that must count everything."""
    import uuid

    return CountCache(spark, f"{checkpoint_dir(spark)}/token_cache_{uuid.uuid4().hex}")
