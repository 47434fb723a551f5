"""Benchmark decontamination by an FM-index over each shard of training texts.

Words are runs of ASCII letters and digits (lower-cased) and non-ASCII characters. Test phrases are the
windows of ``WINDOW`` consecutive words of each item; a shorter item is one phrase. Each task reads its
own documents in shards of bounded size, builds an index over the shard, searches all phrases of a block
backwards through wavelet ranks, locates the occurrences from sampled suffix positions and merges them
into spans of hit words. Texts are never shuffled.

The index's alphabet is the phrases' vocabulary. A word outside it can lie in no occurrence, and neither
can a run of vocabulary words shorter than the shortest phrase; such stretches become one separator, so
the suffix array covers only text that could match. This is exact.

Phrases go to the tasks in blocks of ``BLOCK_PHRASES``: the benchmark is the stated query set. For more
blocks the documents are read once per block, one block is in memory at a time, and hits are merged by document
and word.

Defined results: null text and text without words have no words and no hits; texts of any length are searched
whole. Items without words are no phrases; ids may be of any type and are reported as strings. Rows repeating a doc_id are
separate documents; rows repeating an item_id count as one item, those with null ids too, which no list of ids
names. Without items or documents there are no hits or no rows. Reports read doc_id and text alone; ``drop_contaminated``
keeps all columns, whatever their names.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .fmindex import FMIndex
from .wordhash import ALNUM, chunks, words

WINDOW = 10
BLOCK_PHRASES = 200_000
SHARD_WORDS = 1 << 21
SHARD_BYTES = 32 << 20
#: Shards of the filter, which runs beside whole rows in memory, are smaller.
DROP_WORDS = 1 << 19


class Phrases:
    """A block of phrases over a vocabulary of word hashes; symbol 0 ends, 1 separates, words follow."""

    def __init__(self, items: list[str | None], hashes: list[np.ndarray], window: int):
        #: Ids of the items; phrases name them by their place here.
        self.names = np.array(sorted(set(items), key=lambda i: (i is not None, i or "")), dtype=object)
        place = {name: k for k, name in enumerate(self.names)}
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.symbols = len(self.vocabulary) + 2
        # All windows of an item at once: rows of symbols, filled up with 0.
        tables = []
        for h in hashes:
            symbols = np.pad(np.searchsorted(self.vocabulary, h) + 2, (0, max(0, window - len(h))))
            tables.append(np.lib.stride_tricks.sliding_window_view(symbols, window))
        table = np.concatenate(tables) if tables else np.zeros((0, window), np.int64)
        owners = np.repeat(np.array([place[i] for i in items], dtype=np.int64), [len(t) for t in tables])
        # Each distinct phrase is searched once and stands for all its items.
        self.table, where = np.unique(table, axis=0, return_inverse=True)
        self.lengths = (self.table > 0).sum(axis=1)
        pairs = np.unique(np.stack([where.reshape(-1), owners], axis=1), axis=0)
        self.items = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(self.table) + 1))
        self.shortest = int(self.lengths.min()) if len(self.table) else 0
        #: One bit per low 20 bits of a vocabulary hash: most other words fail this cheap test.
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; 1 for words outside the vocabulary."""
        out = np.ones(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.sieve[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes[maybe]
        out[maybe[known]] = at[known] + 2
        return out


def item_words(benchmark: DataFrame) -> DataFrame:
    """item, words: the id as a string and the hashes of the words of each item that has some, made in tasks."""

    def run(batches):
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                hashes, _, _, bounds = words(data, offsets, ALNUM)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(bounds) - 1), lists], names=["item", "words"])

    known = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return known.mapInArrow(run, "item string, words array<long>").filter(F.size("words") > 0)


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_PHRASES):
    """Yield blocks of phrases, one at a time; word hashes stream through the driver by partition."""
    items, hashes, n = [], [], 0
    for row in item_words(benchmark).toLocalIterator():
        h = np.array(row["words"], dtype=np.int64).view(np.uint64)
        items.append(row["item"])
        hashes.append(h)
        n += max(1, len(h) - window + 1)
        if n >= size:
            yield Phrases(items, hashes, window)
            items, hashes, n = [], [], 0
    if items:
        yield Phrases(items, hashes, window)


def _runs(symbols: np.ndarray, bounds: np.ndarray, shortest: int):
    """Which words go into the index (runs of vocabulary words of one document, long enough to match), and where runs start."""
    inside = symbols > 1
    if not len(inside):
        return inside, inside
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(symbols)]
    starts[edges] = inside[edges]
    run = np.cumsum(starts)
    lengths = np.bincount(run[inside], minlength=int(run[-1]) + 1)
    return inside & (lengths[run] >= shortest), starts


def search_shard(phrases: Phrases, symbols: np.ndarray, bounds: np.ndarray):
    """Occurrences in one shard: (phrase, first word) over the shard's word positions."""
    keep, starts = _runs(symbols, bounds, phrases.shortest)
    positions = np.flatnonzero(keep)
    if not len(positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A separator in front of every run keeps phrases from crossing from one run into another.
    opens = starts[positions]
    place = np.arange(len(positions)) + np.cumsum(opens)
    text = np.ones(int(place[-1]) + 1, dtype=np.int64)
    text[place] = symbols[positions]
    back = np.zeros(len(text), dtype=np.int64)
    back[place] = positions
    index = FMIndex(text, phrases.symbols)
    phrase, at = index.locate(*index.search(phrases.table, phrases.lengths))
    return phrase, back[at]


def hits(phrases: Phrases, symbols: np.ndarray, bounds: np.ndarray):
    """Per document of a shard: merged spans [start, end) of hit words, and the items that occur."""
    phrase, at = search_shard(phrases, symbols, bounds)
    doc = np.searchsorted(bounds, at, side="right") - 1
    cover = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[phrase], -1)
    hit = np.cumsum(cover)[:-1] > 0
    spans, items = {}, {}
    for d in np.unique(doc):
        low, high = bounds[d], bounds[d + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[low:high].astype(np.int8), [0]])))
        spans[int(d)] = edge.reshape(-1, 2)
        own = np.unique(phrase[doc == d])
        items[int(d)] = phrases.names[np.unique(np.concatenate([phrases.items[phrases.item_at[p] : phrases.item_at[p + 1]] for p in own]))]
    return spans, items


FOUND = "doc_id long, row_key string, n_words long, spans array<struct<start:long,end:long,from:long,to:long>>, items array<string>"
_SPAN = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "from", "to")]))


def find(docs: DataFrame, phrases) -> DataFrame:
    """FOUND rows for every document: word spans with their byte ranges [from, to), and item ids."""

    def shard(block, parts):
        ids = pa.concat_arrays([p[0] for p in parts])
        keys = pa.concat_arrays([p[1] for p in parts])
        symbols = np.concatenate([p[2] for p in parts])
        shift = np.cumsum([0, *(len(p[2]) for p in parts)])
        bounds = np.concatenate([p[3][:-1] + s for p, s in zip(parts, shift, strict=False)] + [[len(symbols)]])
        byte_from = np.concatenate([p[4] for p in parts])
        byte_to = np.concatenate([p[5] for p in parts])
        spans, items = hits(block, symbols, bounds)
        n = np.diff(bounds)
        span_rows = [
            [
                {"start": int(a), "end": int(b), "from": int(byte_from[bounds[d] + a]), "to": int(byte_to[bounds[d] + b - 1])}
                for a, b in spans.get(d, ())
            ]
            for d in range(len(n))
        ]
        item_rows = [items[d].tolist() if d in items else [] for d in range(len(n))]
        return pa.RecordBatch.from_arrays(
            [ids, keys, pa.array(n), pa.array(span_rows, _SPAN), pa.array(item_rows, pa.list_(pa.string()))],
            names=["doc_id", "row_key", "n_words", "spans", "items"],
        )

    def run(batches):
        block = phrases.value
        parts, size, held = [], 0, 0
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                h, starts, ends, bounds = words(data, offsets, ALNUM)
                doc_start = np.repeat(offsets[:-1], np.diff(bounds))
                n = len(offsets) - 1
                parts.append(
                    (batch.column(0).slice(row, n), batch.column(2).slice(row, n), block.encode(h), bounds, starts - doc_start, ends - doc_start)
                )
                size, held = size + len(h), held + len(data)
                if size >= SHARD_WORDS or held >= SHARD_BYTES:
                    yield shard(block, parts)
                    parts, size, held = [], 0, 0
        if parts:
            yield shard(block, parts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("row_key").cast("string")).mapInArrow(run, FOUND)


def _none(docs: DataFrame) -> DataFrame:
    """FOUND rows where there are no phrases at all."""
    bare = Phrases(["0"], [np.zeros(1, np.uint64)], 1)
    return find(docs, docs.sparkSession.sparkContext.broadcast(bare)).withColumns(
        {"spans": F.filter("spans", lambda x: F.lit(False)), "items": F.filter("items", lambda x: F.lit(False))}
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK_PHRASES) -> DataFrame:
    """FOUND columns for each row of ``docs`` (doc_id, text), from all phrases of ``benchmark`` (item_id, text)."""
    send = docs.sparkSession.sparkContext.broadcast
    blocks = phrase_blocks(benchmark, window, block)
    first, second = next(blocks, None), next(blocks, None)
    bare = docs.select("doc_id", "text", F.lit("").alias("row_key"))
    if first is None:
        return _none(bare).drop("row_key")
    if second is None:
        return find(bare, send(first)).drop("row_key")
    # Rows are told apart by id and text digest; equal rows have equal results, so one row each is searched.
    keyed = docs.select("doc_id", "text", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("row_key"))
    found = None
    for phrases in itertools.chain([first, second], blocks):
        sent = send(phrases)
        part = materialize(find(keyed, sent))
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    one = found.groupBy("row_key", "doc_id", "n_words").agg(
        F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    start = F.array_sort("spans")
    # Overlapping or touching spans of different blocks become one.
    merged = F.aggregate(
        start,
        F.array().cast("array<struct<start:bigint,end:bigint,from:bigint,to:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                        F.element_at(acc, -1)["from"].alias("from"),
                        F.greatest(F.element_at(acc, -1)["to"], x["to"]).alias("to"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    times = keyed.groupBy("row_key").agg(F.count("*").cast("int").alias("times"))
    return (
        one.withColumn("spans", merged)
        .join(times, "row_key")
        .withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
        .select("doc_id", "n_words", "spans", "items")
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    found = contamination(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    ids = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _hit_documents(phrases: Phrases, shard: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which documents of a shard, given as (symbols, word bounds) of its parts, hold an occurrence."""
    shift = np.cumsum([0, *(len(s) for s, _ in shard)])
    bounds = np.concatenate([b[:-1] + s for (_, b), s in zip(shard, shift, strict=False)] + [shift[-1:]])
    _, at = search_shard(phrases, np.concatenate([s for s, _ in shard]), bounds)
    return np.unique(np.searchsorted(bounds, at, side="right") - 1)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK_PHRASES) -> DataFrame:
    """The documents without any hit word, with all their columns, judged in place row by row."""
    send = docs.sparkSession.sparkContext.broadcast
    at_text = docs.columns.index("text")
    for k, block_phrases in enumerate(phrase_blocks(benchmark, window, block)):
        if k:
            docs = materialize(docs)
        phrases = send(block_phrases)

        def run(batches, phrases=phrases):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                shard, first, size = [], 0, 0
                # Only the symbols of a shard are held, not the hashes of a batch.
                for row, data, offsets in chunks(batch.column(at_text)):
                    hashes, _, _, bounds = words(data, offsets, ALNUM)
                    shard.append((phrases.value.encode(hashes), bounds))
                    size += len(hashes)
                    if size >= DROP_WORDS or row + len(offsets) - 1 == batch.num_rows:
                        keep[first + _hit_documents(phrases.value, shard)] = False
                        shard, first, size = [], row + len(offsets) - 1, 0
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
