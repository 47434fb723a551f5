"""Alignment of two tokenizers' tokens over the same bytes, by packed bitsets of token ends.

The documents of a chunk lie end to end as bytes. Each tokenizer marks the last byte of each of its tokens in a
bitset packed into 64-bit words, beside a directory of the set bits before each word. AND of both bitsets has the shared
cuts, which divide a document into groups; OR has the ends of all stretches on which one token of each lies, so each of
its bits is one link (a pair of overlapping occurrences). Popcount ranks map a cut to the number of tokens that end
before it: the token ranges of groups, and the two tokens of a link.

How many documents hold a pair is counted over all rows: each row's distinct pairs are written beside its figures, then
exploded and counted with map-side sums. Scores then go back to the rows in two parts, always both: the most frequent
pairs, at most ``HOT_PAIRS`` of them, are sent to all tasks as sorted arrays and looked up where the rows lie; what a
row holds of other pairs is joined to their counts, summed by row and added. So frequent pairs are never shuffled a
row, and nothing that grows is broadcast. The largest count of each A id is an array as long as A's vocabulary.

Defined results: null and empty texts, and texts whose tokens' bytes by A or B are not a blank and the text (unknown
characters, normalisation), have no tokens: zeros and an empty groups text. Repeated rows and ids count as rows of their own,
null ids too. An empty table has no result. Texts of any length are aligned whole; the groups text of one document
must fit 2 GB. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .subwords import encoder
from .wordhash import chunks

#: Pairs whose counts are sent to all tasks, 12 bytes each.
HOT_PAIRS = 1 << 18
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, n array<int>"


class Bitset:
    """Bits of the places 0 to size - 1, packed, with ranks."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, places: np.ndarray, size: int) -> Bitset:
        bits = np.zeros((size + 64) // 64 * 64, dtype=bool)
        bits[places] = True
        return cls(np.packbits(bits, bitorder="little").view("<u8"))

    def __and__(self, other: Bitset) -> Bitset:
        return Bitset(self.words & other.words)

    def __or__(self, other: Bitset) -> Bitset:
        return Bitset(self.words | other.words)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def select(self) -> np.ndarray:
        """Places of all set bits, in order."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class Tokens:
    """A tokenizer's bytes and written ids by id."""

    def __init__(self, model):
        found = model.token_bytes()
        self.lengths = np.array([len(x) for x in found], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(b"".join(found) or b"\0", dtype=np.uint8)
        self.size = len(found)
        self.named = {end: np.array([b"%d%b" % (k, end) for k in range(self.size)], dtype=object) for end in (b",", b"|", b";")}

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, end to end."""
        lengths = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.data[at + np.arange(len(at))]


_tokens: dict[str, Tokens] = {}


def tokens_of(path: str, model) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(model)
    return _tokens[path]


def _counts(packed: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids of each document)."""
    return np.frombuffer(b"".join(packed), dtype=dtype).astype(np.int64), np.array([len(p) // dtype.itemsize for p in packed], dtype=np.int64)


def _misspelt(ids: np.ndarray, counts: np.ndarray, tokens: Tokens, text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents whose tokens are not spelt like their text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    wrong = np.bincount(doc, tokens.lengths[ids], len(counts)).astype(np.int64) != np.diff(bounds)
    good = ~wrong[doc]
    spelt = tokens.spell(ids[good])
    byte_doc = np.repeat(np.arange(len(counts)), np.diff(bounds))
    fits = ~wrong[byte_doc]
    wrong[byte_doc[fits][spelt != text[fits]]] = True
    return wrong


class Alignment:
    """Groups and links of the documents of a chunk. ``text`` has the bytes of all, ``bounds`` where each starts."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_tokens: Tokens, b_tokens: Tokens, bounds: np.ndarray):
        size = int(bounds[-1])
        self.a, self.b, self.tables = a, b, (a_tokens, b_tokens)
        a_ends = Bitset.of(np.cumsum(a_tokens.lengths[a]) - 1, size)
        b_ends = Bitset.of(np.cumsum(b_tokens.lengths[b]) - 1, size)
        self.cuts = (a_ends & b_ends).select()
        self.a_until, self.b_until = a_ends.rank(self.cuts + 1), b_ends.rank(self.cuts + 1)
        links = (a_ends | b_ends).select()
        self.link_a, self.link_b = a[a_ends.rank(links)], b[b_ends.rank(links)]
        self.cut_doc = np.searchsorted(bounds, self.cuts, side="right") - 1
        self.link_doc = np.searchsorted(bounds, links, side="right") - 1

    def groups(self, n_docs: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        a_table, b_table = (t.named for t in self.tables)
        a_size, b_size = np.diff(self.a_until, prepend=0), np.diff(self.b_until, prepend=0)
        a_names, b_names = a_table[b","][self.a], b_table[b","][self.b]
        a_names[self.a_until - 1] = a_table[b"|"][self.a[self.a_until - 1]]
        b_names[self.b_until - 1] = b_table[b";"][self.b[self.b_until - 1]]
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        out[np.arange(len(self.a)) + np.repeat(self.b_until - b_size, a_size)] = a_names
        out[np.arange(len(self.b)) + np.repeat(self.a_until, b_size)] = b_names
        last = np.searchsorted(self.cut_doc, np.arange(n_docs), side="right")
        ends = np.concatenate([[0], self.a_until + self.b_until])[last]
        names, low, made = out.tolist(), 0, []
        for high in ends.tolist():
            made.append(b"".join(names[low:high])[:-1])
            low = high
        return made

    def pairs(self, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each document: (offsets of documents, A ids, B ids, links)."""
        b_size = self.tables[1].size
        span = self.tables[0].size * b_size
        key, n = np.unique(self.link_doc * span + self.link_a * b_size + self.link_b, return_counts=True)
        pair = key % span
        return np.searchsorted(key // span, np.arange(n_docs + 1)), pair // b_size, pair % b_size, n


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups (the ids of each group, as text) and a, b, n: the linked id
    pairs with their numbers of links. A encodes a blank and the text, B the text, to which it adds the blank itself."""

    def run(batches):
        a_model, b_model = encoder(a_path, True), encoder(b_path)
        a_tokens, b_tokens = tokens_of(a_path, a_model), tokens_of(b_path, b_model)
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                raw = data.tobytes()
                spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                texts = [raw[x:y].decode() for x, y in spans]
                a, a_n = _counts([a_model.encode(t, True) if t else b"" for t in texts], a_model.dtype)
                b, b_n = _counts([b_model.encode_spaced(t) for t in texts], b_model.dtype)
                spaced = np.frombuffer(b"".join(b" " + raw[x:y] if y > x else b"" for x, y in spans), dtype=np.uint8)
                lengths = np.array([y - x + (y > x) for x, y in spans], dtype=np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                wrong = _misspelt(a, a_n, a_tokens, spaced, bounds) | _misspelt(b, b_n, b_tokens, spaced, bounds)
                a, b = a[~np.repeat(wrong, a_n)], b[~np.repeat(wrong, b_n)]
                a_n[wrong] = b_n[wrong] = lengths[wrong] = 0
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                n_docs = len(spans)
                found = Alignment(a, b, a_tokens, b_tokens, bounds)
                at, pair_a, pair_b, pair_n = found.pairs(n_docs)
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (pair_a, pair_b, pair_n)]
                numbers = (a_n, b_n, np.bincount(found.cut_doc, minlength=n_docs), np.bincount(found.link_doc, minlength=n_docs))
                columns = [batch.column(0).slice(row, n_docs), *[pa.array(x, pa.int64()) for x in numbers], pa.array(found.groups(n_docs), pa.binary()).cast(pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, docs: the number of rows that hold each linked id pair."""
    return aligned.select(F.explode(F.arrays_zip("a", "b")).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("docs"))


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least number of documents such that at most ``most`` pairs have so many; found on rounded counts."""
    grade = F.floor(F.log2("docs") * 16).cast("int")
    of_grade = counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("n"), F.min("docs").alias("least"), F.max("docs").alias("largest"))
    grades = of_grade.orderBy(F.desc("grade")).collect()
    least, total = grades[0]["largest"] + 1 if grades else 1, 0
    for g in grades:  # at most 64 x 16 rows
        total += g["n"]
        if total > most:
            break
        least = g["least"]
    return least


def score_links(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The rows of ``aligned`` with n_best (links whose pair is held by as many documents as any pair of their A id) and
    count_sum (the documents that hold each link's pair, summed over links) in place of the lists.

    ``aligned`` should be a stored table.
    """
    spark = aligned.sparkSession
    counts = materialize(pair_counts(aligned))
    least = _hot_from(counts, hot_pairs)
    best = counts.groupBy("a").agg(F.max("docs").alias("best"))
    # At most HOT_PAIRS rows, and one row an id of A's vocabulary.
    hot, top = counts.filter(F.col("docs") >= least).toArrow(), best.toArrow()
    keys = _keys(hot["a"].to_numpy(), hot["b"].to_numpy())
    order = np.argsort(keys)
    by_id = np.zeros(int(max(top["a"].to_numpy(), default=0)) + 1, dtype=np.int64)
    by_id[top["a"].to_numpy()] = top["best"].to_numpy()
    sent = spark.sparkContext.broadcast((keys[order], hot["docs"].to_numpy()[order], by_id))
    kept = [c for c in aligned.columns if c not in ("a", "b", "n")]
    numbered = aligned.select(F.monotonically_increasing_id().alias("_row"), *kept, "a", "b", "n")

    def run(batches):
        keys, docs, by_id = sent.value
        for batch in batches:
            a, b, n = (batch.column(batch.num_columns - 3 + k) for k in range(3))
            sizes = np.diff(a.offsets.to_numpy())
            row = np.repeat(np.arange(len(a)), sizes)
            a, b, n = (x.flatten().to_numpy().astype(np.int64) for x in (a, b, n))
            key = _keys(a, b)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            known = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
            count = docs[at[known]]
            sums = np.zeros((2, len(sizes)), dtype=np.int64)
            np.add.at(sums[0], row[known], n[known] * (count == by_id[a[known]]))
            np.add.at(sums[1], row[known], n[known] * count)
            left = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=len(sizes)))])
            lists = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~known], pa.int32())) for x in (a, b, n)]
            columns = [*batch.columns[:-3], pa.array(sums[0]), pa.array(sums[1]), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-3], "n_best", "count_sum", "a", "b", "n"])

    types = {f.name: f.dataType.simpleString() for f in numbered.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in ["_row", *kept]) + ", n_best long, count_sum long, a array<int>, b array<int>, n array<int>"
    known = numbered.mapInArrow(run, schema)
    # The row numbers are the stored table's, the same in each reading.
    rest = known.select("_row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("_row", "p.a", "p.b", "p.n")
    cold = counts.filter(F.col("docs") < least).join(F.broadcast(best), "a")
    more = rest.join(cold, ["a", "b"]).groupBy("_row").agg(
        F.sum(F.when(F.col("docs") == F.col("best"), F.col("n")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("docs")).alias("_sum")
    )
    return known.drop("a", "b", "n").join(more, "_row", "left").select(
        *kept,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)
