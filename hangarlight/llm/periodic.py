"""Periodic runs in the word sequence of a text: suffix array, LCP, longest previous factors, LZ blocks, extensions, copies.

Words are numbered by an exact dictionary, and the documents of a chunk are handled as one array of numbers in which no
two documents share a number.

1. Prefix doubling sorts all suffixes; the ranks after each doubling are kept. They tell in one comparison whether two
   stretches of 2^k words are equal, so the longest common extension of many pairs, forwards or backwards, takes one
   vectorised step a level, exactly. LCP of neighbours in the suffix array comes from them.
2. Suffix array and LCP give each word's longest previous factor and its place, by one pass over a stack.
3. Longest previous factors cut a document into LZ blocks.
4. Main's extensions: a run of exponent e or more that touches the boundary of two blocks u, v has a period of at most
   (|u| + |v|) / (e - 1). For if the first boundary from a period after its start on lies inside it, the block from
   there reaches at least to its end, and the block before starts less than a period after its start; if there is
   none, one block holds all of it but less than a period. At each boundary b every such period q is tried: words q
   apart agree in one stretch around b or around b - q, which extensions both ways measure.
5. A run that touches no boundary lies inside a block, and its copy in the block's earlier occurrence is a run too. Runs
   are kept in buckets by start; each block takes those of its source over, from left to right.

Of equal stretches the smallest period is kept: a stretch of four periods that has a smaller one has it over all of
its length, and both are found.

Defined results: null text has no words and no runs. Null ids and repeated rows are judged row by row. An empty table has no
result. Very long texts are one chunk each; about 4 bytes a word and doubling are held, 2^k words being the longest
repeat. Words are runs of characters other than ASCII white space. Columns besides the two named ones are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordhash import chunks

MIN_LENGTH, MIN_EXPONENT = 6, 4
_WORD = re.compile(rb"[^ \t-\r]+")
RUN = "struct<start:long,length:long,period:long>"


class Suffixes:
    """All suffixes of the documents of a chunk: ``ids`` are word numbers, ``bounds`` the documents' first words."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        n = len(ids)
        self.n, self.bounds = n, bounds
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        end = bounds[1:][doc]
        first = doc * (int(ids.max(initial=0)) + 1) + ids
        order = np.argsort(first, kind="stable")
        rank = np.full(n + 1, -1, dtype=np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = first[order][1:] != first[order][:-1]
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.levels = [rank]
        active = order[~self._alone(new)]
        while len(active):
            step = 1 << len(self.levels) - 1
            behind = np.minimum(active + step, n)
            second = np.where(active + step < end[active], rank[behind], -1)
            key = rank[active] * (n + 1) + second + 1
            place = np.argsort(key, kind="stable")
            active, key = active[place], key[place]
            old, at = rank[active], np.arange(len(active))
            new = np.ones(len(active), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            group = np.ones(len(active), dtype=bool)
            group[1:] = old[1:] != old[:-1]
            offset = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
            rank = rank.copy()
            rank[active] = old + offset
            self.levels.append(rank)
            active = active[~self._alone(new)]
        self.order = np.empty(n, dtype=np.int64)
        self.order[rank[:-1]] = np.arange(n)

    @staticmethod
    def _alone(new: np.ndarray) -> np.ndarray:
        """Members of groups of one, where ``new`` marks the first of each group."""
        return new & np.append(new[1:], True)

    def forwards(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``i`` and ``j`` (unequal) share from their starts on."""
        length = np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            rank = self.levels[k]
            length += (rank[i + length] == rank[j + length]).astype(np.int64) << k
        return length

    def backwards(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the texts before ``i`` and before ``j`` share at their ends; i < j."""
        length = np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            a = i - length - (1 << k)
            rank = self.levels[k]
            same = (a >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(j - length - (1 << k), 0)])
            length += same.astype(np.int64) << k
        return length

    def lcp(self) -> np.ndarray:
        """Shared words of each suffix, in sorted order, with the one before it."""
        out = np.zeros(self.n, dtype=np.int64)
        near = np.flatnonzero(self.levels[0][self.order[1:]] == self.levels[0][self.order[:-1]]) + 1
        out[near] = self.forwards(self.order[near - 1], self.order[near])
        return out

    def previous_factors(self) -> tuple[list[int], list[int]]:
        """For each position the longest stretch from there on that also starts earlier in its document, and where."""
        lcp = self.lcp()
        linked = np.flatnonzero((lcp > 0) | (np.append(lcp[1:], 0) > 0))
        longest, source = [0] * self.n, [0] * self.n
        below, shared = [], []  # positions in increasing order, and what each shares with the one below it

        def settle(until: int, with_next: int, place: int) -> int:
            # Positions above ``until`` find the next smaller one at ``place``.
            while below and below[-1] > until:
                p, left = below.pop(), shared.pop()
                if left >= with_next:
                    longest[p] = left
                    if left:
                        source[p] = below[-1]
                else:
                    longest[p], source[p] = with_next, place
                with_next = min(left, with_next)
            return with_next

        for p, left in zip(self.order[linked].tolist(), lcp[linked].tolist(), strict=True):
            if left == 0:
                settle(-1, 0, -1)
            elif below[-1] > p:
                left = settle(p, left, p)
            below.append(p)
            shared.append(left)
        settle(-1, 0, -1)
        return longest, source


def _blocks(bounds: list[int], longest: list[int]) -> list[list[int]]:
    """The starts of each document's LZ blocks, and its end."""
    out = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        starts, at = [], low
        while at < high:
            starts.append(at)
            at += longest[at] or 1
        out.append([*starts, high])
    return out


def _at_boundaries(suffixes: Suffixes, blocks: list[list[int]]) -> np.ndarray:
    """(start, end, period) of the runs that touch a boundary of blocks, start and end counted in the chunk."""
    edges = [np.array(b, dtype=np.int64) for b in blocks if len(b) > 1]
    if not edges:
        return np.zeros((0, 3), dtype=np.int64)
    sides = [np.diff(e) for e in edges]
    b = np.concatenate(edges)
    most = np.concatenate([(np.append(0, s) + np.append(s, 0)) // (MIN_EXPONENT - 1) for s in sides])
    low = np.concatenate([np.full(len(e), e[0]) for e in edges])
    high = np.concatenate([np.full(len(e), e[-1]) for e in edges])
    use = most > 0
    b, most, low, high = b[use], most[use], low[use], high[use]
    row = np.repeat(np.arange(len(b)), most)
    q = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most) + 1
    b, low, high = b[row], low[row], high[row]
    word, found = suffixes.levels[0], []
    for left in (b, b - q):  # the stretch that agrees lies around b, or around b - q
        right = left + q
        inside = (left >= low) & (right <= high)
        one = inside & ((word[np.maximum(left, 0)] == word[np.minimum(right, suffixes.n)]) | ((left > low) & (word[left - 1] == word[np.minimum(right, suffixes.n) - 1])))
        i, j, p = left[one], right[one], q[one]
        back, on = suffixes.backwards(i, j), suffixes.forwards(i, j)
        long_enough = back + on + p >= np.maximum(MIN_LENGTH, MIN_EXPONENT * p)
        found.append(np.stack([(i - back)[long_enough], (j + on)[long_enough], p[long_enough]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _copied(runs: list[tuple[int, int, int]], blocks: list[int], source: list[int]) -> list[tuple[int, int, int]]:
    """The runs of a document with those inside its blocks."""
    starting = defaultdict(list)
    for start, end, period in runs:
        starting[start].append((end, period))
    for low, high in zip(blocks[:-1], blocks[1:], strict=True):
        shift = low - source[low]
        for start in range(low + 1, high - MIN_LENGTH):
            for end, period in starting.get(start - shift, ()):
                if end + shift < high:
                    starting[start].append((end + shift, period))
    return sorted((s, e, p) for s, rest in starting.items() for e, p in rest)


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, given as its words; by start, then period."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in documents for w in words], dtype=np.int64)
    bounds = np.cumsum([0, *map(len, documents)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if len(number) == len(ids):
        return out  # no word stands twice
    suffixes = Suffixes(ids, bounds)
    longest, source = suffixes.previous_factors()
    blocks = _blocks(bounds.tolist(), longest)
    touching = _at_boundaries(suffixes, blocks)
    for d in np.unique(np.searchsorted(bounds, touching[:, 0], side="right") - 1):
        own = touching[np.searchsorted(touching[:, 0], bounds[d]) : np.searchsorted(touching[:, 0], bounds[d + 1])]
        found = _copied([tuple(r) for r in own.tolist()], blocks[d], source)
        out[d] = sorted((int(s - bounds[d]), e - s, p) for s, e, p in found)
        out[d].sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact exponent; of equal ones that of the smallest start, then period."""
    best = None
    for r in runs:  # in the order that settles ties
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one blank, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, runs (array of start, length, period), strongest (the run of the greatest exponent, or null) and collapsed
    (the text without repeated periods) of each row."""

    def run(batches):
        entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        as_entry = lambda r: {"start": r[0], "length": r[1], "period": r[2]}
        for batch in batches:
            for row, data, offsets in chunks(batch.column(1)):
                raw = data.tobytes()
                documents = [_WORD.findall(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                runs = runs_of(documents)
                best = [strongest(r) for r in runs]
                columns = [
                    batch.column(0).slice(row, len(runs)),
                    pa.array([list(map(as_entry, r)) for r in runs], pa.list_(entry)),
                    pa.array([None if r is None else as_entry(r) for r in best], entry),
                    pc.cast(pa.array([collapse(w, r) for w, r in zip(documents, runs, strict=True)], pa.binary()), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "runs", "strongest", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string"))
    return plain.mapInArrow(run, f"key {kind}, runs array<{RUN}>, strongest {RUN}, collapsed string").withColumnRenamed("key", key)


def repeat_tail(text: Column, doc_id: Column) -> Column:
    """The text of one document in ten with a periodic tail: from word a on, its words a, a+1, .. a+p-1 over and over.

    h is the CRC-32 of the decimal id, g = h div 10; documents with h mod 10 = 0 are changed, a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8), n being the number of words. Null ids stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10).cast("long")

    def changed(found: Column) -> Column:
        n = F.size(found).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        of = lambda w, i: F.when(i >= a, F.get(found, (a + F.pmod(i - a, p)).cast("int"))).otherwise(w)
        return F.array_join(F.transform(found, of), " ")

    # The words stand in a one-element array, so that they are found once and not once a word.
    tail = F.get(F.transform(F.array(words), lambda found: F.when(F.size(found) > 0, changed(found)).otherwise(text)), 0)
    return F.when(h % 10 == 0, tail).otherwise(text)
