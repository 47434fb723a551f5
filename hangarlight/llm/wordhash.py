"""Vectorised word hashing over Arrow string columns.

A chunk of documents is one byte array with document offsets.  Every word is hashed at once from
the prefix sums of a polynomial over randomised byte values, so no Python object exists per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Longer words are hashed one by one: sums of powers modulo 2^64 collide on words made for it, from 1,024 bytes on.
LONG_WORD = 512
CHUNK_BYTES = 1 << 18
_GAMMA = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE = np.uint64(_GAMMA)


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_bytes(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but ASCII white space.
SPACED = _word_bytes([0x20, *range(0x09, 0x0E)])
#: Words are runs of ASCII letters, digits and all non-ASCII characters.
ALNUM = _word_bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_folded = np.arange(256, dtype=np.uint64)
_folded[65:91] += np.uint64(32)  # A-Z count as a-z
_LOWER = bytes(_folded.astype(np.uint8))
_VALUES = mix64((_folded + np.uint64(1)) * _BASE)
_R = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        for k, base in enumerate((_R, pow(_R, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, bytes, offsets) for runs of rows of about ``limit`` bytes; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Hash all words of a chunk: (hashes, byte starts, byte ends, word offset of each document)."""
    n = len(data)
    inside = is_word[data]
    before = np.zeros(n, dtype=bool)
    after = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    powers, inverse = _power_tables(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts]) if len(starts) else np.zeros(0, np.uint64)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes().translate(_LOWER))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int):
    """Hash each run of ``width`` words inside a document; shorter, non-empty documents are one run.

    Returns (hashes, document of each run), in text order.
    """
    lengths = np.diff(bounds)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - width + 1, 1))
    doc = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][doc]
    size = np.minimum(lengths, width)[doc]
    total = size.astype(np.uint64) * _BASE
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    short = bool((lengths < width).any())
    for k in range(width):
        term = mix64(padded[first + k] + np.uint64((k + 1) * _GAMMA & _MASK))
        total = total + (np.where(k < size, term, np.uint64(0)) if short else term)
    return mix64(total), doc


def distinct(hashes: np.ndarray, doc: np.ndarray, n_docs: int):
    """Distinct hashes of each document, sorted inside it: (hashes, offsets)."""
    order = np.lexsort((hashes, doc)) if len(doc) and n_docs > 1 else np.argsort(hashes)
    hashes, doc = hashes[order], doc[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[first], doc[first]
    return hashes, np.searchsorted(doc, np.arange(n_docs + 1))
