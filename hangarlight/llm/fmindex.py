"""A word-level FM-index in numpy: suffix array, wavelet matrix ranks, backward search, sampled locate."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits packed into 64-bit words with counts before each word: rank in constant time."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[np.minimum(block, len(self.words) - 1)] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[block] + np.bitwise_count(below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """rank(symbol, i) and access(i) over a sequence of small integers, one bit vector per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(symbols - 1).bit_length())
        current = sequence
        for level in range(self.bits - 1, -1, -1):
            ones = (current >> level) & 1
            self.levels.append(BitRank(ones))
            self.zeros.append(int(len(ones) - ones.sum()))
            current = np.concatenate([current[ones == 0], current[ones == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Occurrences of each symbol in front of ``low`` and ``high``, as offsets inside its own run."""
        start = np.zeros_like(low)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            low, high, start = (np.where(one, zeros + r, i - r) for i, r in ((x, level.rank(x)) for x in (low, high, start)))
        return low - start, high - start

    def access(self, i: np.ndarray):
        """(symbol at i, its rank in front of i)."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one = level.get(i).astype(bool)
            symbol = symbol * 2 + one
            r, s = level.rank(i), level.rank(start)
            i, start = np.where(one, zeros + r, i - r), np.where(one, zeros + s, start - s)
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; stops as soon as all ranks differ."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        follow = np.zeros(n, dtype=np.int64)
        follow[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        changed = np.ones(n, dtype=np.int64)
        changed[1:] = key[order[1:]] != key[order[:-1]]
        changed[0] = 0
        rank[order] = np.cumsum(changed)
        width *= 2
        if n == 0 or width >= n or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Backward search and locate over one text of symbols 1..symbols-1; 0 is kept for the end mark."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        text = np.concatenate([text, [0]]).astype(np.int64)
        order = suffix_array(text)
        self.n = len(text)
        self.wavelet = WaveletMatrix(text[order - 1], symbols)
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        marked = order % sample == 0
        self.marks = BitRank(marked.astype(np.uint8))
        self.samples = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """Suffix ranges [low, high) of left-aligned, zero-padded phrases; empty if a phrase is absent."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > k) & (low < high))
            if not len(live):
                continue
            symbol = phrases[live, k]
            at_low, at_high = self.wavelet.rank(symbol, low[live], high[live])
            low[live], high[live] = self.first[symbol] + at_low, self.first[symbol] + at_high
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray):
        """(phrase, text position) of every occurrence in the ranges, by walking back to sampled suffixes."""
        counts = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(low)), counts)
        i = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts) + low[phrase]
        position = np.full(len(i), -1, dtype=np.int64)
        walking, steps = np.arange(len(i)), 0
        while len(walking):
            here = i[walking]
            marked = self.marks.get(here).astype(bool)
            done = walking[marked]
            position[done] = self.samples[self.marks.rank(here[marked])] + steps
            walking, here = walking[~marked], here[~marked]
            symbol, rank = self.wavelet.access(here)
            i[walking] = self.first[symbol] + rank
            steps += 1
        return phrase, position % self.n
