"""SuperMinHash signatures, vectorised over the elements of a chunk of documents.

Each element walks its own Fisher-Yates permutation of the ``m`` signature places; in step ``j`` it
offers rank ``j`` plus a random fraction to the place it meets.  A document stops once no place can
fall below the step's rank any more, after about ``m ln m / n`` steps for ``n`` elements.
"""

from __future__ import annotations

import numpy as np

from .wordhash import mix64

_GAMMA = 0xA24BAED4963EE407
_STEP = np.uint64(_GAMMA)


def signatures(hashes: np.ndarray, offsets: np.ndarray, m: int = 128) -> np.ndarray:
    """(documents, m) array of uint64 ranks; rows of empty documents stay at the largest value."""
    n_docs = len(offsets) - 1
    best = np.full((n_docs, m), np.iinfo(np.uint64).max, dtype=np.uint64)
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    element = np.asarray(hashes, dtype=np.uint64)
    places = None
    flat = best.reshape(-1)
    for j in range(m):
        if not len(element):
            break
        drawn = mix64(element + np.uint64((j + 1) * _GAMMA & ((1 << 64) - 1)))
        k = (j + (drawn & np.uint64(0xFFFF)).astype(np.int64) % (m - j)).astype(np.int64)
        if places is None:
            met = k
        else:
            row = np.arange(len(element))
            met = places[row, k]
            places[row, k] = places[row, j]
        np.minimum.at(flat, doc * m + met, (np.uint64(j) << np.uint64(48)) | (drawn >> np.uint64(16)))
        open_docs = best.max(axis=1) >= (np.uint64(j + 1) << np.uint64(48))
        left = open_docs[doc]
        if places is None:
            places = np.tile(np.arange(m, dtype=np.uint8), (int(left.sum()), 1))
            places[np.arange(len(places)), k[left]] = 0
            element, doc = element[left], doc[left]
        elif not left.all():
            element, doc, places = element[left], doc[left], places[left]
    return best


def band_hashes(signature: np.ndarray, rows: int = 4) -> np.ndarray:
    """(documents, m / rows) int64 hashes of consecutive signature places."""
    n_docs, m = signature.shape
    parts = signature.reshape(n_docs, m // rows, rows)
    total = np.zeros(parts.shape[:2], dtype=np.uint64)
    for k in range(rows):
        total = mix64(total * np.uint64(31) + parts[:, :, k] + _STEP)
    return total.view(np.int64)
