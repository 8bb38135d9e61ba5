"""Sets of word shingles as sorted 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_SHIFT, _LAST = np.uint64(29), np.uint64(32)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct ``k``-word shingles of a text. Words are runs of
    other than ASCII white space, with A-Z lower-cased; a text of fewer words, but not
    none, is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count=len(words))
    m = min(k, len(words))
    acc = np.full(len(words) - m + 1, m, np.uint64)
    for j in range(m):
        acc = acc * _ODD + h[j:len(words) - m + 1 + j]
        acc ^= acc >> _SHIFT
    acc *= _MIX
    acc ^= acc >> _LAST
    return distinct_sorted(acc)
