"""Sets of hashed word shingles of many texts at once, on UTF-8 bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .common import large, mix64

WORDS = 5

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32                       # A-Z only
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)     # odd, so its powers have inverses
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_JOIN = np.uint64(0xA0761D6478BD642F)


@large
@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE), np.full(n, _INVERSE)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, first word of each text plus the total): words are
    runs of bytes other than blank and 0x09-0x0D, A-Z lower-cased."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    solid = ~_SEP[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    cut = off[(off < n) & (off > 0)]
    begin[cut] = solid[cut]
    at = np.flatnonzero(begin)
    stop = np.zeros(n, bool)                       # last byte of a word
    stop[:-1] = solid[:-1] & (~solid[1:] | begin[1:])
    stop[-1] = solid[-1]
    end = np.flatnonzero(stop) + 1
    size = 1 << max(16, int(n).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[raw]] * up[:n], out=total[1:])
        h = mix64((total[end] - total[at]) * down[at])
    return h, np.searchsorted(at, off)


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts in order, bounds). A text of fewer than ``k``
    words has its whole sequence as the one shingle, a text without words an empty set."""
    h, first = words(raw, off)
    n = len(off) - 1
    count = np.diff(first)
    with np.errstate(over="ignore"):
        joined = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for i in range(k):
            joined = joined * _JOIN + h[i:i + len(joined)]
        joined = mix64(joined + np.uint64(k))
    out, bounds = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        a, c = int(first[i]), int(count[i])
        if c >= k:
            s = np.sort(joined[a:a + c - k + 1])
            if c > k:
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                s = s[keep]
        elif c:
            with np.errstate(over="ignore"):
                v = np.zeros(1, np.uint64)
                for w in h[a:a + c]:
                    v = v * _JOIN + w
                s = mix64(v + np.uint64(c))
        else:
            s = h[:0]
        out.append(s)
        bounds[i + 1] = bounds[i] + len(s)
    return (np.concatenate(out) if out else h[:0]), bounds
