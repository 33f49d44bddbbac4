"""Words and their hashes for a whole batch of texts at once (numpy).

The texts of a batch lie in one byte array.  A word's hash is a polynomial over
its bytes taken from prefix sums, so no Python loop runs over words; whoever
needs certainty compares the words themselves afterwards.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of words made of letters and digits; every non-ASCII byte counts as a letter.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def spans(raw: np.ndarray, off: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words: runs of bytes that are not
    white space, or with ``letters`` of letters and digits."""
    inside = _IS_WORD[raw] if letters else ~_IS_SPACE[raw]
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = off[1:-1]
    cuts = cuts[cuts < n]
    begin[cuts] = inside[cuts]  # a word ends with its text
    end = np.zeros(n + 1, bool)
    end[1:n] = inside[:-1] & ~inside[1:]
    end[n] = inside[-1]
    cuts = cuts[cuts > 0]
    end[cuts] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


#: Bytes that are hashed at once (more only for a longer word).
STEP = 1 << 19
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n (modulo 2 ** 64), kept for the worker up to STEP."""
    table = _tables.get(base)
    if table is None or len(table) <= n:
        table = np.empty(max(n, STEP) + 1, np.uint64)
        table[0] = 1
        table[1:] = base
        np.cumprod(table, out=table)
        if n <= STEP:
            _tables[base] = table
    return table


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word (uint64)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + STEP, side="right")))
        part = raw[low:ends[j - 1]]
        n = len(part)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)[:n], out=total[1:])
        first = starts[i:j] - low
        out[i:j] = (total[ends[i:j] - low] - total[first]) * _powers(_INVERSE, n)[first]
        i = j
    return mix(out)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` adjacent words (the caller cuts at text borders)."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + h[i:len(h) - size + 1 + i]
    return mix(out)
