"""64-bit hashes of the words of many texts at once, with numpy.

A word's hash is a polynomial of its bytes over a table of random numbers, then mixed.
It depends on the word alone, so all tasks agree on it.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240521))
_EXACT = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
#: Bytes looked at together; some ten numbers of 8 bytes stand beside each of them.
_PIECE = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


_powers = np.cumprod(np.full(64, _BASE, dtype=np.uint64))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * _powers[-1]])
    return _powers


def _piece(b: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in ``b``, which cuts no word."""
    at = np.flatnonzero(~_SPACE[b])
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    lengths = np.diff(first, append=len(at))
    inner = np.arange(len(at)) - np.repeat(first, lengths)
    values = table[b[at]] * _powers_to(int(lengths.max()))[inner]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), at[first]


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin and end
    (one number more than texts).  ``lower`` reads A-Z as a-z."""
    table = _LOWER if lower else _EXACT
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    b = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    hashes, starts, begin = [], [], 0
    while begin < len(b):
        end = min(begin + _PIECE, len(b))
        while end < len(b) and not (gap := np.flatnonzero(_SPACE[b[begin:end]])).size:
            end = min(2 * end - begin, len(b))  # one word longer than a piece
        if end < len(b):
            end = begin + int(gap[-1]) + 1
        h, s = _piece(b[begin:end], table)
        hashes.append(h)
        starts.append(s + begin)
        begin = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.concatenate([[0], np.searchsorted(starts, ends)])


_ORDER = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words (n < 64) that start at each place; the last n - 1 places
    have none."""
    total = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for i in range(n):
        total += hashes[i : i + len(total)] * _ORDER[i]
    return mix(total)
