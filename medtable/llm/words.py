"""Hashes of the words of many texts at once.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BLOCK = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_CODES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_CODES[65:91] = _CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = U(0x9E3779B97F4A7C55)
_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(255, _BASE)]))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(2 * n, _BASE)]))
    return _POWERS


def _hash_block(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block and the positions they start at; ``cuts`` are text starts inside it."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[cuts] = solid[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U), starts
    codes = _CODES[data[solid]]
    at = np.cumsum(solid, dtype=np.int32)[starts] - 1
    sizes = np.diff(np.append(at, len(codes)))
    place = np.arange(len(codes), dtype=np.int32) - np.repeat(at.astype(np.int32), sizes)
    codes *= _powers(int(sizes.max()))[place]
    return mix(np.add.reduceat(codes, at) + sizes.astype(U)), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words of each text.

    Long data are worked off in blocks that end at a space or at the end of a text.
    """
    inner = offsets[:-1][offsets[:-1] < len(data)]
    out, starts, at = [], [], 0
    while at < len(data):
        size, stop = BLOCK, len(data)
        while at + size < len(data):
            space = np.flatnonzero(_SPACE[data[at:at + size]])
            ends = inner[np.searchsorted(inner, at, "right"):np.searchsorted(inner, at + size, "right")]
            if len(space) or len(ends):
                stop = max(at + int(space[-1]) + 1 if len(space) else 0, int(ends[-1]) if len(ends) else 0)
                break
            size *= 2  # one word longer than a block
        cuts = inner[np.searchsorted(inner, at, "left"):np.searchsorted(inner, stop, "left")] - at
        h, s = _hash_block(data[at:stop], cuts)
        out.append(h)
        starts.append(s + at)
        at = stop
    if not out:
        return np.zeros(0, U), np.zeros(len(offsets) - 1, np.int64)
    where = np.concatenate(starts)
    return np.concatenate(out), np.diff(np.searchsorted(where, offsets))
