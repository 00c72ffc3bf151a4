"""Hashed features of whole texts in numpy."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """Feature numbers below ``2**bits`` of 64-bit keys."""
    return ((keys * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def char_ngrams(text: str, longest: int, bits: int) -> np.ndarray:
    """Counts of the hashed character n-grams of 1 to ``longest`` (at most 3) code points of the lower-cased text."""
    points = code_points(text.lower())
    keys, found = points, [slots(points, bits)]
    for n in range(2, min(longest, len(points)) + 1):
        keys = (keys[:-1] << np.uint64(21)) | points[n - 1 :]  # 21 bits hold any code point
        found.append(slots(keys, bits))
    return np.bincount(np.concatenate(found), minlength=1 << bits)


# Powers of an odd number and of its inverse, so that a word's hash does not depend on its place.
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS[base]) < n:
        factors = np.full(2 * n, base, dtype=np.uint64)
        factors[0] = 1
        _POWERS[base] = np.multiply.accumulate(factors)
    return _POWERS[base]


def word_features(text: str, prefixes: tuple[int, ...], bits: int) -> np.ndarray:
    """Distinct hashed features of the lower-cased text: its words, and the beginnings of words of these lengths.

    A word is a run of letters and digits; a beginning counts if the word is at least as long.
    """
    points = code_points(text.lower())
    # Letters and digits: ASCII ones, and everything from the letters of Latin-1 on.
    word = (points - np.uint64(48) < 10) | (points - np.uint64(97) < 26) | (points >= 0xC0)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(points * _powers(_BASE, len(points))[: len(points)], out=sums[1:])
    back = _powers(_INVERSE, len(points))
    found = [slots((sums[ends] - sums[starts]) * back[starts], bits)]
    for length in prefixes:
        at = starts[ends - starts >= length]
        found.append(slots((sums[at + length] - sums[at]) * back[at] + np.uint64(length), bits))
    return np.unique(np.concatenate(found))
