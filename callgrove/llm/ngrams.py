"""Hashed n-grams of texts in numpy: each is a difference of polynomial prefix sums."""

from __future__ import annotations

import numpy as np

from callgrove.llm.common import WHITE_SPACE, code_points, mixed

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(128, bool)
_IS_SPACE[[ord(c) for c in WHITE_SPACE]] = True
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64, kept and doubled on demand."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        length = max(1 << 16, 1 << (size - 1).bit_length())
        steps = np.full(length, base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:size]


def windows(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]``, equal for equal contents."""
    n = len(codes)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * _power_table(_BASE, n), out=prefix[1:])
    shifted = (prefix[ends] - prefix[starts]) * _power_table(_INVERSE, n + 1)[starts]
    return mixed(shifted + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def char_ngrams(text: str, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """Bucket of every character n-gram of the lower-cased text, white space as one space."""
    codes = code_points(" " + " ".join(text.lower().split()) + " ")
    found = []
    for size in sizes:
        starts = np.arange(max(0, len(codes) - size + 1))
        found.append(windows(codes, starts, starts + size))
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return (hashes % np.uint64(buckets)).astype(np.int32)


def subwords(text: str, sizes: tuple[int, ...], buckets: int) -> np.ndarray:
    """Bucket of every word, of the n-grams inside it with its borders, and of word bigrams.

    A bigram counts by its pattern alone: bucket 1 if the word before is the same, else
    bucket 0. No other n-gram is hashed into these two.
    """
    codes = code_points("\n" + text + "\n")
    space = (codes < 128) & _IS_SPACE[np.minimum(codes, 127)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int32)
    # One space on either side of a word stands for its border.
    bordered = codes.copy()
    bordered[space] = 32
    words = windows(bordered, starts - 1, ends + 1)
    found = [words]
    next_end = np.zeros(len(codes) + 1, np.int64)
    next_end[starts - 1] = ends + 1
    limit = np.maximum.accumulate(next_end)
    for size in sizes:
        at = np.arange(len(codes) - size + 1)
        at = at[at + size <= limit[at]]
        found.append(windows(bordered, at, at + size))
    hashed = np.concatenate(found) % np.uint64(buckets - 2) + np.uint64(2)
    return np.concatenate([words[1:] == words[:-1], hashed]).astype(np.int32)
