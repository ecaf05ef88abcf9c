"""Numpy views of Arrow text batches: words, their hashes, runs of k words.

A word is a maximal run of bytes other than space, tab, newline, vertical tab,
form feed and carriage return.  Everything here works on one Arrow batch (or a
slice of it), so a task's memory follows the batch, never the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space and ASCII marks.
MARKS = _SPACE.copy()
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BASE = 0x9E3779B97F4A7C13
_STEP = U64(0xD6E8FEB86659FD93)
#: Bytes hashed at a time; a longer word is hashed by hashlib instead.
BLOCK = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that all bits of a sum count."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=8)
def _byte_values(fold: bool, salt: int) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=U64) * _STEP + U64(salt * 2 + 1))
    if fold:
        values[65:91] = values[97:123]
    return values


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(2 * BLOCK + 1, base, U64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def text_slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes; null is empty.

    A row longer than the limit is a run of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each text's first word (one more at the end).

    ``between`` marks the bytes that stand between words."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = between[buf]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    edges = offsets[1:-1]
    before[edges[edges < n]] = True
    start = np.flatnonzero(~space & before)
    before[:-1], before[-1] = space[1:], True
    before[edges[edges > 0] - 1] = True
    end = np.flatnonzero(~space & before) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z as a-z if ``fold``)."""
    values, (pw, inv) = _byte_values(fold, salt), _powers()
    out = np.empty(len(start), U64)
    lo = 0
    while lo < len(start):
        s = start[lo]
        hi = max(lo + 1, int(np.searchsorted(start, s + BLOCK)))
        e = min(int(end[hi - 1]), int(s) + 2 * BLOCK)
        sums = np.zeros(e - s + 1, U64)
        np.cumsum(values[buf[s:e]] * pw[: e - s], out=sums[1:])
        a = start[lo:hi] - s
        out[lo:hi] = (sums[np.minimum(end[lo:hi] - s, e - s)] - sums[a]) * inv[a]
        lo = hi
    size = (end - start).astype(U64)
    out = mixed(out + size * _STEP)
    for i in np.flatnonzero(end - start > BLOCK):
        word = buf[start[i] : end[i]].tobytes()
        word = word.lower() if fold else word  # bytes.lower() changes A-Z only
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little")
    return out


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... counts[i] of them, for each i, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - counts), counts) + np.arange(total)


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first word of each run of k words within a text, and how many each text has."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    at = ranges(first[:-1], counts)
    if not len(at):
        return np.zeros(0, U64), at, counts
    n = len(hashes) - k + 1
    sums = np.zeros(n, U64)
    for j in range(k):
        sums *= _STEP
        sums += hashes[j : n + j]
    return mixed(sums[at]), at, counts
