"""Words of UTF-8 texts and their hashes, for whole Arrow batches at once in numpy.

A word is a run of bytes that are none of the six white-space characters.
Its hash is a polynomial over random byte values modulo 2**64 with an odd base,
read off running sums, then mixed with its length; equal words hash alike in
every batch and process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = 0x9E3779B97F4A7C55
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
LOWER = np.arange(256)
LOWER[0x41:0x5B] += 0x20
LOWER_VALUES = VALUES[LOWER]

_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers["base"]) < n:
        size = max(n, 2 * len(_powers["base"]))
        for name, value in (("base", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(value))
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["base"][:n], _powers["inverse"][:n]


def slices(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of texts with about ``limit`` bytes; a longer text comes alone.

    A null counts as the empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def find_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and the offsets of each text's words; words end with their text."""
    inside = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    before[first] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """64-bit hash of each run of bytes."""
    base, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * base[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * GOLDEN)


def word_shingles(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of all runs of ``width`` words; a shorter text is one run of all its words."""
    counts = np.diff(offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(words)
    combined = words.copy()
    for k in range(1, width):
        combined = combined * np.uint64(0xD6E8FEB86659FD93) + GOLDEN
        combined[:n - k] += words[k:]
    place = np.arange(n) - offsets[:-1][text]
    whole = place + width <= counts[text]
    short = np.flatnonzero((counts > 0) & (counts < width))
    hashes, texts = mix(combined[whole]), text[whole]
    if len(short):
        own = np.empty(len(short), np.uint64)
        for i, t in enumerate(short):
            h = np.array([counts[t]], np.uint64) * GOLDEN
            for w in words[offsets[t]:offsets[t + 1]]:
                h = mix(h) + w
            own[i] = mix(h)[0]
        hashes, texts = np.concatenate([hashes, own]), np.concatenate([texts, short])
    return hashes, texts
