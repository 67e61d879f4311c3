"""Word and character hashing over whole Arrow batches with numpy: no Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes hashed at once; one longer document is a chunk of its own.
CHUNK = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(text: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null texts are empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string()).fill_null("")
    n = len(text)
    if not n:
        return
    offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None and offs[-1] else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield at, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and for each row the index of its first word (one more at the end)."""
    on = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before, after = np.empty_like(on), np.empty_like(on)
    if len(on):
        before[0], after[-1] = True, True
        before[1:] = ~on[:-1]
        after[:-1] = ~on[1:]
    starts = np.flatnonzero(on & (before | edge[:-1]))
    ends = np.flatnonzero(on & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    power = np.cumprod(np.full(int(lens.max()) + 1, _BASE, np.uint64))
    value = _BYTE[data[np.repeat(starts, lens) + within]] * power[within]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64))


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct k-word shingles as 64-bit hashes; with fewer words, one of all its words."""
    starts, ends, row = words(data, offs)
    h = word_hashes(data, starts, ends)
    if len(h) >= k:
        grams = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            grams = mix(grams * _BASE + h[i : len(h) - k + 1 + i])
    for a, b in zip(row[:-1], row[1:]):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            x = np.zeros(1, np.uint64)
            for v in h[a:b]:
                x = mix(x * _BASE + v)
            yield mix(x + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
