"""Word and shingle hashes of Arrow text batches, in numpy.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. Both
rules are plain ASCII, so they hold on UTF-8 bytes. Everything works on the
bytes of a whole batch, cut at word ends into blocks, so memory stays bounded
also for one very long text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _multipliers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """Words of a batch: hash, first and end byte (in ``data``), and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # len(texts) + 1
    data: np.ndarray
    text_starts: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a string array; nulls are empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def words(texts: pa.Array, lower: bool = True, seed: int = 7) -> Words:
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, np.zeros(len(offsets), np.int64), data, offsets)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < n]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[offsets > 0] - 1
    ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    del begins, ends
    hashes = np.empty(len(starts), np.uint64)
    widest = int((stops - starts).max()) if len(starts) else 0
    factors = _multipliers(widest, seed)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + BLOCK, side="right")))
        lengths = stops[at:to] - starts[at:to]
        heads = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
        part = data[place + np.repeat(starts[at:to], lengths)]
        part = (_LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)
        hashes[at:to] = mix(np.add.reduceat(part * factors[place], heads) + lengths.astype(np.uint64))
        at = to
    return Words(hashes, starts, stops, np.searchsorted(starts, offsets), data, offsets)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; fewer words are one run; none give none."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(k, n)
    factors = _multipliers(width, 1000 + width)
    total = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        total += hashes[j : n - width + 1 + j] * factors[j]
    return mix(total)
