"""Hashes of the words of many texts at once, and of every run of k words."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, *range(0x09, 0x0E))

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(SEPARATORS)] = True
_SEED = 77
_AT_A_TIME = 1 << 20  # bytes of words


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _odd(n: int, lane: int) -> np.ndarray:
    """The first n powers of a fixed odd number; as it is odd, no factor loses bits."""
    base = np.random.default_rng(_SEED + lane).integers(1 << 40, 1 << 63, dtype=np.uint64) | np.uint64(1)
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one behind the other, and the bounds of each; a null has none."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and number of the text of every word."""
    inside = ~_SEPARATOR[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # Words of two texts that touch are two words.
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    at = np.flatnonzero(begins)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(bounds, at, side="right") - 1


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64 bits for every word; each lane has others. Some megabytes are in work at a time."""
    hashes = np.zeros(len(begin), np.uint64)
    if not len(begin):
        return hashes
    lengths = end - begin
    first = np.cumsum(lengths) - lengths
    powers = _odd(int(lengths.max()), 2 * lane)
    cuts = np.flatnonzero(np.diff(first // _AT_A_TIME)) + 1
    for a, b in pairwise([0, *cuts.tolist(), len(begin)]):
        place = np.arange(int(lengths[a:b].sum())) - np.repeat(first[a:b] - first[a], lengths[a:b])
        letters = raw[np.repeat(begin[a:b], lengths[a:b]) + place].astype(np.uint64) + np.uint64(1)
        letters *= powers[place]
        hashes[a:b] = np.add.reduceat(letters, first[a:b] - first[a])
    return mix(hashes + np.uint64(lane))


def run_hashes(words: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """64 bits for every k hashes in a row; runs over several texts are in it, too."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = _odd(k, 2 * lane + 1)
    sums = words[:n].copy()
    for i in range(1, k):
        sums += words[i : n + i] * powers[i]
    return mix(sums)
