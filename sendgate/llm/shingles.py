"""Word shingles of texts as sorted sets of 64-bit hashes: a helper of ``jaccard_join``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
# Texts of about this many bytes are read at a time.
CHUNK = 1 << 19

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Odd multipliers from a fixed seed: one per place in a shingle, and the base of word hashes.
_ODD = np.random.default_rng(2024).integers(1, 1 << 63, 2 * WORDS + 2, dtype=np.uint64) * 2 + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _ODD[-1], np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _word_hashes(text: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the number of its text. Texts lie one behind the other."""
    inside = ~_SEPARATOR[text]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = starts_of_texts[starts_of_texts < len(text)]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.searchsorted(starts_of_texts, at, side="right") - 1
    letters = _LOWER[text[inside]].astype(np.uint64) + np.uint64(1)
    first = (np.cumsum(inside) - 1)[at]
    lengths = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    letters *= _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(letters, first)), owner


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the different shingles of each text, and the bounds of each text's part.

    A text with fewer words than a shingle has all of them as one; one without words has none.
    """
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    # A null has no bytes.
    words, owner = _word_hashes(raw[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0])
    counts = np.bincount(owner, minlength=n)
    hashes, owners = [], []
    whole = len(words) - WORDS + 1
    if whole > 0:
        sums = sum(words[i : whole + i] * _ODD[i] for i in range(WORDS))
        inside = owner[:whole] == owner[WORDS - 1 :]
        hashes.append(mix(sums[inside]))
        owners.append(owner[:whole][inside])
    short = counts[owner] < WORDS
    if short.any():
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        place = (np.arange(len(words)) - first[owner])[short]
        parts = words[short] * _ODD[WORDS + place]
        few = owner[short]
        at = np.flatnonzero(np.concatenate(([True], np.diff(few) != 0)))
        sums = np.add.reduceat(parts, at) + counts[few[at]].astype(np.uint64)
        hashes.append(mix(sums))
        owners.append(few[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    found, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.concatenate(([True], (np.diff(found) != 0) | (np.diff(owner) != 0)))
    found, owner = found[new], owner[new]
    return found, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))


def in_chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of texts of about ``CHUNK`` bytes."""
    for batch in batches:
        lengths = pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            if last > first:
                yield batch.slice(first, last - first)
