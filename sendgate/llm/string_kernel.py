"""A gap-tolerant subsequence kernel between short strings, and a linear scan of texts by it.

A string is the weighted set of its subsequences of three letters that span five letters at
most; a subsequence that leaves out g letters weighs ``DECAY ** g``. The kernel of two strings
is the inner product of these sets, divided by each string's length norm. An inserted letter
changes the weights of the subsequences across it and leaves the others.

Texts are read as units of letters: other characters than letters and white space are left out
(so ``i.d-i*o$t`` is one unit), digits stand for the letters they look like, and single letters
with spaces between them are one unit (``i d i o t``). The strings that are scored are a unit's
windows of ``WINDOW`` letters, or the whole unit if it is shorter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

WINDOW = 10
DECAY = 0.6
# So many of a text's windows say how toxic it is.
TOP = 4
# (second, third): places of a subsequence's letters after its first.
SHAPES = tuple((a, b) for b in range(2, 5) for a in range(1, b))
SIZE = 64**3
_SPACE, _EDGE = 64, 65
# Texts are scanned in pieces of about this many characters.
PIECE = 1 << 20

# Digits and the letters they stand for.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: 0 left out, 1 to 63 a letter, 64 white space."""
    table = np.zeros(0x10000, np.uint8)
    for point in range(0x10000):
        char = chr(point)
        char = LOOKALIKES.get(char, char)
        if char.isspace():
            table[point] = _SPACE
        elif char.isalpha():
            low = ord(char.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + (low * 40503 >> 4) % 37
    return table


@dataclass
class Units:
    """Letters of several texts in a row, with what is needed to score their windows."""

    letters: np.ndarray  # codes, _SPACE and _EDGE between units
    text_of: np.ndarray  # number of the text of each place
    starts: np.ndarray  # places where a window starts
    ends: np.ndarray  # one past the last place where its subsequences start


def read_units(texts: Sequence[str]) -> Units:
    points = np.frombuffer(
        "".join(text + "\n" for text in texts).encode("utf-32-le", "surrogatepass"), "<u4"
    )
    lengths = np.array([len(text) + 1 for text in texts], np.int64)
    codes = _letters()[np.minimum(points, 0xFFFF)]
    codes[np.cumsum(lengths) - 1] = _EDGE
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    kept = codes != 0
    codes, text_of = codes[kept], text_of[kept]
    kept = np.ones(len(codes), bool)
    kept[1:] = ~((codes[1:] == _SPACE) & (codes[:-1] >= _SPACE))
    codes, text_of = codes[kept], text_of[kept]
    gap = codes >= _SPACE
    before = np.concatenate(([True], gap[:-1]))
    after = np.concatenate((gap[1:], [True]))
    alone = ~gap & before & after
    between = codes == _SPACE
    between[1:] &= alone[:-1]
    between[:-1] &= alone[1:]
    codes, text_of = codes[~between], text_of[~between]

    gap = codes >= _SPACE
    ends = np.flatnonzero(gap)
    last = ends[np.searchsorted(ends, np.arange(len(codes)))]  # the gap that ends each place's unit
    first = ~gap & np.concatenate(([True], gap[:-1]))
    left = last - np.arange(len(codes))
    starts = np.flatnonzero((first & (left >= 3)) | (~gap & (left >= WINDOW)))
    ends = np.minimum(starts + WINDOW, last[starts]) - 2
    return Units(codes, text_of, starts.astype(np.int32), ends.astype(np.int32))


def subsequences(units: Units) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per shape: the subsequence that starts at each place, where there is one, and its weight."""
    codes = units.letters.astype(np.int32)
    gap = units.letters >= _SPACE
    passed = np.cumsum(gap, dtype=np.int32)
    n = len(codes)
    for a, b in SHAPES:
        there = np.zeros(n, bool)
        found = np.zeros(n, np.int32)
        if n > b:
            there[: n - b] = ~gap[: n - b] & (passed[b:] == passed[: n - b])
            found[: n - b] = (codes[: n - b] << 12) + (codes[a : n - b + a] << 6) + codes[b:]
            found[~there] = 0
        yield found, there, DECAY ** (b - 2)


def window_scores(units: Units, weights: np.ndarray) -> np.ndarray:
    """The inner product of each window with ``weights``, over the window's norm."""
    n = len(units.letters)
    products, norms = np.zeros(n + 1), np.zeros(n + 1)
    for found, there, weight in subsequences(units):
        products[1:] += np.where(there, weights[found], 0.0) * weight
        norms[1:] += there * weight**2
    np.cumsum(products, out=products)
    np.cumsum(norms, out=norms)
    norm = norms[units.ends] - norms[units.starts]
    return (products[units.ends] - products[units.starts]) / np.sqrt(np.maximum(norm, 1.0))


def best_windows(units: Units, scores: np.ndarray) -> np.ndarray:
    """Of every text that has windows, the one that scores highest."""
    owner = units.text_of[units.starts]
    order = np.lexsort((scores, owner))
    last = np.flatnonzero(np.concatenate((np.diff(owner[order]) != 0, [True])))
    return order[last]


def text_scores(texts: Sequence[str | None], weights: np.ndarray, floor: float) -> np.ndarray:
    """Per text, read whole, the scores of its ``TOP`` highest different windows, highest first.

    Windows of equal score count once, or a repeated word would stand for several. ``floor``
    stands where a text has fewer windows.
    """
    scores = np.full((len(texts), TOP), floor)
    for numbers, pieces in _pieces(texts):
        units = read_units(pieces)
        found = window_scores(units, weights).round(6)
        owner = np.asarray(numbers, np.int64)[units.text_of[units.starts]]
        # What other pieces of the same texts gave competes again.
        again = np.unique(numbers)
        owner = np.concatenate([owner, np.repeat(again, TOP)])
        found = np.concatenate([found, scores[again].ravel()])
        order = np.lexsort((-found, owner))
        owner, found = owner[order], found[order]
        other = np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(found) != 0)))
        owner, found = owner[other], found[other]
        first = np.flatnonzero(np.concatenate(([True], np.diff(owner) != 0)))
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        top = place < TOP
        scores[again] = floor
        scores[owner[top], place[top]] = found[top]
    return scores


def whole_pieces(texts: Sequence[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, none cut, in groups of about ``PIECE`` characters, with their numbers."""
    held, first = 0, 0
    for number, text in enumerate(texts):
        held += len(text)
        if held >= PIECE or number == len(texts) - 1:
            yield list(range(first, number + 1)), list(texts[first : number + 1])
            held, first = 0, number + 1


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, long ones cut between words, in groups of about ``PIECE`` characters."""
    numbers: list[int] = []
    pieces: list[str] = []
    held = 0
    for number, text in enumerate(texts):
        start, text = 0, text or ""
        while start < len(text):
            end = min(len(text), start + PIECE)
            if end < len(text):
                cut = max(text.rfind(" ", start + 1, end), text.rfind("\n", start + 1, end))
                end = cut if cut > start else end
            numbers.append(number)
            pieces.append(text[start:end])
            held += end - start
            start = end
            if held >= PIECE:
                yield numbers, pieces
                numbers, pieces, held = [], [], 0
    if pieces:
        yield numbers, pieces


@dataclass
class Sets:
    """The weighted subsequences of some windows, row by row."""

    bounds: np.ndarray  # where each row starts, and the end
    codes: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    @classmethod
    def joined(cls, parts: Sequence[Sets]) -> Sets:
        sizes = np.concatenate([np.diff(part.bounds) for part in parts])
        return cls(
            np.concatenate(([0], np.cumsum(sizes))),
            np.concatenate([part.codes for part in parts]),
            np.concatenate([part.weights for part in parts]),
        )

    def take(self, rows: np.ndarray) -> Sets:
        sizes = np.diff(self.bounds)[rows]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[rows] - bounds[:-1], sizes)
        return Sets(bounds, self.codes[at], self.weights[at])


def window_sets(units: Units, windows: np.ndarray) -> Sets:
    """The subsequences of some windows, each weight divided by its window's norm."""
    rows, found, weights = [], [], []
    starts, ends = units.starts[windows], units.ends[windows]
    for shape, there, weight in subsequences(units):
        for step in range(WINDOW):
            at = starts + step
            inside = at < ends
            inside[inside] &= there[at[inside]]
            rows.append(np.flatnonzero(inside))
            found.append(shape[at[inside]])
            weights.append(np.full(len(rows[-1]), weight))
    row, code, value = np.concatenate(rows), np.concatenate(found), np.concatenate(weights)
    norm = np.sqrt(np.maximum(np.bincount(row, value**2, len(windows)), 1.0))
    order = np.argsort(row, kind="stable")
    sizes = np.bincount(row, minlength=len(windows))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return Sets(bounds, code[order], (value / norm[row])[order])
