"""Sparse ball trees over blocks of documents, searched best-first for the largest inner products.

A document is a sparse vector of integer impacts, a query one of integer factors (weight times
number). Both are scaled by the root of the weight, which leaves their inner product as it is. The
terms are dealt to a few groups, and a node holds its centroid and, per group, the largest distance
of its documents from it: no document below scores more than

    query . centroid + sum over groups of |query in the group| * radius in the group

which is one ball per subspace and so never looser than one ball. Distances and bounds are
rounded upwards by more than their floating-point error, so that a pruned subtree has no hit; the
scores of what is left are exact integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LEAF = 32  # documents
# Sums of up to 2^20 terms are off by less than this share.
_SLACK = 1e-9


@dataclass(frozen=True)
class Space:
    """Weights of the terms, by number, and the group of each."""

    weights: np.ndarray
    group: np.ndarray
    groups: int

    @property
    def roots(self) -> np.ndarray:
        return np.sqrt(self.weights.astype(np.float64))


@dataclass(frozen=True)
class Queries:
    """Sparse queries: of query i the terms and numbers from ``bounds[i]`` to ``bounds[i + 1]``."""

    bounds: np.ndarray
    terms: np.ndarray
    times: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[i], self.bounds[i + 1])
        return self.terms[part], self.times[part]


def term_groups(queries: Queries, weights: np.ndarray, groups: int) -> np.ndarray:
    """Group of each term: queries that share weight stay together, and so do their terms.

    Seeds are queries that share least with the seeds before; every query goes to the seed it
    shares most with, and a term to the group that uses it most.
    """
    mass = weights.astype(np.float64)[queries.terms] * queries.times
    owner = np.repeat(np.arange(len(queries)), np.diff(queries.bounds))
    total = np.bincount(owner, mass, len(queries))
    best, of = np.full(len(queries), -1.0), np.zeros(len(queries), int)
    seed = int(np.argmax(total)) if len(queries) else 0
    seeds = 0
    while seeds < min(groups, len(queries)):
        inside = np.zeros(len(weights), bool)
        inside[queries.of(seed)[0]] = True
        share = np.bincount(owner, mass * inside[queries.terms], len(queries)) / np.maximum(total, 1)
        of[share > best] = seeds
        best = np.maximum(best, share)
        seeds += 1
        seed = int(np.argmin(best))
    use = np.zeros((len(weights), max(seeds, 1)))
    np.add.at(use, (queries.terms, of[owner]), mass)
    return use.argmax(axis=1)


@dataclass
class Tree:
    """Documents in the order of the leaves, as sparse rows; nodes with their ranges and balls.

    Node 0 is the root; ``child`` is the first of two children, or 0 for a leaf. Centroids are
    sparse columns: of term ``c_terms[i]`` the nodes and values from ``c_bounds[i]`` on.
    """

    rows: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    radii: np.ndarray
    c_terms: np.ndarray
    c_bounds: np.ndarray
    c_nodes: np.ndarray
    c_values: np.ndarray


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each first up to its last, one range behind the other."""
    lengths = last - first
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - lengths), lengths)


def _widest_gap(values: np.ndarray) -> int:
    """Where to cut sorted values: at the widest gap that leaves an eighth on either side.

    So like documents stay together and the depth is logarithmic; equal values are halved.
    """
    low = max(len(values) // 8, 1)
    gaps = np.diff(values[low - 1 : len(values) - low + 1])
    at = int(np.argmax(gaps))
    return low + at if gaps[at] > 0 else len(values) // 2


def build(bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, space: Space) -> Tree:
    """A tree over the documents ``bounds[i]`` to ``bounds[i + 1]``.

    The documents of a node are sorted by how much nearer they are to one than to the other of two
    that lie far apart, and cut in two at a wide gap.
    """
    n = len(bounds) - 1
    local, place = np.unique(terms, return_inverse=True)
    values = impacts * space.roots[terms]
    group = space.group[local] if len(local) else np.zeros(0, int)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    squares = np.bincount(owner, values * values, n)

    order = np.arange(n)
    nodes: list[tuple[int, int, int]] = []  # first, last, child
    centroids: list[tuple[np.ndarray, np.ndarray]] = []
    radii: list[np.ndarray] = []

    def products(docs: np.ndarray, dense: np.ndarray, entries: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bincount(at, values[entries] * dense[place[entries]], len(docs))

    open_: list[int] = [0]
    nodes.append((0, n, 0))
    done = 0
    while done < len(open_):
        node = open_[done]
        done += 1
        first, last, _ = nodes[node]
        docs = order[first:last]
        entries = _ranges(bounds[docs], bounds[docs + 1])
        at = np.repeat(np.arange(len(docs)), bounds[docs + 1] - bounds[docs])
        center = np.bincount(place[entries], values[entries], len(local)) / max(len(docs), 1)
        used = np.flatnonzero(center)
        centroids.append((used, center[used]))
        # Per document and group: sum of squared differences, with what its missing terms add.
        where = at * space.groups + group[place[entries]]
        here = values[entries] * (values[entries] - 2 * center[place[entries]])
        sums = np.bincount(where, here, len(docs) * space.groups).reshape(len(docs), space.groups)
        sizes = np.bincount(where, values[entries] ** 2, len(docs) * space.groups)
        whole = np.bincount(group, center * center, space.groups)
        apart = sums + whole + _SLACK * (sizes.reshape(sums.shape) + whole)
        radii.append(np.sqrt(np.maximum(apart, 0).max(axis=0, initial=0)) * (1 + _SLACK))
        if len(docs) <= LEAF:
            continue
        dense = np.zeros(len(local))

        def apart_from(pivot: int) -> np.ndarray:
            mine = slice(bounds[docs[pivot]], bounds[docs[pivot] + 1])
            dense[place[mine]] = values[mine]
            found = squares[docs] - 2 * products(docs, dense, entries, at) + squares[docs[pivot]]
            dense[place[mine]] = 0
            return found

        one = int(np.argmax(squares[docs] - 2 * products(docs, center, entries, at)))
        from_one = apart_from(one)
        from_two = apart_from(int(np.argmax(from_one)))
        by_nearness = np.argsort(from_one - from_two, kind="stable")
        order[first:last] = docs[by_nearness]
        cut = first + _widest_gap((from_one - from_two)[by_nearness])
        nodes[node] = (first, last, len(nodes))
        open_ += [len(nodes), len(nodes) + 1]
        nodes += [(first, cut, 0), (cut, last, 0)]

    entries = _ranges(bounds[order], bounds[order + 1])
    lengths = bounds[order + 1] - bounds[order]
    at = np.concatenate([used for used, _ in centroids])
    of = np.repeat(np.arange(len(centroids)), [len(used) for used, _ in centroids])
    by_term = np.argsort(at, kind="stable")
    c_terms, c_first = np.unique(at[by_term], return_index=True)
    shape = np.array(nodes, np.int64)
    return Tree(
        rows=order,
        bounds=np.concatenate(([0], np.cumsum(lengths))),
        terms=terms[entries],
        impacts=impacts[entries],
        first=shape[:, 0],
        last=shape[:, 1],
        child=shape[:, 2],
        radii=np.array(radii),
        c_terms=local[c_terms] if len(local) else np.zeros(0, np.int64),
        c_bounds=np.append(c_first, len(at)),
        c_nodes=of[by_term],
        c_values=np.concatenate([v for _, v in centroids])[by_term],
    )


def upper_bounds(tree: Tree, terms: np.ndarray, times: np.ndarray, space: Space) -> np.ndarray:
    """No document below a node scores more than this."""
    scaled = times * space.roots[terms]
    norms = np.sqrt(np.bincount(space.group[terms], scaled * scaled, space.groups)) * (1 + _SLACK)
    bounds = tree.radii @ norms
    at = np.searchsorted(tree.c_terms, terms)
    at[at == len(tree.c_terms)] = 0
    known = np.flatnonzero(tree.c_terms[at] == terms) if len(tree.c_terms) else np.zeros(0, int)
    first, last = tree.c_bounds[at[known]], tree.c_bounds[at[known] + 1]
    entries = _ranges(first, last)
    parts = np.repeat(scaled[known], last - first) * tree.c_values[entries]
    bounds += np.bincount(tree.c_nodes[entries], parts, len(bounds))
    return bounds * (1 + _SLACK) + 1


class Best:
    """The k best of one query so far: larger scores, then smaller ids, null before them."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.floor, self.hits = k, floor, []

    @property
    def least(self) -> int:
        """What scores less is not among the best."""
        return max(self.floor, -self.hits[self.k - 1][0]) if len(self.hits) >= self.k else self.floor

    def add(self, ids: list, scores: list[int]) -> None:
        self.hits += [(-s, i is not None, i or 0) for i, s in zip(ids, scores)]
        self.hits = heapq.nsmallest(self.k, self.hits)

    def rows(self) -> Iterator[tuple[int | None, int]]:
        for score, known, doc in self.hits:
            yield (doc if known else None), -score


def search(
    tree: Tree, ids: list, terms: np.ndarray, times: np.ndarray, space: Space, dense: np.ndarray, best: Best
) -> int:
    """Add the tree's hits to ``best``, nodes of the largest bound first; how many were scored.

    ``dense`` is a zeroed work array with a place per term; it is zero again in the end.
    """
    bounds = upper_bounds(tree, terms, times, space)
    if bounds[0] < best.least:
        return 0
    dense[terms] = times * space.weights[terms]
    scored = 0
    heap = [(-bounds[0], 0)]
    while heap and -heap[0][0] >= best.least:
        node = heapq.heappop(heap)[1]
        if child := int(tree.child[node]):
            heapq.heappush(heap, (-bounds[child], child))
            heapq.heappush(heap, (-bounds[child + 1], child + 1))
            continue
        first, last = int(tree.first[node]), int(tree.last[node])
        a, b = tree.bounds[first], tree.bounds[last]
        scored += last - first
        # Running sums, as a document may have no term at all.
        sums = np.concatenate(([0], np.cumsum(dense[tree.terms[a:b]] * tree.impacts[a:b])))
        scores = np.diff(sums[tree.bounds[first : last + 1] - a])
        hits = np.flatnonzero(scores >= best.least)
        if len(hits):
            best.add([ids[i] for i in tree.rows[first + hits].tolist()], scores[hits].tolist())
    dense[terms] = 0
    return scored
