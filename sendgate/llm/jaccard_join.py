"""N-gram Jaccard join: links of documents by a size-aware heavy-light join of shingle sets.

Two documents link when ``100 * |A & B| >= 75 * |A | B|`` for their sets of 5-word shingles.

1. Documents with equal sets are one class, and one of each class goes on.
2. All sets are put in one order of shingles, seldom ones first. How often a shingle occurs, a
   count sketch of fixed size says, added up over all documents; what occurs once in some
   millions of shingles read one after the other is left out of it. Any order is right, this
   one keeps lists short. Sets of sizes n that link with anything share at least c of the first
   ``n - ceil(0.75 n) + c`` shingles of both.
3. Small (light) sets go by c = 2: every subset of two of these first shingles is a key. Of
   large (heavy) sets every single one is a key, and its inverted list holds the sets that have
   it; c is a sixth of the least overlap, and ``SHARED_KEYS`` at least, where the sizes allow. A set
   that shares fewer of its keys than that with all others together has no candidates and is left
   out, and then lists are shorter, so this goes on while many sets go. As c grows with the set,
   passages that long texts share by chance with many others do not make them candidates. The
   boundary x between small and large is where the costs of both, summed over
   the sizes of all sets, are least. Sets up to 4x/3 have subset keys and those above x single
   ones, so that any two sets that can link meet under a key of one kind.
4. The sets of a key are candidates. Keys with the same least document (hub) are one cluster. In
   a first round every set is compared with the hub that it shares most keys with, which joins
   the members of large groups of near copies in one pass. In a second round only keys whose
   sets are of several components count; the members of a cluster that are not connected yet
   are compared with each other, by scanning inverted lists inside tasks. Clusters of any size
   are cut into chunks. A set stays out of the clusters with which it shares the fewest keys, as
   long as these are fewer than half of those that it shares with any set that it links with: so
   two that link still meet. Sets go to their chunks in passes, so that their copies in shuffle
   files at a time take no more disk than the sets themselves.

So no component is lost, and no group's pairs are written out. Where links are asked for, with their
number per document or pair by pair, one round takes the place of these two: all members of a
cluster are compared with each other, chunk by chunk, and a pair that meets in several clusters
counts in the one with the least hub. Sets are compared exactly, as sets of 64-bit hashes; shingles that differ are taken
for equal with a chance of about 1 in 10**19 each.

Defined results:

* A null or empty text, or one of white space, has no shingles and links with nothing.
* A text of fewer than five words has its whole sequence as its one shingle.
* Repeated rows, also with one id, are documents of their own; equal texts link.
* A component is named by the least id in it; a document without an id counts last, and is named
  null on its own.
* The table has to be a scan or a written table, whose rows keep their places.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sendgate.llm import shingles as S
from sendgate.llm.common import fresh, return_memory
from sendgate.llm.components import components
from sendgate.session import broadcast_if_small, keep, release

_CELL_BITS = 24
_SHEET_BITS = 16  # cells of the sketch in one row
SHARED_KEYS = 16  # the c of large sets, at least
SHARED_PART = 6  # and this part of their least overlap
_LARGE = 2 << 20  # bytes of a group
CANDIDATE_COST = 100  # what another set on a list costs, in keys written
_COUNTED = 1 << 22  # shingles that are counted exactly at a time
_FEW = 0.1  # of the sets; where no more than these go, lists are not looked through again
# Numbers of rows and keys, 16 bytes each, are broadcast up to this many.
BROADCAST_NUMBERS = 1_000_000


@dataclass(frozen=True)
class Join:
    percent: int = 75
    boundary: int | None = None  # largest small set; None: by cost
    chunk: int = 1 << 19  # shingles of a cluster in one task, besides single larger sets
    sent: int = 1 << 27  # shingles that go to tasks in one pass; or as many as all sets have


def _least_shared(n: np.ndarray | int, percent: int):
    """How many shingles a set of n shares at least with any set that it links with."""
    return -(-n * percent // 100)


def _singles(n: np.ndarray | int, percent: int):
    """How many single keys a large set shares at least with any large set of its size or above."""
    least = _least_shared(n, percent)
    return np.where(least >= SHARED_KEYS, np.maximum(SHARED_KEYS, least // SHARED_PART), 1)


def keys_needed(n: Column, percent: int) -> Column:
    """How many single keys a large set of n shares at least with any large set it links with.

    The other one may be as small as the overlap, and then has fewer keys.
    """

    def least(n: Column) -> Column:
        return F.floor((n * percent + 99) / 100)

    own = least(least(n))
    part = F.greatest(F.lit(SHARED_KEYS).cast("long"), F.floor(own / SHARED_PART))
    return F.when(own >= SHARED_KEYS, part).otherwise(F.lit(1).cast("long"))


# The first pass: sizes, classes and the sketch ----------------------------------------


def _describe(texts: DataFrame) -> DataFrame:
    """A row per text: size and hash of its set; and rows with parts of the count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "n", "one", "two", "sheet", "cells", "times"]
        held: list[np.ndarray] = []
        counted: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            found = np.concatenate(held)
            held.clear()
            found.sort()
            # Every further occurrence of a shingle; the first one is added below.
            again = found[1:][found[1:] == found[:-1]]
            again, times = np.unique(again, return_counts=True)
            cells = (again >> np.uint64(64 - _CELL_BITS)).astype(np.uint32)
            counted.append((cells, (times + 1).astype(np.uint32)))

        for batch in S.in_chunks(batches, "text"):
            hashes, bounds = S.shingle_sets(batch["text"])
            n = np.diff(bounds)
            sums = np.zeros((2, len(n)), np.uint64)
            filled = n > 0
            if filled.any():
                at = bounds[:-1][filled]
                sums[0, filled] = np.add.reduceat(S.mix(hashes + np.uint64(1)), at)
                sums[1, filled] = np.bitwise_xor.reduceat(S.mix(hashes ^ np.uint64(0x5BD1E995)), at)
                held.append(hashes)
                if sum(map(len, held)) >= _COUNTED:
                    count()
            none = len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.array(n),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.nulls(none, pa.int32()),
                    pa.nulls(none, pa.binary()),
                    pa.nulls(none, pa.binary()),
                ],
                names,
            )
        if held:
            count()
        return_memory()
        if counted:
            cells, place = np.unique(
                np.concatenate([cells for cells, _ in counted]), return_inverse=True
            )
            times = np.bincount(place, np.concatenate([times for _, times in counted]))
            times = np.minimum(times, 2**32 - 1).astype("<u4")
            sheet, first = np.unique(cells >> _SHEET_BITS, return_index=True)
            spans = list(pairwise([*first.tolist(), len(cells)]))
            none = pa.nulls(len(sheet), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[none] * 4,
                    pa.array(sheet, pa.int32()),
                    pa.array([cells[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                    pa.array([times[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names,
            )

    return texts.mapInArrow(
        run, "row long, n long, one long, two long, sheet int, cells binary, times binary"
    )


def _add_sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of each sheet from its parts, which come one behind the other; one sheet is held."""
    current = None
    counts = np.zeros(1 << _SHEET_BITS, np.int64)

    def finished() -> pa.RecordBatch:
        levels = np.ceil(np.log2(counts + 1)).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([levels.tobytes()], pa.binary())],
            ["sheet", "levels"],
        )

    for batch in batches:
        columns = (batch[name] for name in ("sheet", "cells", "times"))
        for sheet, cells, times in zip(*columns, strict=True):
            if sheet.as_py() != current:
                if current is not None:
                    yield finished()
                current = sheet.as_py()
                counts[:] = 0
            at = np.frombuffer(cells.as_buffer(), "<u4") & np.uint32((1 << _SHEET_BITS) - 1)
            counts[at] += np.frombuffer(times.as_buffer(), "<u4")
    if current is not None:
        yield finished()


def _levels(described: DataFrame) -> np.ndarray:
    """How often the shingles of each cell occur, in powers of two; 0 if hardly ever.

    The counts of all parts are added up sheet by sheet; the result is a table of fixed size.
    """
    parts = described.where("sheet is not null").select("sheet", "cells", "times")
    dealt = parts.repartition("sheet").sortWithinPartitions("sheet")
    levels = np.zeros(1 << _CELL_BITS, np.uint8)
    for row in dealt.mapInArrow(_add_sheets, "sheet int, levels binary").toLocalIterator():
        start = row["sheet"] << _SHEET_BITS
        levels[start : start + (1 << _SHEET_BITS)] = np.frombuffer(row["levels"], np.uint8)
    return levels


# The boundary between small and large sets --------------------------------------------


def _list_lengths(levels: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Shares of all occurrences, seldom shingles first, and the mean list length up to each.

    ``total`` is the number of all occurrences; those that the sketch has not are on lists of
    one.
    """
    # Sheet by sheet, as counting makes wide numbers of all that it is given.
    sheets = levels.reshape(-1, min(len(levels), 1 << _SHEET_BITS))
    cells = sum(np.bincount(sheet, minlength=64) for sheet in sheets)[1:].astype(float)
    length = 2.0 ** np.arange(1, len(cells) + 1)
    mass = np.maximum(total - (cells * length).sum(), 0.0) + np.cumsum(cells * length)
    means = 1.0 + np.cumsum(cells * length * length) / np.maximum(mass, 1.0)
    top = max(total, float(mass[-1]) if len(mass) else 0.0, 1.0)
    return np.concatenate(([0.0], mass / top)), np.concatenate(([1.0], means))


def choose_boundary(sizes: dict[int, int], levels: np.ndarray, percent: int) -> int:
    """The size x up to which sets are small: where enumerating and scanning cost least.

    ``sizes`` says how many sets have about each size.
    """
    if not sizes:
        return 0
    total = float(sum(n * many for n, many in sizes.items()))
    shares, lengths = _list_lengths(levels, total)

    def subsets(n: int) -> int:
        return math.comb(n - _least_shared(n, percent) + 2, 2)

    def scans(n: int) -> float:
        first = n - _least_shared(n, percent) + int(_singles(n, percent))
        others = float(np.interp(min(1.0, first / n), shares, lengths)) - 1.0
        return first * (1.0 + CANDIDATE_COST * others)

    def cost(x: int) -> float:
        return sum(
            many * ((subsets(n) if n * percent <= x * 100 else 0) + (scans(n) if n > x else 0))
            for n, many in sizes.items()
            if n > 1
        )

    return min(sorted({0, 1, *sizes}), key=cost)


# The second pass: keys ----------------------------------------------------------------


def _keys(texts: DataFrame, levels: np.ndarray, boundary: int, percent: int) -> DataFrame:
    """Keys of every set: single shingles of large sets, subsets of two of small ones."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)  # 16 megabytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in S.in_chunks(batches, "text"):
            hashes, bounds = S.shingle_sets(batch["text"])
            n = np.diff(bounds)
            owner = np.repeat(np.arange(len(n)), n)
            level = shared.value[(hashes >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]
            order = np.lexsort((hashes, level, owner))
            hashes = hashes[order]
            place = np.arange(len(hashes)) - bounds[:-1][owner]
            rest = n - _least_shared(n, percent)
            heavy = (n > boundary) & (n > 1)
            light = (n * percent <= boundary * 100) & (n > 1)
            one = heavy[owner] & (place < (rest + _singles(n, percent))[owner])
            keys, owners = [hashes[one]], [owner[one]]
            for doc in np.flatnonzero(light):
                first = hashes[bounds[doc] :][: rest[doc] + 2]
                a, b = np.triu_indices(len(first), 1)
                low, high = np.minimum(first[a], first[b]), np.maximum(first[a], first[b])
                keys.append(S.mix(S.mix(low) + high * np.uint64(3)))
                owners.append(np.full(len(a), doc))
            rows = batch["row"].to_numpy()[np.concatenate(owners)]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(rows)],
                    ["key", "row"],
                )
        return_memory()

    return texts.mapInArrow(run, "key long, row long")


# Comparing inside tasks ---------------------------------------------------------------


def _linked(overlap, n, m, percent: int):
    return 100 * overlap >= percent * (n + m - overlap)


def _sets(table: pa.Table) -> list[np.ndarray]:
    if table.nbytes >= _LARGE:  # what the groups before it took, not once per small group
        return_memory()
    return [np.frombuffer(x.as_buffer(), "<u8") for x in table["hashes"].combine_chunks()]


def _compare_with_hub(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        hub = key[0].as_py()
        rows, sets = table["row"].to_pylist(), _sets(table)
        centre = sets[rows.index(hub)]
        found = []
        for row, own in zip(rows, sets, strict=True):
            if row != hub:
                overlap = len(np.intersect1d(own, centre, assume_unique=True))
                if _linked(overlap, len(own), len(centre), percent):
                    found.append(row)
        return pa.table(
            {"a": pa.array(found, pa.int64()), "b": pa.array([hub] * len(found), pa.int64())}
        )

    return run


def _compare_chunks(percent: int):
    """Links between members of two chunks of a cluster that are not connected yet."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        table = table.sort_by("row")
        rows, roots = table["row"].to_pylist(), table["root"].to_pylist()
        chunk = table["chunk"].to_numpy()
        sets = _sets(table)
        sizes = np.array([len(s) for s in sets])
        right = np.flatnonzero(chunk == high)
        left = np.flatnonzero(chunk == low)
        tokens = np.concatenate([sets[i] for i in right]) if len(right) else np.zeros(0, "<u8")
        holder = np.repeat(np.arange(len(right)), sizes[right])
        order = np.argsort(tokens, kind="stable")
        tokens, holder = tokens[order], holder[order]
        name = {root: root for root in roots}

        def find(root: int) -> int:
            while name[root] != root:
                name[root] = name[name[root]]
                root = name[root]
            return root

        found = []
        for i in left:
            start = np.searchsorted(tokens, sets[i], "left")
            stop = np.searchsorted(tokens, sets[i], "right")
            lengths = stop - start
            at = np.arange(lengths.sum()) + np.repeat(start - np.cumsum(lengths) + lengths, lengths)
            overlap = np.bincount(holder[at], minlength=len(right))
            near = _linked(overlap, sizes[i], sizes[right], percent)
            for j in right[near].tolist():
                a, b = find(roots[i]), find(roots[j])
                if a != b:
                    name[max(a, b)] = min(a, b)
                    found.append((rows[i], rows[j]))
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
            }
        )

    return run


def _overlaps(
    tokens: np.ndarray, holder: np.ndarray, own: np.ndarray, n_holders: int
) -> np.ndarray:
    """How many of ``own`` each holder has; ``tokens`` are sorted, with their holders beside."""
    start, stop = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
    lengths = stop - start
    at = np.arange(lengths.sum()) + np.repeat(start - np.cumsum(lengths) + lengths, lengths)
    return np.bincount(holder[at], minlength=n_holders)


def _inverted(lists: list[np.ndarray], kind: str) -> tuple[np.ndarray, np.ndarray]:
    tokens = np.concatenate([*lists, np.zeros(0, kind)])
    holder = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(tokens, kind="stable")
    return tokens[order], holder[order]


def _compare_all(percent: int, every_pair: bool):
    """All links between two chunks of a cluster: their number per row, and linked pairs.

    Without ``every_pair``, only pairs that connect what was not connected in this task. A pair
    that also meets in a cluster of a lesser hub is left to that one.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        hub, low, high = (x.as_py() for x in key)
        table = table.sort_by("row")
        rows, weights = table["row"].to_numpy(), table["weight"].to_numpy()
        chunk = table["chunk"].to_numpy()
        sets = _sets(table)
        lesser = [np.array(x, np.int64) for x in table["hubs"].to_pylist()]
        lesser = [x[x < hub] for x in lesser]
        sizes = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        tokens, holder = _inverted([sets[i] for i in right], "<u8")
        hub_tokens, hub_holder = _inverted([lesser[i] for i in right], "<i8")
        links = np.zeros(len(rows), np.int64)
        part = np.arange(len(rows))
        pairs: list[tuple[int, np.ndarray]] = []
        for i in left:
            overlap = _overlaps(tokens, holder, sets[i], len(right))
            near = _linked(overlap, sizes[i], sizes[right], percent)
            if low == high:
                near &= right > i
            if near.any() and len(lesser[i]):
                near &= _overlaps(hub_tokens, hub_holder, lesser[i], len(right)) == 0
            found = right[near]
            links[i] += weights[found].sum()
            links[found] += weights[i]
            if not every_pair:
                found = found[part[found] != part[i]]
                parts, first = np.unique(part[found], return_index=True)
                found = found[first]
                part[np.isin(part, parts)] = part[i]
            if len(found):
                pairs.append((rows[i], rows[found]))
        held = np.flatnonzero(links)
        a = [np.full(len(others), row) for row, others in pairs]
        b = [others for _, others in pairs]
        n_pairs = sum(map(len, b))
        return pa.table(
            {
                "row": pa.array(np.concatenate([rows[held], *a]), pa.int64()),
                "links": pa.array([*links[held].tolist(), *[None] * n_pairs], pa.int64()),
                "other": pa.array(
                    [*[None] * len(held), *np.concatenate([np.zeros(0, np.int64), *b]).tolist()],
                    pa.int64(),
                ),
            }
        )

    return run


def _numbers(table: DataFrame) -> DataFrame:
    return broadcast_if_small(table, BROADCAST_NUMBERS)


def _candidate_sets(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The sets of the rows that have candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in S.in_chunks(batches, "text"):
            hashes, bounds = S.shingle_sets(batch["text"])
            raw = hashes.astype("<u8").tobytes()
            ends = (8 * bounds).tolist()
            parts = [raw[a:b] for a, b in pairwise(ends)]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(parts, pa.binary())], ["row", "hashes"]
            )
        return_memory()

    wanted = _numbers(keep(members.select("row").distinct(), "wanted"))
    return keep(
        texts.join(wanted, "row", "left_semi").mapInArrow(run, "row long, hashes binary"), "sets"
    )


@dataclass(frozen=True)
class _Needs:
    """How many keys a set shares at least with any set that it links with."""

    boundary: int
    percent: int

    def least(self) -> Column:
        # Sets that may link with small ones share subset keys with these, one at least.
        large = F.col("n") * self.percent > self.boundary * 100
        return F.when(large, keys_needed(F.col("n"), self.percent)).otherwise(F.lit(1).cast("long"))

    def marked(self, listed: DataFrame, sizes: DataFrame) -> DataFrame:
        """The rows of ``listed``, and whether they have as many keys there as a link takes."""
        counted = listed.groupBy("row").agg(F.count("*").alias("shared")).join(sizes, "row")
        return counted.select("row", (F.col("shared") >= self.least()).alias("enough"))

    def enough(self, listed: DataFrame, sizes: DataFrame) -> DataFrame:
        """The rows that have as many keys in ``listed`` as a link takes."""
        return self.marked(listed, sizes).where("enough").select("row")

    def without_least(self, shared: DataFrame, sizes: DataFrame) -> DataFrame:
        """``shared`` (hub, row, shared) with n, less the hubs a row need not meet others at.

        Of the keys that two linking rows share, each of them gives up fewer than half, so a hub is
        left at which both are.
        """
        given_up = F.sum("shared").over(
            Window.partitionBy("row").orderBy("shared", "hub").rowsBetween(Window.unboundedPreceding, 0)
        )
        sized = shared.join(sizes, "row").withColumn("given_up", given_up)
        return sized.where(F.col("given_up") * 2 >= self.least()).drop("given_up")


def _on_lists(keys: DataFrame) -> DataFrame:
    """Keys and rows on lists of two or more."""
    many = F.count("*").over(Window.partitionBy("key"))
    return keep(keys.withColumn("many", many).where("many > 1").drop("many"), "listed")


def _listed(keys: DataFrame, sizes: DataFrame, needs: _Needs) -> DataFrame:
    """Keys and rows on lists of two or more, of rows that have enough of them."""
    # Most keys are on one set only: one shuffle tells, where a join would take a second one. They
    # go into it as they are made; written first, they would take as much disk again.
    listed = _on_lists(keys)
    while True:
        marked = keep(needs.marked(listed, sizes), "marked")
        rows, gone = marked.agg(F.count("*"), F.count_if(~F.col("enough"))).first()
        enough = marked.where("enough").select("row")
        whole = _on_lists(listed.join(_numbers(enough), "row", "left_semi"))
        release(listed)
        release(marked)
        listed = whole
        if gone <= _FEW * rows:
            return listed


def _shared_with_hubs(listed: DataFrame) -> DataFrame:
    """Rows with the hubs (the least rows) of their lists, and how many lists they share."""
    hubs = (
        listed.groupBy("key")
        .agg(F.min("row").alias("hub"), F.count("*").alias("many"))
        .where("many > 1")
        .select("key", "hub")
    )
    joined = listed.join(_numbers(keep(hubs, "hubs")), "key")
    return keep(joined.groupBy("hub", "row").agg(F.count("*").alias("shared")), "shared")


def _first_clusters(listed: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Every row with the one hub it shares most lists with: hub, row, n, total.

    Sets of sizes that cannot link are left out.
    """
    sized = _shared_with_hubs(listed).where("hub != row").join(sizes, "row")
    sized = sized.join(sizes.select(F.col("row").alias("hub"), F.col("n").alias("hub_n")), "hub")
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    best = (
        sized.where(fits)
        .groupBy("row", "n")
        .agg(F.max_by(F.struct("hub", "hub_n"), F.struct("shared", -F.col("hub"))).alias("best"))
        .select(F.col("best.hub").alias("hub"), "row", "n", F.col("best.hub_n").alias("hub_n"))
    )
    best = keep(best, "best")
    hubs = best.groupBy("hub").agg(F.max("hub_n").alias("n"), F.sum("n").alias("total"))
    hubs = keep(hubs, "hubs")
    members = best.select("hub", "row", "n").unionAll(hubs.select("hub", F.col("hub").alias("row"), "n"))
    return keep(members.join(_numbers(hubs.select("hub", "total")), "hub"), "clusters")


def _second_clusters(
    listed: DataFrame, reached: DataFrame, sizes: DataFrame, needs: _Needs
) -> DataFrame:
    """What may still link: hub, row, n and root of rows on lists with several components.

    A row that links with one of another component shares enough such lists. A row that has no
    other of a size that it can link with in its cluster is left out.
    """
    roots = _numbers(reached.withColumnRenamed("node", "row"))
    rooted = listed.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    open_keys = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low != high")
        .select("key")
    )
    left = keep(listed.join(_numbers(keep(open_keys, "open")), "key", "left_semi"), "listed")
    enough = _numbers(keep(needs.enough(left, sizes), "enough"))
    left = keep(left.join(enough, "row", "left_semi"), "listed")
    by_size = Window.partitionBy("hub").orderBy("n", "row")
    members = (
        needs.without_least(_shared_with_hubs(left), sizes)
        .withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
        .where(
            (F.col("n") * needs.percent <= F.col("below") * 100)
            | (F.col("above") * needs.percent <= F.col("n") * 100)
        )
        .select("hub", "row", "n")
    )
    members = members.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    return keep(members, "clusters")


def _of_near_size(members: DataFrame, percent: int) -> DataFrame:
    """The members (hub, row, n) with another one in their cluster of a size they can link with."""
    # By different sizes, of which a cluster has few, not by members.
    sizes = keep(members.groupBy("hub", "n").agg(F.count("*").alias("many")), "sizes")
    by_size = Window.partitionBy("hub").orderBy("n")
    near = (
        sizes.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
        .where(
            (F.col("many") > 1)
            | (F.col("n") * percent <= F.col("below") * 100)
            | (F.col("above") * percent <= F.col("n") * 100)
        )
        .select("hub", "n")
    )
    return members.join(_numbers(keep(near, "near")), ["hub", "n"], "left_semi")


def _in_passes(
    dealt: DataFrame, group: list[str], one_pass: Callable[[DataFrame], DataFrame], join: Join
) -> DataFrame:
    """What ``one_pass`` gives for all groups of ``dealt``; its rows have the sizes of their sets.

    Sets that go to many groups go there in passes of some groups each, none of which takes much
    more shingles than there are in all sets, or than ``join.sent``.
    """
    dealt = keep(dealt, "dealt")
    rows = dealt.groupBy("row").agg(F.first("n").alias("n"), F.count("*").alias("times"))
    once, sent = rows.agg(F.sum("n"), F.sum(F.col("n") * F.col("times"))).first()
    passes = max(1, math.ceil((sent or 0) / max(join.sent, once or 0)))
    place = F.pmod(F.xxhash64(*group), F.lit(passes))
    done = []
    for number in range(passes):
        own = dealt if passes == 1 else keep(dealt.where(place == number), "dealt")
        done.append(keep(one_pass(own), "links"))
    return reduce(DataFrame.unionAll, done)


def _all_links(found: _Found, weights: DataFrame, join: Join, every_pair: bool) -> DataFrame:
    """Every link: (row, links) to be added up per row, and linked pairs (row, other).

    ``weights`` has the number of documents of each set that several have. Without
    ``every_pair``, the pairs are only enough to connect what links.
    """
    members = found.needs.without_least(_shared_with_hubs(found.listed), found.sizes)
    members = members.select("hub", "row", "n")
    clusters = keep(_of_near_size(keep(members, "members"), join.percent), "clusters")
    traits = (
        clusters.groupBy("row")
        .agg(F.sort_array(F.collect_list("hub")).alias("hubs"))
        .join(weights, "row", "left")
        .select("row", "hubs", F.coalesce("weight", F.lit(1).cast("long")).alias("weight"))
    )
    traits = keep(traits, "traits")
    totals = clusters.groupBy("hub").agg(F.ceil(F.sum("n") / F.lit(join.chunk)).alias("pieces"))
    placed = clusters.join(_numbers(keep(totals, "totals")), "hub").withColumn(
        "chunk", F.pmod(F.xxhash64("row"), "pieces")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other")
    dealt = placed.select("hub", "row", "n", "chunk", other).select(
        "hub",
        "row",
        "n",
        "chunk",
        F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
    )
    compare = _compare_all(join.percent, every_pair)

    def one_pass(dealt: DataFrame) -> DataFrame:
        return (
            found.sets.join(_numbers(traits), "row")
            .join(_numbers(dealt), "row")
            .select("hub", "low", "high", "row", "chunk", "weight", "hubs", "hashes")
            .groupBy("hub", "low", "high")
            .applyInArrow(compare, "row long, links long, other long")
        )

    return _in_passes(dealt, ["hub", "low", "high"], one_pass, join)


def _first_round(clusters: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    pieces = F.ceil(F.col("total") / F.lit(join.chunk))
    member = F.col("row") != F.col("hub")
    # The hub goes to every chunk of its cluster.
    dealt = clusters.select(
        "hub",
        "row",
        "n",
        F.explode(
            F.when(member, F.array(F.pmod(F.xxhash64("row"), pieces))).otherwise(
                F.sequence(F.lit(0).cast("long"), pieces - 1)
            )
        ).alias("chunk"),
    )
    # The numbers go to the sets, which then are shuffled once, to their groups.
    compare = _compare_with_hub(join.percent)

    def one_pass(dealt: DataFrame) -> DataFrame:
        return (
            sets.join(_numbers(dealt), "row")
            .select("hub", "chunk", "row", "hashes")
            .groupBy("hub", "chunk")
            .applyInArrow(compare, "a long, b long")
        )

    return _in_passes(dealt, ["hub", "chunk"], one_pass, join)


def _second_round(clusters: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links between members of clusters that are of different components."""
    centre = clusters.groupBy("hub").agg(F.min_by("root", "row").alias("hub_root"))
    named = keep(clusters.join(_numbers(keep(centre, "centres")), "hub"), "named")
    apart = F.col("root") != F.col("hub_root")
    open_ = (
        named.groupBy("hub")
        .agg(
            F.sum(F.when(apart, F.col("n")).otherwise(0)).alias("outside"),
            F.sum(F.when(apart, 0).otherwise(F.col("n"))).alias("inside"),
            F.count_if(apart).alias("n_apart"),
        )
        .where("n_apart > 0")
    )
    chunk = F.lit(join.chunk)
    open_ = open_.select(
        "hub",
        F.greatest(F.lit(1), F.ceil(F.col("outside") / chunk)).alias("first"),
        F.greatest(F.lit(1), F.ceil(F.col("inside") / chunk)).alias("second"),
    )
    placed = named.join(_numbers(keep(open_, "open")), "hub").withColumn(
        "chunk",
        F.when(apart, F.pmod(F.xxhash64("row"), "first")).otherwise(
            F.col("first") + F.pmod(F.xxhash64("row"), "second")
        ),
    )
    # Chunks of members outside the hub's component meet each other and all chunks inside.
    pairs = F.filter(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("first") + F.col("second") - 1),
            lambda other: F.struct(
                F.least(other, "chunk").alias("low"), F.greatest(other, "chunk").alias("high")
            ),
        ),
        lambda pair: pair.low < F.col("first"),
    )
    dealt = placed.select("hub", "row", "n", "root", "chunk", F.explode(pairs).alias("pair"))
    dealt = dealt.select("hub", "pair.low", "pair.high", "row", "n", "root", "chunk")
    compare = _compare_chunks(join.percent)

    def one_pass(dealt: DataFrame) -> DataFrame:
        return (
            sets.join(_numbers(dealt), "row")
            .select("hub", "low", "high", "row", "root", "chunk", "hashes")
            .groupBy("hub", "low", "high")
            .applyInArrow(compare, "a long, b long")
        )

    return _in_passes(dealt, ["hub", "low", "high"], one_pass, join)


@dataclass(frozen=True)
class _Found:
    """What is known before sets are compared."""

    known: DataFrame  # row, id, n and class of every document
    listed: DataFrame
    sets: DataFrame
    sizes: DataFrame
    needs: _Needs

    def weights(self) -> DataFrame:
        """The number of documents of each set that several have."""
        many = self.known.where("n > 0").groupBy(F.col("class").alias("row"))
        return many.agg(F.count("*").alias("weight")).where("weight > 1")


def _prepare(docs: DataFrame, id: str, text: str, join: Join) -> _Found:
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text")
    )
    described = keep(_describe(texts.select("row", "text")), "described")
    ids = texts.select("row", "id")
    sizes = described.where("row is not null").select("row", "n", "one", "two")
    levels = _levels(described)

    classes = (
        sizes.where("n > 0")
        .groupBy("n", "one", "two")
        .agg(F.min("row").alias("class"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    classes = _numbers(keep(classes, "classes"))
    known = keep(
        ids.join(sizes, "row")
        .join(classes, ["n", "one", "two"], "left")
        .select("row", "id", "n", F.coalesce("class", "row").alias("class")),
        "known",
    )
    release(described)
    copies = _numbers(keep(known.where("row != class").select("row"), "copies"))
    singles = texts.select("row", "text").join(copies, "row", "left_anti")

    boundary = join.boundary
    if boundary is None:
        # Sizes above 16 are put together in steps of an eighth, so the table stays small.
        step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2("n")) - 3))
        near = known.where("n > 0 and row = class").select(
            (F.floor(F.col("n") / step) * step).cast("long").alias("size")
        )
        boundary = choose_boundary(
            {r["size"]: r["count"] for r in near.groupBy("size").count().collect()},
            levels,
            join.percent,
        )
    keys = _keys(singles, levels, boundary, join.percent)
    needs, sizes = _Needs(boundary, join.percent), known.select("row", "n")
    listed = _listed(keys, sizes, needs)
    return _Found(known, listed, _candidate_sets(singles, listed), sizes, needs)


def _connected(found: _Found, join: Join) -> DataFrame:
    """The least node that each linked row reaches, by as few links as it takes."""
    clusters = _first_clusters(found.listed, found.sizes, join.percent)
    first = _first_round(clusters, found.sets, join)
    release(clusters)
    reached = keep(components(first), "components")
    clusters = _second_clusters(found.listed, reached, found.sizes, found.needs)
    second = _second_round(clusters, found.sets, join)
    release(clusters)
    release(found.listed)
    release(found.sets)
    return keep(components(first.unionAll(second)), "components")


def _pairs(found: DataFrame) -> DataFrame:
    return found.where("other is not null").select(
        F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")
    )


def link_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    join: Join | None = None,
    links: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``_row`` (its place), ``id``, n_shingles, class_id and component_id.

    ``class_id`` is the least id of the documents with the same set, ``component_id`` the least
    that links reach. ``_first`` is true for one row of each component. With ``links``, every
    candidate pair is compared, and n_links is the number of other documents that link.
    """
    join = join or Join()
    found = _prepare(docs, id, text, join)
    known = found.known
    if links:
        weights = keep(found.weights(), "weights")
        linked = _all_links(found, weights, join, False)
        release(found.listed)
        release(found.sets)
        reached = keep(components(_pairs(linked)), "components")
        counts = linked.where("links is not null").groupBy("row").agg(F.sum("links").alias("n_links"))
        counts = keep(
            counts.join(weights, "row", "full").select(
                F.col("row").alias("class"),
                (F.coalesce("n_links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links"),
            ),
            "counts",
        )
        known = known.join(_numbers(counts), "class", "left")
        known = known.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    else:
        reached = _connected(found, join)
    counted = ["n_links"] if links else []
    roots = _numbers(reached.select(F.col("node").alias("class"), "root"))
    named = keep(
        known.join(roots, "class", "left").select(
            "row", "id", "n", "class", F.coalesce("root", "class").alias("root"), *counted
        ),
        "roots",
    )
    groups = named.groupBy("root").agg(F.min("id").alias("component_id"), F.min("row").alias("first"))
    class_names = named.groupBy("class").agg(F.min("id").alias("class_id"))
    return (
        named.join(keep(groups, "names"), "root")
        .join(keep(class_names, "names"), "class")
        .select(
            F.col("row").alias("_row"),
            F.col("id").alias(id),
            F.col("n").alias("n_shingles"),
            "class_id",
            "component_id",
            (F.col("row") == F.col("first")).alias("_first"),
            *counted,
        )
    )


def linked_pairs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", join: Join | None = None
) -> DataFrame:
    """Every linked pair of different sets, by one document of each: the first in the table.

    The columns are the places ``_a`` and ``_b`` with ``_a < _b``, and the ids a and b. Documents with
    equal sets link, too; link_documents has their class. A group of m near copies that all link
    gives m(m - 1)/2 rows.
    """
    join = join or Join()
    found = _prepare(docs, id, text, join)
    weights = keep(found.weights(), "weights")
    linked = _all_links(found, weights, join, True)
    pairs = _pairs(linked).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    for side in "ab":
        named = found.known.select(F.col("row").alias(f"_{side}"), F.col("id").alias(side))
        pairs = pairs.join(named, f"_{side}")
    return pairs.select("_a", "_b", "a", "b")


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", join: Join | None = None
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the first with the least id."""
    linked = keep(link_documents(docs, id, text, join), "linked")
    row = fresh(docs.columns, "_row")
    gone = linked.where(~F.col("_first")).select(F.col("_row").alias(row))
    marked = docs.withColumn(row, F.monotonically_increasing_id())
    return marked.join(_numbers(keep(gone, "gone")), row, "left_anti").drop(row)
