"""Embedding near-duplicates: an epsilon grid order join.

Vectors of length one with a cosine of ``t`` or more are at most ``eps = sqrt(2 - 2t)`` apart.
They are projected on their principal axes (fitted on a bounded sample), given the cell of a
grid with side ``eps`` on the leading axes, and sorted by cell over all tasks. Blocks of the
sorted sequence, and intervals of 8, 64, ... blocks, keep the box of their leading projections.
Starting with the whole sequence against itself, pairs of intervals are joined with their parts
by Spark, level by level, and a pair whose boxes are more than ``eps`` apart is skipped. The
pairs of blocks that are left are joined inside tasks, where the recursion goes on to smaller
intervals and ends in matrix products; the cosine that decides is taken in double precision from
the given vectors.

A task counts the links of its vectors and hands on links that connect what it found connected,
not all of them, so a group of many near copies gives few rows. Components follow from these.

Defined results:

* Vectors that are null, zero or hold null or non-finite components link with nothing: no links,
  a component of their own. Vectors of different lengths have no cosine: each length is a join
  of its own.
* Repeated rows, also with one id, are vectors of their own and link with each other.
* A component is named by its least id; a vector without an id is named null on its own.
* Every column of the input stays, except the vector and those named like an output column.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sendgate.llm import vectors as V
from sendgate.llm.common import fresh
from sendgate.llm.components import components
from sendgate.session import keep


@dataclass(frozen=True)
class Grid:
    sample: int = 10_000  # vectors that the principal axes are fitted on, at most
    axes: int = 8  # leading axes of the grid
    boxed: int = 16  # leading axes of the boxes that Spark compares
    block: int = 1_024  # vectors in a block
    leaf: int = 512  # vectors in an interval that is not divided further
    spread: int = 16_384  # vectors in a sorted partition


_BITS = 3  # an interval has 8 parts


def _principal_axes(sample: np.ndarray) -> np.ndarray:
    rows = V.units(sample)
    _, axes = np.linalg.eigh(np.cov(rows.T, bias=True).reshape(rows.shape[1], -1))
    return np.ascontiguousarray(axes[:, ::-1])


def _blocks(good: DataFrame, axes: np.ndarray, eps: float, grid: Grid, n_parts: int) -> DataFrame:
    """Blocks of the vectors in grid order, with the boxes of their leading projections."""
    length = len(axes)
    leading, boxed = axes[:, : grid.axes], axes[:, : grid.boxed]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = V.units(V.matrix(batch["vector"], length)) @ leading
                cells = np.floor(at / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"],
                        batch["vector"],
                        pa.FixedSizeListArray.from_arrays(
                            pa.array(cells.ravel()), cells.shape[1]
                        ).cast(pa.list_(pa.int32())),
                        pa.array(at[:, 0]),
                    ],
                    ["row", "vector", "cells", "first"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, held, n_held = 0, [], 0

        def packed(rows: pa.Table, nth: int) -> pa.RecordBatch:
            given = V.matrix(rows["vector"], length)
            at = V.units(given) @ boxed
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([rows["part"][0].as_py()], pa.int64()),
                    "nth": pa.array([nth], pa.int64()),
                    "rows": [rows["row"].to_numpy().astype("<i8").tobytes()],
                    "given": [given.astype("<f8").tobytes()],
                    "low": [at.min(axis=0).tolist()],
                    "high": [at.max(axis=0).tolist()],
                }
            )

        for batch in batches:
            held.append(batch)
            n_held += batch.num_rows
            if n_held >= grid.block:
                table = pa.Table.from_batches(held)
                while table.num_rows >= grid.block:
                    yield packed(table.slice(0, grid.block), nth)
                    table, nth = table.slice(grid.block), nth + 1
                held, n_held = table.to_batches(), table.num_rows
        if n_held:
            yield packed(pa.Table.from_batches(held), nth)

    kind = good.schema["vector"].dataType.simpleString()
    order = ["cells", "first", "row"]
    placed = good.mapInArrow(
        place, f"row long, vector {kind}, cells array<int>, first double"
    )
    # The range bounds are drawn by sampling; the blocks are written, and never made again.
    ranged = placed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    return keep(
        ranged.select("row", "vector", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
            pack,
            "part long, nth long, rows binary, given binary,"
            " low array<double>, high array<double>",
        ),
        "blocks",
    )


def _apart(n: int) -> Column:
    """The squared distance of two boxes."""

    def gap(i: Column) -> Column:
        one = F.get("low", i) - F.get("other_high", i)
        two = F.get("other_low", i) - F.get("high", i)
        return F.greatest(F.lit(0.0), one, two)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0.0), lambda s, i: s + gap(i) * gap(i)
    )


def _near_blocks(blocks: DataFrame, eps: float, n_boxed: int) -> DataFrame:
    """Pairs of blocks (a, b), a <= b, that may hold near vectors, found interval by interval."""
    levels = [blocks.select("block", "low", "high")]
    last = blocks.agg(F.max("block")).first()[0] or 0
    while last >> (_BITS * (len(levels) - 1)):
        boxes = levels[-1].groupBy(F.shiftright("block", _BITS).alias("block"))
        levels.append(
            keep(
                boxes.agg(
                    F.array(*[F.min(F.get("low", F.lit(i))) for i in range(n_boxed)]).alias("low"),
                    F.array(*[F.max(F.get("high", F.lit(i))) for i in range(n_boxed)]).alias("high"),
                ),
                "intervals",
            )
        )
    pairs = levels[-1].select(F.col("block").alias("a"), F.col("block").alias("b"))
    for level in levels[-2::-1]:
        parts = level.withColumn("above", F.shiftright("block", _BITS))
        one = parts.select(F.col("above").alias("a"), F.col("block").alias("part_a"), "low", "high")
        two = parts.select(
            F.col("above").alias("b"),
            F.col("block").alias("part_b"),
            F.col("low").alias("other_low"),
            F.col("high").alias("other_high"),
        )
        pairs = keep(
            pairs.join(one, "a")
            .join(two, "b")
            .where((F.col("part_a") <= F.col("part_b")) & (_apart(n_boxed) <= eps * eps + 1e-9))
            .select(F.col("part_a").alias("a"), F.col("part_b").alias("b")),
            "pairs",
        )
    return pairs


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns; equal ones are connected by ``linked``."""
    n = linked.shape[0]
    rows = np.arange(n)
    while True:
        columns = np.where(linked, rows[:, None], n).min(axis=0)
        new = np.minimum(rows, np.where(linked, columns[None, :], n).min(axis=1))
        new = np.minimum(new, new[np.minimum(new, n - 1)])
        if np.array_equal(new, rows):
            return rows, columns
        rows = new


class _Side:
    """The vectors of one block: given, of length one, and along the principal axes."""

    def __init__(self, rows: bytes, given: bytes, axes: np.ndarray) -> None:
        self.rows = np.frombuffer(rows, "<i8")
        scale = np.frombuffer(given, "<f8").reshape(len(self.rows), -1)
        self.given = scale / np.abs(scale).max(axis=1, keepdims=True)
        self.norms = np.linalg.norm(self.given, axis=1)
        self.at = (self.given / self.norms[:, None] @ axes).astype(np.float32)


def _join_intervals(
    one: _Side, two: _Side, a: slice, b: slice, eps: float, leaf: int
) -> Iterator[tuple[slice, slice]]:
    """Pairs of intervals, small enough to compare directly, that may hold near vectors."""
    left, right = one.at[a], two.at[b]
    gaps = np.maximum(left.min(axis=0) - right.max(axis=0), right.min(axis=0) - left.max(axis=0))
    if np.square(np.maximum(gaps, 0.0), dtype=np.float64).sum() > eps * eps + 1e-5:
        return
    if max(len(left), len(right)) <= leaf:
        yield a, b
        return
    halves = []
    for part in (a, b):
        size = part.stop - part.start
        middle = part.start + size // 2
        halves.append(
            [part] if size <= leaf else [slice(part.start, middle), slice(middle, part.stop)]
        )
    for first in halves[0]:
        for second in halves[1]:
            if one is not two or first.start <= second.start:
                yield from _join_intervals(one, two, first, second, eps, leaf)


def _compare(
    one: _Side, two: _Side, a: slice, b: slice, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Places of the vectors that may be linked, and which pairs of them are."""
    maybe = one.at[a] @ two.at[b].T >= np.float32(threshold - 1e-4)
    if one is two and a == b:
        np.fill_diagonal(maybe, False)
    if not maybe.any():
        return None
    left = np.flatnonzero(maybe.any(axis=1)) + a.start
    right = np.flatnonzero(maybe.any(axis=0)) + b.start
    products = one.given[left] @ two.given[right].T
    linked = products / (one.norms[left][:, None] * two.norms[right][None, :]) >= threshold
    if one is two:
        linked &= left[:, None] != right[None, :]
    return (left, right, linked) if linked.any() else None


def _links(near: DataFrame, blocks: DataFrame, axes: np.ndarray, threshold: float, grid: Grid) -> DataFrame:
    """Rows with numbers of links, and links (row, other) that connect all that are connected."""
    shared = blocks.sparkSession.sparkContext.broadcast(axes)  # a square of the vector length
    eps = float(np.sqrt(2.0 - 2.0 * threshold))

    def join(key: tuple, table: pa.Table) -> pa.Table:
        over, under = (k.as_py() for k in key)
        sides = {
            block: _Side(rows, given, shared.value)
            for block, rows, given in zip(
                *(table[name].to_pylist() for name in ("block", "rows", "given")), strict=True
            )
        }
        counts: dict[int, int] = {}
        edges: set[tuple[int, int]] = set()
        for x in sorted(k for k in sides if k >> _BITS == over):
            for y in sorted(k for k in sides if k >> _BITS == under and k >= x):
                one, two = sides[x], sides[y]
                whole = slice(0, len(one.rows)), slice(0, len(two.rows))
                for a, b in _join_intervals(one, two, *whole, eps, grid.leaf):
                    found = _compare(one, two, a, b, threshold)
                    if found is None:
                        continue
                    left, right, linked = found
                    own = one is two and a == b  # each pair is in there twice
                    for rows, numbers in (
                        (one.rows[left], linked.sum(axis=1)),
                        (two.rows[right], linked.sum(axis=0) * (not own)),
                    ):
                        for row, number in zip(rows.tolist(), numbers.tolist(), strict=True):
                            if number:
                                counts[row] = counts.get(row, 0) + number
                    row_label, column_label = _spanning(linked)
                    names = one.rows[left]
                    for rows, labels, there in (
                        (names, row_label, linked.any(axis=1)),
                        (two.rows[right], column_label, linked.any(axis=0)),
                    ):
                        edges.update(
                            zip(rows[there].tolist(), names[labels[there]].tolist(), strict=True)
                        )
        edges = {edge for edge in edges if edge[0] != edge[1]}
        return pa.table(
            {
                "row": pa.array([*counts, *(a for a, _ in edges)], pa.int64()),
                "links": pa.array([*counts.values(), *(0 for _ in edges)], pa.int64()),
                "other": pa.array([*(None for _ in counts), *(b for _, b in edges)], pa.int64()),
            }
        )

    over, under = F.shiftright("a", _BITS).alias("over"), F.shiftright("b", _BITS).alias("under")
    asked = (
        near.select(over, under, F.explode(F.array("a", "b")).alias("block"))
        .distinct()
        .join(blocks.select("block", "rows", "given"), "block")
    )
    return keep(
        asked.groupBy("over", "under").applyInArrow(join, "row long, links long, other long"),
        "found",
    )


def _links_of_length(good: DataFrame, length: int, threshold: float, grid: Grid) -> DataFrame:
    """The links among vectors of one length."""
    axes = _principal_axes(V.bounded_sample(good, "row", "vector", grid.sample, length))
    eps = float(np.sqrt(2.0 - 2.0 * threshold))
    n_parts = good.count() // grid.spread + 1
    blocks = _blocks(good, axes, eps, grid, n_parts)
    bits = max(1, int(blocks.agg(F.max("nth")).first()[0]).bit_length())
    blocks = blocks.withColumn("block", F.shiftleft("part", bits) + F.col("nth"))
    near = _near_blocks(blocks, eps, min(grid.boxed, length))
    return _links(near, blocks, axes, threshold, grid)


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.9,
    id: str = "vec_id",
    vector: str = "embedding",
    grid: Grid | None = None,
) -> DataFrame:
    """``df`` with n_links, component_id and kept in place of the vectors."""
    grid = grid or Grid()
    output = ("n_links", "component_id", "kept")
    others = [c for c in df.columns if c != vector and c.lower() not in output]
    row = fresh([*others, vector], "_row")
    base = keep(df.select(*others, vector, F.monotonically_increasing_id().alias(row)), "vectors")
    good = base.where(V.takes_part(F.col(vector))).select(
        F.col(row).alias("row"), F.col(vector).alias("vector")
    )
    plain = base.select(*others, row)
    every_length = V.lengths(good, "vector")
    if not every_length:
        return plain.select(
            *others,
            F.lit(0).cast("long").alias("n_links"),
            F.col(id).cast("long").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    found = functools.reduce(
        DataFrame.unionByName,
        (
            _links_of_length(good.where(F.size("vector") == length), length, threshold, grid)
            for length in every_length
        ),
    )

    counts = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    pairs = found.where("other is not null").select(F.col("row").alias("a"), F.col("other").alias("b"))
    reached = keep(components(pairs), "components")
    named = plain.select(F.col(row).alias("node"), F.col(id).alias("_id")).join(reached, "node")
    names = named.groupBy("root").agg(F.min("_id").alias("component_id"))
    linked = reached.join(names, "root").select(F.col("node").alias("row"), "component_id")
    linked = linked.join(counts, "row").withColumnRenamed("row", row)
    name = F.when(F.col("n_links").isNull(), F.col(id)).otherwise(F.col("component_id"))
    return plain.join(linked, row, "left").select(
        *others,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        name.cast("long").alias("component_id"),
        name.eqNullSafe(F.col(id)).alias("kept"),
    )
