"""Approximate nearest neighbours: inverted lists with an adaptive scan of dimensions.

Largest inner products are least distances once every vector has one more dimension that fills
its length up to the longest one's (zero for queries). Centroids are fitted on a bounded sample
and every vector is put on the list of its nearest centroid. A query probes the nearest share of
the lists. Vectors are rotated at random and held in column blocks: after each block, the
partial distance of a candidate, scaled up, estimates the whole one, and a hypothesis test
abandons the candidate if it is too far beyond the distance that has to be beaten. That distance
comes from a first round over each query's nearest list; a second round covers the other probes.
What is left is ranked by the inner product of the given vectors in double precision.

Lists are cut into chunks of a bounded number of vectors, and the queries of a list into chunks
too, so that neither a large list nor many queries meet in one task.

Defined results:

* Vectors that are null, zero or hold null or non-finite components take no part, neither as
  queries nor as candidates. Vectors of different lengths have no inner product: each length is
  a search of its own, with an index of its own.
* The scan is scaled by the largest component, so finite vectors of any size take part. A score
  beyond the range of a double is infinite, and ties.
* A query is never its own neighbour; other rows with its id or its vector are candidates.
* With fewer candidates than asked for, all are returned. An empty table has no result.
* Ties go to the smaller id. Rows without an id are no queries, and candidates with a null id.
* Other columns than id and vector are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sendgate.llm import vectors as V
from sendgate.session import keep


@dataclass(frozen=True)
class Index:
    sample: int = 20_000  # vectors that the centroids are fitted on, at most
    lists: int = 4_096  # lists, at most; else the square root of the number of vectors
    rounds: int = 8  # of fitting the centroids
    share: float = 0.7  # of the lists that a query probes
    least: int = 256  # candidates on the probed lists, at least
    columns: int = 16  # dimensions in a column block
    doubt: float = 2.1  # how far beyond the bound an estimate may be; larger keeps more
    chunk: int = 2_048  # vectors of a list in one task
    queries: int = 4_096  # queries of a list in one task
    seed: int = 11


def _fit(sample: np.ndarray, n_lists: int, index: Index) -> np.ndarray:
    draw = np.random.default_rng(index.seed)
    centroids = sample[draw.choice(len(sample), min(n_lists, len(sample)), replace=False)]
    for _ in range(index.rounds):
        nearest = _nearest(sample, centroids)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=len(centroids))
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
    return centroids


def _nearest(rows: np.ndarray, centroids: np.ndarray, most: int = 1) -> np.ndarray:
    """Per row, the numbers of the nearest centroids, nearest first."""
    distances = np.square(centroids).sum(axis=1) - 2.0 * rows @ centroids.T
    if most == 1:
        return distances.argmin(axis=1)[:, None]
    return np.argsort(distances, axis=1, kind="stable")[:, :most]


def _longer(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the dimension that fills their squared length up to ``longest``."""
    rest = np.sqrt(np.maximum(longest - np.square(rows).sum(axis=1), 0.0))
    return np.column_stack([rows, rest])


@dataclass(frozen=True)
class _Space:
    """What tasks need: bounded by the number of lists and the square of the vector length."""

    length: int
    scale: float  # the largest component; all but the scores is in units of it
    longest: float
    centroids: np.ndarray
    rotation: np.ndarray


def _survivors(
    queries: np.ndarray, bounds: np.ndarray, candidates: np.ndarray, index: Index
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and candidate that no test abandons.

    ``bounds`` are squared distances to be beaten; rows are rotated and of full length.
    """
    total = queries.shape[1]
    partial = np.zeros((len(queries), len(candidates)), np.float32)
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    held = np.zeros(0, np.float32)
    for start in range(0, total, index.columns):
        part = slice(start, min(total, start + index.columns))
        q, c = queries[:, part], candidates[:, part]
        seen = part.stop
        # The estimate is the scaled partial distance; at the end it is the distance itself.
        slack = 1.0 if seen == total else (1.0 + index.doubt / np.sqrt(seen)) ** 2
        limits = (bounds * slack * seen / total * (1 + 1e-5) + 1e-9).astype(np.float32)
        if pairs is None:
            partial += np.square(q).sum(axis=1)[:, None]
            partial += np.square(c).sum(axis=1)[None, :]
            partial -= 2.0 * (q @ c.T)
            near = partial <= limits[:, None]
            if seen == total or near.mean() < 0.1:
                pairs = np.nonzero(near)
                held = partial[pairs]
        else:
            held = held + np.square(q[pairs[0]] - c[pairs[1]]).sum(axis=1)
            near = held <= limits[pairs[0]]
            pairs, held = (pairs[0][near], pairs[1][near]), held[near]
    assert pairs is not None
    return pairs


def _best(
    query: np.ndarray,
    other: np.ndarray,
    score: np.ndarray,
    ids: tuple[np.ndarray, np.ndarray],
    k: int,
) -> np.ndarray:
    """Places of each query's k highest scores, ties to smaller ids; ids missing come last."""
    numbers, missing = ids
    order = np.lexsort((other, numbers, missing, -score, query))
    sorted_query = query[order]
    first = np.flatnonzero(np.concatenate(([True], np.diff(sorted_query) != 0)))
    sizes = np.diff(np.append(first, len(order)))
    place = np.arange(len(order)) - np.repeat(first, sizes)
    return order[place < k]


def _searcher(space: Callable[[], _Space], index: Index, k: int):
    """The function that searches one chunk of a list for one chunk of queries."""

    def search(asking: pa.Table, vectors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        if asking.num_rows and vectors.num_rows:
            s = space()
            given = V.matrix(vectors["vector"], s.length)
            rows = vectors["row"].to_numpy()
            ids = pc.fill_null(vectors["id"], 0).to_numpy()
            missing = pc.is_null(vectors["id"]).to_numpy()
            candidates = (_longer(given / s.scale, s.longest) @ s.rotation).astype(np.float32)
            # So many queries at a time that their distances take some 16 MB.
            step = max(1, (4 << 20) // len(rows))
            for first in range(0, asking.num_rows, step):
                part = asking.slice(first, step)
                q = V.matrix(part["vector"], s.length)
                q_rows = part["row"].to_numpy()
                worst = part["worst"].to_pandas().fillna(-np.inf).to_numpy(float)
                # |q - x|^2 = longest + |q|^2 - 2 <q, x>
                scaled = q / s.scale
                bounds = s.longest + np.square(scaled).sum(axis=1) - 2.0 * (worst / s.scale / s.scale)
                bounds[~np.isfinite(worst)] = np.inf
                rotated = np.column_stack([scaled, np.zeros(len(q))]) @ s.rotation
                rotated = rotated.astype(np.float32)
                one, two = _survivors(rotated, bounds, candidates, index)
                other = q_rows[one] != rows[two]
                one, two = one[other], two[other]
                score = np.empty(len(one))
                for at in range(0, len(one), 1 << 15):
                    some = slice(at, at + (1 << 15))
                    score[some] = np.einsum("ij,ij->i", q[one[some]], given[two[some]])
                if len(one):
                    best = _best(q_rows[one], rows[two], score, (ids[two], missing[two]), k)
                    found.append([q_rows[one[best]], two[best], score[best]])
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else None
        if columns is None:
            empty = {"query": pa.int64(), "row": pa.int64(), "id": pa.int64(), "score": pa.float64()}
            return pa.table({name: pa.array([], kind) for name, kind in empty.items()})
        query, place, score = columns
        return pa.table(
            {
                "query": query,
                "row": rows[place],
                "id": vectors["id"].take(pa.array(place)),
                "score": score,
            }
        )

    return search


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    index: Index | None = None,
) -> DataFrame:
    """Per row of ``df`` that ``queries`` holds for, its k nearest other rows that are found.

    The columns are query_id, rank (from 1), ``id`` and score, the inner product.
    """
    index = index or Index()
    kind = df.schema[vector].dataType.simpleString()
    good = df.where(V.takes_part(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("long").alias("id"),
        F.col(vector).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    good = keep(good, "vectors")
    result = df.sparkSession.createDataFrame(
        [], f"query_id long, rank int, {id} long, score double"
    )
    parts = [
        _nearest_of_length(good.where(F.size("vector") == length), length, kind, k, id, index)
        for length in V.lengths(good, "vector")
    ]
    parts = [part for part in parts if part is not None]
    return functools.reduce(DataFrame.unionByName, parts) if parts else result


def _nearest_of_length(
    good: DataFrame, length: int, kind: str, k: int, id: str, index: Index
) -> DataFrame | None:
    """The search among vectors of one length; nothing if none of them asks."""
    numbers = good.agg(
        F.count("*").alias("n"),
        F.max(F.array_max(F.transform("vector", F.abs))).cast("double").alias("scale"),
        F.count_if("asks").alias("asking"),
    ).first()
    if not numbers["asking"]:
        return None
    scale = float(numbers["scale"])
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale))
    longest = float(good.agg(F.max(squares)).first()[0])
    n_lists = max(1, min(index.lists, int(numbers["n"] ** 0.5)))
    sample = V.bounded_sample(good, "row", "vector", index.sample, length) / scale
    centroids = _fit(_longer(sample, longest), n_lists, index)
    rotation, _ = np.linalg.qr(
        np.random.default_rng(index.seed).normal(size=(length + 1, length + 1))
    )
    context = good.sparkSession.sparkContext
    shared = context.broadcast(_Space(length, scale, longest, centroids, rotation))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                rows = _longer(V.matrix(batch["vector"], length) / scale, longest)
                nearest = _nearest(rows, shared.value.centroids)[:, 0].astype(np.int64)
                columns = [batch["row"], batch["id"], batch["vector"], pa.array(nearest)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "vector", "list"])

    listed = keep(
        good.select("row", "id", "vector").mapInArrow(
            assign, f"row long, id long, vector {kind}, list long"
        ),
        "lists",
    )
    # A number per list.
    sizes = np.zeros(len(centroids), np.int64)
    for one in listed.groupBy("list").agg(F.count("*").alias("n")).collect():
        sizes[one["list"]] = one["n"]
    sized = context.broadcast(sizes)
    probes = max(1, int(np.ceil(index.share * len(centroids))))

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = V.matrix(batch["vector"], length) / scale
            rows = np.column_stack([rows, np.zeros(len(rows))])
            order = _nearest(rows, shared.value.centroids, len(shared.value.centroids))
            order = order.reshape(len(rows), -1)
            held = np.cumsum(sized.value[order], axis=1)
            # The share of the lists, and as many more as it takes to have enough candidates.
            enough = np.maximum(probes, (held < index.least).sum(axis=1) + 1)
            enough = np.minimum(enough, order.shape[1])
            place = np.arange(order.shape[1])[None, :]
            first = place <= (held < k + 1).sum(axis=1)[:, None]
            probed = place < enough[:, None]
            ends = np.concatenate(([0], np.cumsum(enough))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(order[probed].astype(np.int64)))
            n_first = pa.array((first & probed).sum(axis=1).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], lists, n_first], ["row", "lists", "n_first"]
            )

    asking = good.where("asks and id is not null").select("row", "id", "vector")
    asked = keep(
        asking.select("row", "vector").mapInArrow(probe, "row long, lists array<long>, n_first long"),
        "probes",
    )
    to = asked.select("row", "n_first", F.posexplode("lists").alias("nth", "list"))
    query_chunks = -(-int(numbers["asking"]) // index.queries)
    n_chunks = F.lit([max(1, -(-int(n) // index.chunk)) for n in sizes])
    chunks = F.get(n_chunks, F.col("list").cast("int")).cast("long")
    vectors = listed.select(
        "*",
        F.pmod(F.xxhash64("row"), chunks).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(query_chunks - 1))).alias("queries"),
    )
    search = _searcher(lambda: shared.value, index, k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")

    def scan(probing: DataFrame) -> DataFrame:
        probing = probing.select(
            "list",
            F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"),
            F.pmod(F.xxhash64("row"), F.lit(query_chunks)).cast("int").alias("queries"),
            "row",
            "vector",
            "worst",
        )
        keys = ("list", "chunk", "queries")
        return (
            probing.groupBy(*keys)
            .cogroup(vectors.groupBy(*keys))
            .applyInArrow(search, "query long, row long, id long, score double")
        )

    def first_k(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    whole = asking.select("row", "vector")
    none = F.lit(None).cast("double").alias("worst")
    near = to.where("nth < n_first").join(whole, "row").select("list", "row", "vector", none)
    first = keep(first_k(scan(near)), "first")
    worst = first.where(F.col("rank") == k).select(
        F.col("query").alias("row"), F.col("score").alias("worst")
    )
    far = to.where("nth >= n_first").join(whole.join(worst, "row", "left"), "row")
    second = scan(far.select("list", "row", "vector", "worst"))
    found = first_k(first.drop("rank").unionByName(second))
    names = asking.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return found.join(names, "query").select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score"
    )
