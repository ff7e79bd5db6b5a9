"""Ranked lexical search: the exact best documents of each query, from sparse ball trees.

1. Texts are read once per block of queries: a document becomes the numbers of its terms that
   any of the block's queries has. The counts N, L and df are aggregated over all documents, which
   gives integer weights and impacts.
2. Documents are sorted over all tasks by the group of terms that weighs most in them and by their
   weightiest term, and cut into blocks of bounded size as they come; each is built into a ball
   tree (``ball_tree``) and written. Every document is in a tree.
3. Best-first over the trees: the bounds at the roots tell the most promising tree of each query; it
   is searched first, and its k-th score is a floor for all others. Then every tree is searched
   with these floors, and the tasks' best are ranked. Scores are exact integers at the leaves.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sendgate.llm import ball_tree as B
from sendgate.session import keep

GROUPS = 64
BLOCK_DOCS = 2048
BLOCK_ENTRIES = 500_000
# Bounds of one block of queries, which is held by every task; a single larger query is one.
QUERIES = 5_000
QUERY_TERMS = 500_000
_PIECE = 1 << 20

# What is no part of a term, by byte; letters A-Z are lower-cased.
_OUTSIDE = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(bytes(range(256)).lower())
for _byte in _OUTSIDE:
    _TABLE[_byte] = 0x20
_TABLE = bytes(_TABLE)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time, with empty ones among them."""
    held = b""
    for at in range(0, len(text), _PIECE):
        parts = text[at : at + _PIECE].translate(_TABLE).split(b" ")
        if len(parts) == 1:
            held += parts[0]
            continue
        parts[0] = held + parts[0]
        held = parts.pop()
        yield parts
    yield [held]


def _counted(text: bytes) -> tuple[int, Counter]:
    counts: Counter = Counter()
    for terms in terms_of(text):
        counts.update(terms)
    counts.pop(b"", None)
    return counts.total(), counts


def _asked(queries: DataFrame, item: str) -> DataFrame:
    """A row per query row and term: q, item, term and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, bytes, int]] = []
            for q, text in zip(batch["q"].to_pylist(), batch["text"].cast(pa.large_binary()).to_pylist()):
                out += [(q, term, times) for term, times in _counted(text or b"")[1].items()]
            columns = list(zip(*out)) if out else ((), (), ())
            kinds = (pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["q", "term", "times"]
            )

    return queries.select("q", "text").mapInArrow(run, "q long, term binary, times long")


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with any term: its length, and numbers and counts of the terms asked for."""
    asked = vocabulary.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.large_binary())):
                n, terms = _counted(text.as_py() or b"")
                if n:
                    mine = sorted((vocabulary[term], terms[term]) for term in asked & terms.keys())
                    ids.append(doc)
                    lengths.append(n)
                    found.append([t for t, _ in mine])
                    counts.append([c for _, c in mine])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def _weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists without nulls, and the bounds of each list."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _placed(vectors: DataFrame, documents: int, words: int, space: B.Space) -> DataFrame:
    """Impacts in place of counts, and where each document lies among the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            terms, bounds = _lists(batch["terms"])
            counts, _ = _lists(batch["counts"])
            # Python's integers, as 25 * n * N may not fit into 64 bits.
            spans = np.array(
                [75 + 25 * length * documents // words for length in batch["n"].to_pylist()], np.int64
            )
            owner = np.repeat(np.arange(n), np.diff(bounds))
            impacts = 1_000_000_000 * counts // (1000 * counts + 12 * spans[owner])
            mass = impacts.astype(np.float64) * space.weights[terms]
            of = owner * space.groups + space.group[terms]
            near = np.bincount(of, mass, n * space.groups).reshape(n, space.groups).argmax(axis=1)
            top = np.full(n, -1, np.int64)
            # Of each document the term of most mass: the last one in this order.
            order = np.lexsort((terms, mass, owner))
            top[owner[order]] = terms[order]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(near, pa.int32()),
                    pa.array(top, pa.int64()),
                    batch["terms"],
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(impacts, pa.int64())),
                ],
                ["doc_id", "near", "top", "terms", "impacts"],
            )

    schema = "doc_id long, near int, top long, terms array<int>, impacts array<long>"
    return vectors.where("size(terms) > 0").mapInArrow(run, schema)


_TREE = {
    "rows": pa.int32(), "bounds": pa.int32(), "terms": pa.int32(), "impacts": pa.int64(),
    "first": pa.int32(), "last": pa.int32(), "child": pa.int32(), "radii": pa.float64(),
    "c_terms": pa.int32(), "c_bounds": pa.int32(), "c_nodes": pa.int32(), "c_values": pa.float64(),
}
_NAMES = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double"}
_TREE_SQL = ", ".join(f"{name} array<{_NAMES[kind]}>" for name, kind in _TREE.items())


def _trees(placed: DataFrame, space: B.Space) -> DataFrame:
    """A row per block: a tree, and its root apart, which the first round reads alone."""

    def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        terms, bounds = _lists(table["terms"].chunk(0))
        impacts, _ = _lists(table["impacts"].chunk(0))
        tree = B.build(bounds.astype(np.int64), terms.astype(np.int64), impacts, space)
        at_root = tree.c_nodes == 0
        columns = {"ids": pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64()))}
        columns["root_terms"] = pa.array(
            [np.repeat(tree.c_terms, np.diff(tree.c_bounds))[at_root]], pa.list_(pa.int32())
        )
        columns["root_values"] = pa.array([tree.c_values[at_root]], pa.list_(pa.float64()))
        columns["root_radii"] = pa.array([tree.radii[0]], pa.list_(pa.float64()))
        for name, kind in _TREE.items():
            columns[name] = pa.array([getattr(tree, name).ravel()], pa.list_(kind))
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        docs = entries = 0
        for batch in batches:
            lengths = np.diff(batch["terms"].offsets.to_numpy())
            start = 0
            for i, length in enumerate(lengths.tolist()):
                if docs and (docs == BLOCK_DOCS or entries + length > BLOCK_ENTRIES):
                    held.append(batch.slice(start, i - start))
                    yield row(held)
                    held, start, docs, entries = [], i, 0, 0
                docs += 1
                entries += length
            held.append(batch.slice(start))
        if docs:
            yield row(held)

    schema = "ids array<long>, root_terms array<int>, root_values array<double>, root_radii array<double>, "
    trees = placed.mapInArrow(run, schema + _TREE_SQL)
    return trees.withColumn("block", F.monotonically_increasing_id())


def _seeds(trees: DataFrame, queries: B.Queries, space: B.Space) -> DataFrame:
    """For each query the tree with the largest bound at its root: q, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, of = np.full(len(queries), -1.0), np.zeros(len(queries), np.int64)
            columns = (batch[c].to_pylist() for c in ("block", "root_terms", "root_values", "root_radii"))
            for block, terms, values, radii in zip(*columns, strict=True):
                center = np.zeros(len(space.weights))
                center[np.array(terms, np.int64)] = values
                owner = np.repeat(np.arange(len(queries)), np.diff(queries.bounds))
                scaled = queries.times * space.roots[queries.terms]
                parts = np.bincount(owner, scaled * center[queries.terms], len(queries))
                where = owner * space.groups + space.group[queries.terms]
                norms = np.bincount(where, scaled * scaled, len(queries) * space.groups)
                bounds = parts + np.sqrt(norms.reshape(-1, space.groups)) @ np.array(radii)
                of[bounds > best] = block
                best = np.maximum(best, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(queries))), pa.array(of), pa.array(best)], ["q", "block", "bound"]
            )

    roots = trees.select("block", "root_terms", "root_values", "root_radii")
    bounds = roots.mapInArrow(run, "q long, block long, bound double")
    return bounds.groupBy("q").agg(F.max(F.struct("bound", "block"))["block"].alias("block"))


def _hits(
    trees: DataFrame,
    queries: B.Queries,
    space: B.Space,
    k: int,
    floors: np.ndarray,
    only: dict[int, list[int]] | None = None,
) -> DataFrame:
    """The best k hits of each task's trees; with ``only``, each tree is searched for its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [B.Best(k, int(floor)) for floor in floors]
        dense = np.zeros(len(space.weights), np.int64)
        asked = [queries.of(i) for i in range(len(queries))]
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch["block"][i].as_py()
                parts = {name: batch[name][i].values.to_numpy(zero_copy_only=False) for name in _TREE}
                parts["radii"] = parts["radii"].reshape(-1, space.groups)
                tree = B.Tree(**{n: v.astype(np.int64) if v.dtype == np.int32 else v for n, v in parts.items()})
                ids = batch["ids"][i].as_py()
                for q in range(len(queries)) if only is None else only[block]:
                    B.search(tree, ids, *asked[q], space, dense, best[q])
        rows = [(q, doc, score) for q, b in enumerate(best) for doc, score in b.rows()]
        columns = list(zip(*rows)) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["q", "doc_id", "score"]
        )

    return trees.mapInArrow(run, "q long, doc_id long, score long")


def _search_block(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best k documents of each query of one block: q, doc_id, score, rank."""
    rows = asked.collect()
    numbers = {q: i for i, q in enumerate(sorted({r.q for r in rows}))}
    vocabulary = {term: i for i, term in enumerate(sorted({bytes(r.term) for r in rows}))}
    rows = sorted((numbers[r.q], vocabulary[bytes(r.term)], r.times) for r in rows)

    vectors = keep(_vectors(docs, vocabulary), "vectors")
    documents, words = vectors.agg(F.count("*"), F.sum("n")).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in held:
        weights[term] = _weight(documents, df)

    owner, terms, times = (np.array(c, np.int64) for c in zip(*rows))
    bounds = np.searchsorted(owner, np.arange(len(numbers) + 1))
    queries = B.Queries(bounds, terms, times)
    group = B.term_groups(queries, weights, GROUPS)
    space = B.Space(weights, group, int(group.max(initial=0)) + 1)

    spark = docs.sparkSession
    parts = max(documents // (8 * BLOCK_DOCS) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = _placed(vectors, documents, words or 1, space)
    # Copies of one text are told apart by the hash, so they spread over as many blocks as they need.
    sort = ["near", "top", F.xxhash64("doc_id", "impacts")]
    sorted_ = placed.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    trees = keep(_trees(sorted_, space), "trees")

    floors = np.ones(len(queries), np.int64)
    only: dict[int, list[int]] = {}
    for row in _seeds(trees, queries, space).collect():
        only.setdefault(row.block, []).append(row.q)
    if only:
        few = trees.where(F.col("block").isin(list(only)))
        best: dict[int, list[int]] = {}
        for row in _hits(few, queries, space, k, floors, only).collect():
            best.setdefault(row.q, []).append(row.score)
        for q, scores in best.items():
            if len(scores) >= k:
                floors[q] = sorted(scores, reverse=True)[k - 1]
    hits = keep(_hits(trees, queries, space, k, floors), "hits")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, q) for q, i in numbers.items()], "q long, asked long")
    return ranked.join(F.broadcast(names), "q").select(F.col("asked").alias("q"), "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = 20, item: str = "item_id") -> DataFrame:
    """The ``k`` best documents of every query: the query's ``item``, rank, doc_id, score.

    ``docs`` has doc_id (bigint) and text, ``queries`` has ``item`` and text; other columns are not
    looked at. Terms are the longest runs of ASCII letters and digits and of all other characters
    beyond ASCII, with A-Z lower-cased. A term weighs floor(1000 ln((2N+2) / (2df+1))); the score
    sums weight * ((10^9 tf) div (1000 tf + 12 m)) over the query's terms, repeats included, where
    m = 75 + (25 n N) div L. Only scores above 0 are hits; equal ones go by doc_id, null first.

    Each row of ``queries`` is a query of its own, also where items repeat; each row of ``docs`` is
    a document, also where ids or texts repeat. A null or empty text has no terms: such a document
    is not counted, such a query has no hits. Texts are read whole.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    queries = keep(queries.select(F.col(item).alias("_item"), "text"), "queries")
    queries = keep(queries.withColumn("q", F.monotonically_increasing_id()), "queries")
    asked = keep(_asked(queries, item), "asked")
    found = None
    for block in _blocks(asked):
        ranked = _search_block(docs, block, k)
        found = ranked if found is None else found.unionByName(ranked)
    names = queries.select("q", F.col("_item").alias(item))
    if found is None:
        return names.limit(0).select(
            item, F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    return found.join(names, "q").select(item, "rank", "doc_id", "score")


def _blocks(asked: DataFrame) -> Iterator[DataFrame]:
    """Blocks of whole queries with bounded numbers of queries and terms; each reads the texts once."""
    sizes = asked.groupBy("q").agg(F.count("*").alias("n"))
    rows, terms = sizes.agg(F.count("*"), F.sum("n")).first()
    parts = max(-(-rows // QUERIES), -(-(terms or 0) // QUERY_TERMS))
    for part in range(parts):
        block = asked.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == part)
        if parts == 1 or not block.isEmpty():
            yield block
