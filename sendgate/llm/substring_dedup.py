"""Substring dedup by seed and extend: winnowed anchors are joined, matches extended around them.

A repeat is a run of at least ``length`` words that also stands in a document with a smaller id.

1. Seeds. Of every ``length - SEED + 1`` runs of ``SEED`` words in a row, the one with the least
   hash is an anchor. So each window of ``length`` words holds an anchor that its words alone
   decide, and two equal windows hold the same one. Anchors are joined over all documents.
2. Extension. Only windows around anchors that stand in two texts can be equal to others. From
   each such anchor the windows that chose it are followed to the left and to the right, and
   compared with the ones that other documents have there: what counts is the smallest id of a
   document with an equal window.
3. Windows that a smaller document has are joined where they touch: maximal repeats, which are cut.

How the data move. Documents are read in chunks of ``CHUNK`` rows. A chunk asks about its anchors,
and in a second round about its windows, once each, packed into one binary value per hash bucket;
buckets are grouped, and their answers go back to the chunk that asked, where its documents
meet them in one sorted stream. A hot passage is in a bucket once per chunk, not once per
document, and no pairs of documents are made. Texts are shuffled twice, hashes are never stored.
Texts that are whole copies of one of a smaller id are settled beforehand and ask nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sendgate.llm import word_hashes as W
from sendgate.llm.shingles import in_chunks
from sendgate.session import is_small, keep

SEED = 5  # words of an anchor
CHUNK = 256  # rows that ask together
BUCKET_BYTES = 64 << 20  # of text per hash bucket
# Numbers of copied rows are broadcast up to this many; beyond it, copies ask for seeds, too.
BROADCAST_COPIES = 1_000_000

_ASKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("pack", pa.binary())])
_ASKED_SQL = "bucket int, chunk long, pack binary"
_ANSWER_SQL = "chunk long, pack binary"
_WINDOW = np.dtype([("one", "<u8"), ("two", "<u4"), ("doc", "<i8"), ("more", "?")])
_LEAST = np.dtype([("one", "<u8"), ("two", "<u4"), ("doc", "<i8")])
_ANSWER, _COPIES, _DOCUMENT = 0, 1, 2


class _Words:
    """The words of a slice of texts, their anchors and windows."""

    def __init__(self, texts: pa.Array, length: int):
        self.length = length
        raw, bounds = W.text_bytes(texts)
        begin, end, self.owner = W.word_spans(raw, bounds)
        self.hashes = W.word_hashes(raw, begin, end)
        whole = np.flatnonzero(self.owner[: max(len(self.owner) - length + 1, 0)] == self.owner[length - 1 :])
        self.starts = whole  # first words of the windows inside one text
        self.of = self.owner[whole]

    def anchors(self, seed: int) -> np.ndarray:
        """The hash of the anchor of every window."""
        runs = W.run_hashes(self.hashes, seed)
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        in_window = np.lib.stride_tricks.sliding_window_view(runs, self.length - seed + 1)
        return in_window.min(axis=1)[self.starts]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for every window."""
        one = W.run_hashes(self.hashes, self.length, 1)[self.starts]
        two = W.run_hashes(self.hashes, self.length, 2)[self.starts]
        return one, (two >> np.uint64(32)).astype(np.uint32)


def _packs(chunk: int, buckets: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """``rows`` by bucket, packed column by column if they have several."""
    order = np.argsort(buckets, kind="stable")
    buckets, rows = buckets[order], rows[order]
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for bucket, part in zip(buckets[np.concatenate(([0], cuts))].tolist(), np.split(rows, cuts)):
        yield bucket, chunk, _pack(part)


def _pack(rows: np.ndarray) -> bytes:
    if rows.dtype.names is None:
        return rows.astype("<u8").tobytes()
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def _unpack(pack: bytes, kind: np.dtype) -> np.ndarray:
    if kind.names is None:
        return np.frombuffer(pack, kind)
    rows = np.empty(len(pack) // kind.itemsize, kind)
    at = 0
    for name in kind.names:
        rows[name] = np.frombuffer(pack, kind[name], len(rows), at)
        at += len(rows) * kind[name].itemsize
    return rows


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)


def _asked(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)] if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ASKED)], schema=_ASKED)


def _ask_for_seeds(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """The anchors of every chunk, twice what two of its documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []

        def flush() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            held.clear()
            third = np.zeros(len(found), bool)
            third[2:] = found[2:] == found[:-2]
            found = found[~third]
            return _asked(list(_packs(chunk, _bucket(found, buckets), found)) if len(found) else [])

        for batch in batches:
            for part in _cut(batch, "row"):
                at = part["row"][0].as_py() // CHUNK
                if at != chunk:
                    if chunk is not None:
                        yield flush()
                    chunk = at
                words = _Words(part["text"], length)
                anchors = words.anchors(SEED)
                order = np.lexsort((anchors, words.of))
                anchors, of = anchors[order], words.of[order]
                new = np.ones(len(order), bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])
                held.append(anchors[new])
        if chunk is not None:
            yield flush()

    return docs.mapInArrow(run, _ASKED_SQL)


def _cut(batch: pa.RecordBatch, row: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch inside one chunk, of bounded bytes or one text."""
    chunks = batch[row].to_numpy() // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield from in_chunks(iter([batch.slice(first, last - first)]), "text")


def _by_chunk(chunks: np.ndarray, rows: np.ndarray) -> pa.Table:
    order = np.argsort(chunks, kind="stable")
    chunks, rows = chunks[order], rows[order]
    cuts = np.flatnonzero(np.diff(chunks)) + 1
    firsts = chunks[np.concatenate(([0], cuts))] if len(chunks) else chunks
    packs = [_pack(part) for part in np.split(rows, cuts)] if len(chunks) else []
    return pa.table({"chunk": pa.array(firsts, pa.int64()), "pack": pa.array(packs, pa.binary())})


def _gathered(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all packs and the numbers of their chunks."""
    packs = [_unpack(pack, kind) for pack in table["pack"].to_pylist()]
    chunks = np.repeat(table["chunk"].to_numpy(), [len(p) for p in packs])
    return chunks, np.concatenate(packs)


def _answer_seeds(asked: DataFrame) -> DataFrame:
    """To every chunk, those of its anchors that two texts have."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        chunks, anchors = _gathered(table, np.dtype("<u8"))
        order = np.argsort(anchors, kind="stable")
        chunks, anchors = chunks[order], anchors[order]
        same = anchors[1:] == anchors[:-1]
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        again = np.concatenate(([False], same & (chunks[1:] == chunks[:-1])))
        shared &= ~again
        return _by_chunk(chunks[shared], anchors[shared])

    return asked.groupBy("bucket").applyInArrow(answer, _ANSWER_SQL)


def _answer_windows(asked: DataFrame) -> DataFrame:
    """To every chunk, the least document of each of its windows if one of its documents is larger."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        chunks, rows = _gathered(table, _WINDOW)
        order = np.lexsort((rows["doc"], rows["two"], rows["one"]))
        chunks, rows = chunks[order], rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["one"][1:] != rows["one"][:-1]) | (rows["two"][1:] != rows["two"][:-1])
        least = rows["doc"][new][np.cumsum(new) - 1]
        told = (least < rows["doc"]) | rows["more"]
        answers = np.empty(int(told.sum()), _LEAST)
        answers["one"], answers["two"], answers["doc"] = rows["one"][told], rows["two"][told], least[told]
        return _by_chunk(chunks[told], answers)

    return asked.groupBy("bucket").applyInArrow(answer, _ANSWER_SQL)


def _meet(docs: DataFrame, copies: DataFrame, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Answers, copies and documents of every chunk behind one another in one task."""
    none = {name: F.lit(None).cast(kind) for name, kind in docs.select(*columns).dtypes}

    def control(rows: DataFrame, kind: int) -> DataFrame:
        first = F.lit(-1).cast("long").alias("row")
        empty = [none[c].alias(c) for c in columns if c != "row"]
        return rows.select("chunk", F.lit(kind).alias("kind"), first, *empty, "pack")

    told = control(answers, _ANSWER).unionByName(control(copies, _COPIES))
    rows = docs.select(
        F.floor(F.col("row") / CHUNK).cast("long").alias("chunk"),
        F.lit(_DOCUMENT).alias("kind"),
        *columns,
        F.lit(None).cast("binary").alias("pack"),
    )
    return told.unionByName(rows).repartition("chunk").sortWithinPartitions("chunk", "kind", "row")


def _chunks_of(
    batches: Iterator[pa.RecordBatch], kind: np.dtype
) -> Iterator[tuple[int, np.ndarray, set[int], pa.RecordBatch]]:
    """Slices of documents of one chunk, with its answers and its copied rows."""
    chunk, answers, copies, held = None, None, set(), []
    for batch in batches:
        chunks, kinds = batch["chunk"].to_numpy(), batch["kind"].to_numpy()
        new = (np.diff(chunks) != 0) | (np.diff(kinds) != 0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            if last <= first:
                continue
            part = batch.slice(first, last - first)
            if chunks[first] != chunk:
                chunk, answers, copies, held = int(chunks[first]), None, set(), []
            if kinds[first] == _ANSWER:
                held += [_unpack(pack, kind) for pack in part["pack"].to_pylist()]
            elif kinds[first] == _COPIES:
                for pack in part["pack"].to_pylist():
                    copies.update(np.frombuffer(pack, "<i8").tolist())
            else:
                if answers is None:
                    answers, held = np.sort(np.concatenate(held or [np.zeros(0, kind)])), []
                for slice_ in in_chunks(iter([part]), "text"):
                    yield chunk, answers, copies, slice_


def _among(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each number is in a sorted list."""
    if not len(known):
        return np.zeros(len(found), bool)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return known[at] == found


def _ask_for_windows(met: DataFrame, length: int, buckets: int) -> DataFrame:
    """The windows around shared anchors, with the least document of the chunk that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held) if held else np.zeros(0, _WINDOW)
            held.clear()
            rows = rows[np.lexsort((rows["doc"], rows["two"], rows["one"]))]
            same = (rows["one"][1:] == rows["one"][:-1]) & (rows["two"][1:] == rows["two"][:-1])
            new = np.concatenate(([True], ~same))[: len(rows)]
            group = np.cumsum(new) - 1
            firsts = rows[new]
            firsts["more"][group[rows["doc"] > firsts["doc"][group]]] = True
            if not len(firsts):
                return _asked([])
            return _asked(list(_packs(chunk, _bucket(firsts["one"], buckets), firsts)))

        for at, shared, copies, part in _chunks_of(batches, np.dtype("<u8")):
            if at != chunk:
                if held:
                    yield flush()
                chunk = at
            rows = part["row"].to_numpy()
            docs = part["doc_id"]
            out = docs.is_null().to_numpy(zero_copy_only=False)
            if copies:
                out = out | np.isin(rows, list(copies))
            if out.all() or not len(shared):
                continue
            words = _Words(part["text"], length)
            asks = _among(words.anchors(SEED), shared) & ~out[words.of]
            one, two = words.windows()
            found = np.zeros(int(asks.sum()), _WINDOW)
            found["one"], found["two"] = one[asks], two[asks]
            found["doc"] = docs.fill_null(0).to_numpy()[words.of[asks]]
            held.append(found)
        if held:
            yield flush()

    return met.mapInArrow(run, _ASKED_SQL)


def _least_of(known: np.ndarray, one: np.ndarray, two: np.ndarray, none: int) -> np.ndarray:
    """The least document of each window, or ``none``."""
    least = np.full(len(one), none, np.int64)
    at = np.searchsorted(known["one"], one)
    open_ = np.flatnonzero(at < len(known))
    while len(open_):
        row = known[at[open_]]
        here = row["one"] == one[open_]
        hit = here & (row["two"] == two[open_])
        least[open_[hit]] = row["doc"][hit]
        at[open_] += 1
        open_ = open_[here & ~hit & (at[open_] < len(known))]
    return least


def _cut_repeats(met: DataFrame, length: int, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, known, copies, part in _chunks_of(batches, _LEAST):
            words = _Words(part["text"], length)
            docs = part["doc_id"].to_pylist()
            rows = part["row"].to_pylist()
            one, two = words.windows()
            top = np.iinfo(np.int64).max
            least = _least_of(known, one, two, top) if len(known) else np.full(len(one), top)
            own = np.array([np.iinfo(np.int64).min if d is None else d for d in docs], np.int64)
            copied = np.array([r in copies for r in rows], bool)
            hits = words.starts[(least < own[words.of]) | copied[words.of]]
            edges = np.zeros(len(words.owner) + 1, np.int64)
            np.add.at(edges, hits, 1)
            np.add.at(edges, hits + length, -1)
            gone = np.cumsum(edges[:-1]) > 0
            bounds = np.searchsorted(words.owner, np.arange(len(docs) + 1))
            texts, spans, removed = [], [], []
            for text, a, b in zip(part["text"].cast(pa.large_binary()).to_pylist(), bounds, bounds[1:]):
                mask = gone[a:b]
                steps = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
                starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(starts, ends)])
                removed.append(int(mask.sum()))
                kept = (text or b"").split()
                texts.append(b" ".join(compress(kept, (~mask).tolist()) if removed[-1] else kept).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    part["row"],
                    part["doc_id"],
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(texts, pa.string()),
                ],
                ["row", "doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return met.mapInArrow(run, schema)


def drop_repeats(docs: DataFrame, length: int = 13, settled: bool = False) -> DataFrame:
    """Documents without the runs of ``length`` words or more that a smaller document has.

    ``docs`` has doc_id (bigint) and text; other columns are not looked at. The result has a row
    per row of ``docs``: doc_id, n_words, n_removed, spans (first word and end of every maximal
    repeat that was cut, from 0) and kept (the other words, joined by one space). Words are runs of
    bytes other than the six ASCII white-space ones, and are not changed.

    A document without doc_id is neither cut nor does it count for others; a null or empty text
    has no words. Rows of one doc_id are not smaller than one another: all of them keep what only
    they share. Repeats inside one document stay. ``settled`` says that ``docs`` is a scan or a
    written table already. Windows are compared by 96 bits of hash, whole copies by 128.
    """
    if length < SEED:
        raise ValueError(f"a repeat has at least {SEED} words")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs if settled else keep(docs, "documents")
    docs = docs.withColumn("row", F.monotonically_increasing_id())

    known = docs.select(
        "row",
        "doc_id",
        F.xxhash64("text").alias("one"),
        F.xxhash64(F.lit(1), "text").alias("two"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    known = keep(known, "known")
    buckets = max(
        (known.agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES + 1,
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    full = known.where("doc_id is not null and bytes > 0")
    least = full.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = keep(least.where("least < most").select("one", "two", "least"), "least")
    copies = keep(full.join(least, ["one", "two"]).where("doc_id > least").select("row"), "copies")
    packed = copies.groupBy(F.floor(F.col("row") / CHUNK).cast("long").alias("chunk"))
    packed = packed.applyInArrow(_pack_rows, _ANSWER_SQL)

    asking = docs.where("doc_id is not null").select("row", "text")
    if is_small(copies, BROADCAST_COPIES):
        asking = asking.join(F.broadcast(copies), "row", "left_anti")
    seeds = keep(_answer_seeds(_ask_for_seeds(asking, length, buckets)), "seeds")
    columns = ["row", "doc_id", "text"]
    asked = _ask_for_windows(_meet(docs, packed, seeds, columns), length, buckets)
    windows = keep(_answer_windows(asked), "windows")
    schema = (
        "row long, doc_id long, n_words long, n_removed long, "
        "spans array<struct<start: int, end: int>>, kept string"
    )
    return _cut_repeats(_meet(docs, packed, windows, columns), length, schema).drop("row")


def _pack_rows(key: tuple, table: pa.Table) -> pa.Table:
    rows = table["row"].to_numpy()
    return pa.table({"chunk": pa.array([int(rows[0]) // CHUNK], pa.int64()), "pack": [rows.astype("<i8").tobytes()]})
