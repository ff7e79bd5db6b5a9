import itertools
import random
import re
import string
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sendgate.llm import jaccard_join, shingles
from sendgate.llm.jaccard_join import (
    Join,
    _add_sheets,
    _singles,
    choose_boundary,
    drop_near_duplicates,
    keys_needed,
    link_documents,
    linked_pairs,
)
from sendgate.llm.queries import QUERIES
from sendgate.session import keep
from tests.llm.test_embedding_dedup import roots

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, text) -> sorted (id, n_shingles, component_id)."""
    sets = [shingle_set(text) for _, text in rows]
    holders = {}
    for i, own in enumerate(sets):
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    pairs = {p for held in holders.values() for p in itertools.combinations(held, 2)}
    linked = [
        (a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    root = roots(len(rows), linked)
    name = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    return sorted((rows[i][0], len(sets[i]), name[root[i]]) for i in range(len(rows)))


def run(spark, rows, join=None):
    # Rows have to keep their places, as those of a written table do.
    df = keep(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "docs")
    found = link_documents(df, join=join)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())


def corpus(seed, n=80):
    """Short and long texts, copies, near copies in chains, and passages many texts share."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdef", k=draw.randint(1, 4))) for _ in range(60)]
    passage = draw.choices(words, k=15)
    texts = []
    for i in range(n):
        text = draw.choices(words, k=draw.choice([1, 2, 4, 5, 6, 7, 9, 14, 30, 60]))
        if i % 4 == 0:
            text[len(text) // 2 : len(text) // 2] = passage
        texts.append(text)
        for _ in range(draw.choice([0, 0, 0, 1, 4, 12])):
            text = list(text)
            for _ in range(draw.choice([0, 1, 1, 2, 4])):
                text[draw.randrange(len(text))] = draw.choice(words)
            texts.append(text)
    draw.shuffle(texts)
    spaces = [" ", "  ", "\n", "\t", " \r\n"]
    joined = ["".join(w + draw.choice(spaces) for w in text) for text in texts]
    return [(i * 7 % 10_007, t.upper() if i % 5 == 0 else t) for i, t in enumerate(joined)]


@pytest.mark.parametrize(
    "join",
    [None, Join(boundary=0), Join(boundary=8, chunk=64), Join(boundary=10**9)],
)
def test_against_brute_force(spark, join):
    rows = corpus(1)
    assert run(spark, rows, join) == brute(rows)


def test_large_group_of_near_copies(spark):
    """Members of one cluster, many beyond the threshold of their hub, cut into small chunks."""
    draw = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(250):
        text = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 5])):
            text[draw.randrange(80)] = f"x{draw.random()}"
        rows.append((i, " ".join(text)))
    assert run(spark, rows, Join(chunk=800)) == brute(rows)


def test_nulls_short_texts_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE "), (6, "one two three four")]
    rows += [(7, "one two three four five"), (7, "one two three four five"), (8, " "), (9, "É"), (10, "é")]
    rows += [(11, "a " * 50_000), (12, "a a a a a"), (13, "a a a a a b")]
    assert run(spark, rows) == brute(rows)
    named = spark.createDataFrame([(None, "a b"), (None, "c d"), (3, "a b")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in link_documents(named).collect())
    assert got == [(0, 0), (0, 3), (3, 3)]


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_drop_keeps_one_of_each(spark):
    rows = corpus(3, 60)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    kept = drop_near_duplicates(df.coalesce(2))
    assert kept.columns == ["doc_id", "text", "row"]
    component = {i: c for i, _, c in brute(rows)}
    got = [component[r.doc_id] for r in kept.collect()]
    assert sorted(got) == sorted(set(component.values()))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_jaccard_join"](spark, sf_dir).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute(rows)


def test_sets_of_hashes():
    texts = [text for _, text in corpus(4, 40)] + [None, "", " ", "ß ẞ A", "x" * 3_000_000 + " y"]
    hashes, bounds = shingles.shingle_sets(pa.array(["skipped", *texts]).slice(1))
    names = {}
    for i, text in enumerate(texts):
        own = hashes[bounds[i] : bounds[i + 1]]
        assert (np.diff(own.astype(object)) > 0).all()
        expected = shingle_set(text)
        assert len(own) == len(expected)
        if text and len(expected) == 1:
            assert names.setdefault(next(iter(expected)), own[0]) == own[0]
    assert len(set(names.values())) == len(names)


def test_boundary_follows_costs():
    nothing = np.zeros(1 << 20, np.uint8)
    assert choose_boundary({50: 1000, 500: 1000}, nothing, 75) < 50
    # Where the same shingles are everywhere, scanning their lists costs more.
    common = np.zeros(1 << 20, np.uint8)
    common[:100] = 17
    assert choose_boundary({50: 1000, 500: 1000}, common, 75) >= 50
    assert choose_boundary({}, nothing, 75) == 0


def brute_links(rows):
    """The linked pairs of places in ``rows``."""
    sets = [shingle_set(text) for _, text in rows]
    pairs = itertools.combinations(range(len(rows)), 2)
    return [
        (a, b)
        for a, b in pairs
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0
    ]


@pytest.mark.parametrize(
    "join", [None, Join(boundary=0, chunk=300), Join(boundary=8, chunk=64), Join(boundary=10**9)]
)
def test_every_link_is_counted(spark, join):
    rows = [(i, text) for i, (_, text) in enumerate(corpus(5))] + [(10_000, None), (10_001, " ")]
    expected = dict.fromkeys(range(len(rows)), 0)
    linked = brute_links(rows)
    for pair in linked:
        for place in pair:
            expected[place] += 1
    df = keep(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "docs")
    found = link_documents(df, join=join, links=True).collect()
    assert {r.doc_id: r.n_links for r in found} == {rows[i][0]: n for i, n in expected.items()}
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)
    # Pairs of different sets, each once.
    sets = [frozenset(shingle_set(text)) for _, text in rows]
    different = {frozenset((sets[a], sets[b])) for a, b in linked if sets[a] != sets[b]}
    pairs = linked_pairs(df, join=join).collect()
    assert all(r._a < r._b for r in pairs)
    assert len(pairs) == len(different)
    assert {frozenset((sets[r.a], sets[r.b])) for r in pairs} == different


def chance_corpus():
    """Long texts of many passages, each of which is also in some other one; and three near copies."""
    draw = random.Random(6)
    passages = [[f"p{p}w{i}" for i in range(8)] for p in range(400)]
    rows = []
    for i in range(40):
        own = [[f"d{i}w{j}" for j in range(20 * part, 20 * part + 20)] for part in range(60)]
        for place in range(0, 60, 2):
            own[place] = own[place] + draw.choice(passages)
        rows.append((i, [w for part in own for w in part]))
    for i in range(40, 43):
        copy = list(rows[i - 40][1])
        copy[100] = f"x{i}"
        rows.append((i, copy))
    return [(i, " ".join(words)) for i, words in rows]


@pytest.mark.parametrize("links", [False, True])
def test_chance_passages_make_no_candidates(spark, monkeypatch, links):
    """Only the sets of texts that share many keys are written and sent to tasks."""
    rows = chance_corpus()
    df = keep(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "docs")
    written = []

    def kept(table, label, by=()):
        table = keep(table, label, by)
        written.append((label, table))
        return table

    monkeypatch.setattr(jaccard_join, "keep", kept)
    monkeypatch.setattr(jaccard_join, "release", lambda table: None)
    # As where the sketch has not counted what is shared: any order is right.
    monkeypatch.setattr(jaccard_join, "_levels", lambda described: np.zeros(1 << 24, np.uint8))
    found = link_documents(df, links=links, join=Join(boundary=0)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)
    sets = next(table for label, table in written if label == "sets")
    assert sets.count() == 6
    sent = [table.count() for label, table in written if label == "dealt"]
    assert sum(sent) <= 12


@pytest.mark.parametrize("links", [False, True])
def test_sets_are_sent_in_passes(spark, monkeypatch, links):
    """Chunks that take many copies of the sets are sent a part at a time, and nothing is lost."""
    draw = random.Random(7)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(draw.choice([1, 2, 3, 5])):
            text[draw.randrange(80)] = f"x{draw.random()}"
        rows.append((i, " ".join(text)))
    sent = []

    def kept(table, label, by=()):
        table = keep(table, label, by)
        if label == "dealt":
            sent.append(table.agg({"n": "sum"}).first()[0])
        return table

    monkeypatch.setattr(jaccard_join, "keep", kept)
    df = keep(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "docs")
    found = link_documents(df, links=links, join=Join(boundary=0, chunk=800, sent=1)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)
    if links:
        whole, *passes = sent
        assert len(passes) > 5 and sum(passes) == whole
        expected = dict.fromkeys(range(120), 0)
        for pair in brute_links(rows):
            for place in pair:
                expected[place] += 1
        assert {r.doc_id: r.n_links for r in found} == expected


def test_keys_needed_are_shared_at_least(spark):
    """Any two sizes that can link share as many keys as the larger and the smaller one need."""
    for percent in (60, 75, 90):
        found = spark.range(1, 700).select("id", keys_needed(F.col("id"), percent)).collect()
        needed = dict(tuple(r) for r in found)
        for n in range(1, 700):
            for m in range(-(-n * percent // 100), n + 1):
                shared = min(int(_singles(n, percent)), int(_singles(m, percent)))
                assert max(needed[n], needed[m]) <= shared <= -(-n * percent // 100)


def test_one_sheet_of_the_sketch_is_held_at_a_time():
    draw = np.random.default_rng(3)
    parts, expected = [], {sheet: np.zeros(1 << 16, int) for sheet in range(256)}
    for sheet in range(256):
        for _ in range(2):
            low = np.unique(draw.integers(0, 1 << 16, 50))
            times = draw.integers(2, 1000, len(low))
            expected[sheet][low] += times
            cells = (low + (sheet << 16)).astype("<u4").tobytes()
            parts.append({"sheet": sheet, "cells": cells, "times": times.astype("<u4").tobytes()})
    table = pa.Table.from_pylist(
        parts, pa.schema([("sheet", pa.int32()), ("cells", pa.binary()), ("times", pa.binary())])
    )
    found, sizes = {}, []
    tracemalloc.start()
    for batch in _add_sheets(iter(table.to_batches(max_chunksize=301))):
        sizes.append(batch.num_rows)
        found[batch["sheet"][0].as_py()] = bytes(batch["levels"][0].as_py())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [1] * 256 and list(_add_sheets(iter([]))) == []
    for sheet, counts in expected.items():
        assert found[sheet] == np.ceil(np.log2(counts + 1)).astype(np.uint8).tobytes()
    # 16 MB of levels, and some counts; those of all sheets would be 128 MB.
    assert peak < 32 << 20
