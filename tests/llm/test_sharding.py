import zlib
from collections import Counter, defaultdict

import pytest

from sendgate.llm.queries import QUERIES
from sendgate.llm.sharding import _shares, balanced_shards, shard_documents, split_links
from sendgate.session import keep

SF_DIR = "/root/testdata/sf0.01"


def assert_law(rows, texts, shards):
    """Rows as (text, size, crc, shard, slot): sizes, checksums, even counts, gapless slots."""
    slots = defaultdict(list)
    for text, size, crc, shard, slot in rows:
        raw = (text or "").encode()
        assert size == len(raw) + 8 and crc == zlib.crc32(raw)
        slots[shard].append(slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and sum(counts) == len(texts)
    assert max(counts) - min(counts) <= 1


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op10_sharding"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert_law(
        [(texts[r.doc_id], r.size, r.text_crc32, r.shard, r.slot) for r in rows], texts, 24
    )
    groups = defaultdict(Counter)
    for r in rows:
        groups[texts[r.doc_id]][r.shard] += 1
    linked = [g for g in groups.values() if sum(g.values()) > 1]
    assert linked and all(len(g) == 1 for g in linked)


def test_hot_group(spark):
    """A third of all rows are copies: they fill whole shards, the rest stays together."""
    texts = ["hot"] * 400 + [f"pair {i // 2}" for i in range(200)] + [f"one {i}" for i in range(603)]
    df = spark.createDataFrame(
        [(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, hub string"
    ).repartition(5)
    rows = shard_documents(df, shards=12).collect()
    assert_law(
        [(texts[r.doc_id], r.size, r.text_crc32, r.shard, r.slot) for r in rows], texts, 12
    )
    hot = Counter(r.shard for r in rows if texts[r.doc_id] == "hot")
    assert len(hot) <= 8
    pairs = defaultdict(set)
    for r in rows:
        if texts[r.doc_id].startswith("pair"):
            pairs[texts[r.doc_id]].add(r.shard)
    assert sum(len(p) == 1 for p in pairs.values()) >= 95


def test_nulls_ties_few_rows(spark):
    texts = [None, "", None, "a", "a"]
    df = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    rows = shard_documents(df, shards=24).collect()
    assert sorted(r["size"] for r in rows) == [8, 8, 8, 9, 9]
    assert sorted(r.shard for r in rows) == [0, 1, 2, 3, 4] and {r.slot for r in rows} == {0}
    assert shard_documents(df.limit(0)).count() == 0


def test_overlapping_hubs(spark):
    """Chains of hubs are cut less than by the shards that the rows start in."""
    rows = keep(spark.range(960).select("id").withColumnRenamed("id", "row"), "rows")
    links = spark.createDataFrame(
        [(r, r // 8) for r in range(960)] + [(r, 1_000 + (r + 4) // 8) for r in range(0, 960, 2)],
        "row long, hub long",
    )
    placed = balanced_shards(rows, links, 8, rounds=12)
    counts = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert counts == [120] * 8
    outside = split_links(placed, links).agg({"outside": "sum"}).first()[0]
    begun = balanced_shards(rows, links, 8, rounds=0)
    assert outside < 0.5 * split_links(begun, links).agg({"outside": "sum"}).first()[0]


@pytest.mark.parametrize("room", [10, 15, 40])
def test_shares_never_overflow(room):
    flows = {(0, 1): 10, (1, 0): 4, (2, 1): 8, (0, 2): 3}
    held = [13, 10, 8]
    shares = _shares(flows, held, [room] * 3)
    for t in range(3):
        arriving = sum(n * shares[t] for (s, to), n in flows.items() if to == t)
        leaving = sum(n * shares[to] for (s, to), n in flows.items() if s == t)
        assert held[t] + arriving - leaving <= max(room, held[t]) + 1e-9
