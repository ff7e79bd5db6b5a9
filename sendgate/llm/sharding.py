"""Sharding: balanced label propagation of linked rows over shards of equal row counts.

Links are a table of (row, hub): the rows of one hub are linked, for instance documents with
equal texts. Every row starts in a shard drawn from its number. In each round a hub takes the
shard that most of its rows are in, joins bring these labels to the rows as votes, and rows
move to the shard with most votes. Quotas per target keep linked rows within a shard's
capacity: of the hubs that want a full shard, a share drawn by hash goes. In the end rows
without links fill the shards up, and what is over goes where places are left, so that row
counts differ by one at most (law ``rows``).

A hub with more than half a shard's rows is split into pieces of about that size, so that no
hub stands in the way of a shard's capacity and its pieces fill shards one after the other.
Only numbers per shard, or per pair of shards, reach the driver.

Defined results:

* Null and empty texts are equal texts of no bytes; their CRC is 0.
* Repeated rows, also with one doc_id, are rows of their own and all kept.
* With fewer rows than shards, the first shards have one row each. An empty table stays empty.
* Every column of the input stays, except those named like an output column.
* Links of unknown rows are left out; a row may be in any number of hubs, also none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sendgate.llm.common import fresh
from sendgate.operators.batching import number_rows
from sendgate.session import broadcast_if_small, keep

LAW = "rows"
ROUNDS = 6
# Shares of hubs are drawn in so many steps.
_STEPS = 1 << 20


def _drawn(*columns: str | int) -> F.Column:
    """A number of ``range(_STEPS)`` that depends on the columns and salts alone."""
    parts = [F.lit(c) if isinstance(c, int) else F.col(c) for c in columns]
    return F.pmod(F.xxhash64(*parts), F.lit(_STEPS))


def split_hubs(links: DataFrame, most: int) -> DataFrame:
    """Links with hubs of more than ``most`` rows dealt to pieces, and hubs of one row left out."""
    sizes = (
        links.groupBy("hub")
        .agg(F.count("*").alias("_size"))
        .where(F.col("_size") > 1)
        .withColumn("_pieces", F.ceil(F.col("_size") / F.lit(most)))
    )
    # From a written table, Spark can split the rows of a large hub in the join.
    sizes = broadcast_if_small(keep(sizes, "hubs"))
    return links.join(sizes, "hub").select(
        "row", F.xxhash64("hub", F.pmod(F.xxhash64("row"), "_pieces")).alias("hub")
    )


def _labels(placed: DataFrame, salt: int) -> DataFrame:
    """The shard that most rows of each hub are in; a draw decides between equals."""
    counts = placed.groupBy("hub", "shard").agg(F.count("*").alias("_rows"))
    order = F.struct("_rows", _drawn("hub", "shard", salt))
    return counts.groupBy("hub").agg(F.max_by("shard", order).alias("label"))


def _shares(flows: dict[tuple[int, int], int], held: list[int], room: list[int]) -> list[float]:
    """Which share of the rows that want each shard may go there, so that none overflows.

    Places that movers leave count as room, as far as these surely go.
    """
    n = len(held)
    wanted = [sum(flows.get((s, t), 0) for s in range(n)) for t in range(n)]
    shares = [0.0] * n
    for _ in range(n):
        leaving = [
            sum(flows.get((s, t), 0) * shares[t] for t in range(n) if t != s) for s in range(n)
        ]
        shares = [
            min(1.0, max(0.0, (room[t] - held[t] + leaving[t]) / wanted[t])) if wanted[t] else 1.0
            for t in range(n)
        ]
    return shares


def propagate(
    rows: DataFrame, links: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS
) -> DataFrame:
    """Linked rows with the shard that label propagation moves them to: row and shard.

    ``rows`` has the columns row and shard (where each starts), ``links`` row and hub.
    """
    links = keep(split_hubs(links, max(1, capacity // 2)), "links")
    placed = keep(
        rows.join(links.select("row").distinct(), "row", "left_semi").select("row", "shard"),
        "placed",
    )
    for salt in range(rounds):
        at = links.join(placed, "row")
        labels = broadcast_if_small(keep(_labels(at, salt), "labels"))
        votes = (
            links.join(labels, "hub")
            .groupBy("row", "label")
            .agg(F.count("*").alias("_votes"), F.min("hub").alias("hub"))
        )
        order = F.struct("_votes", -_drawn("label", "hub", salt))
        wishes = (
            votes.join(placed, "row")
            .groupBy("row", "shard")
            .agg(
                F.max_by(F.struct("label", "_votes", "hub"), order).alias("best"),
                F.max(F.when(F.col("label") == F.col("shard"), F.col("_votes"))).alias("_now"),
            )
            .select(
                "row",
                "shard",
                F.when(F.col("best._votes") > F.coalesce("_now", F.lit(0)), F.col("best.label"))
                .otherwise(F.col("shard"))
                .alias("label"),
                F.col("best.hub").alias("hub"),
            )
        )
        wishes = keep(wishes, "wishes")
        # A row per pair of shards.
        counted = wishes.groupBy("shard", "label").agg(F.count("*").alias("n")).collect()
        flows = {(r.shard, r.label): r.n for r in counted if r.shard != r.label}
        if not flows:
            break
        held = [sum(r.n for r in counted if r.shard == s) for s in range(shards)]
        shares = _shares(flows, held, [capacity] * shards)
        limits = F.array(*[F.lit(int(share * _STEPS)) for share in shares])
        goes = _drawn("hub", "label", salt + rounds) < F.get(limits, F.col("label"))
        placed = keep(
            wishes.select("row", F.when(goes, F.col("label")).otherwise(F.col("shard")).alias("shard")),
            "placed",
        )
    return placed


def balanced_shards(
    rows: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS
) -> DataFrame:
    """``rows`` with ``shard`` and gapless ``slot``; row counts differ by one at most.

    ``rows`` is a written table with a unique bigint column row; ``links`` has row and hub.
    """
    total = rows.count()
    targets = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(F.xxhash64("row", F.lit(shards)), F.lit(shards)).cast("int")
    begun = rows.withColumn("shard", start)
    moved = propagate(begun.select("row", "shard"), links, shards, max(targets, default=0), rounds)
    hubs = links.groupBy("row").agg(F.min("hub").alias("_hub"))
    placed = (
        begun.select("row", F.col("shard").alias("_start"))
        .join(moved.join(hubs, "row"), "row", "left")
        .select(
            "row",
            F.coalesce("shard", "_start").alias("shard"),
            F.col("shard").isNull().cast("int").alias("_free"),
            "_hub",
        )
    )
    # Linked rows come first in a shard, those of one hub together; what is over is free rows.
    numbered = number_rows(placed, ["shard"], ["_free", "_hub", "row"], "_nth")
    numbered = keep(numbered, "numbered")
    held = {r.shard: r.n for r in numbered.groupBy("shard").agg(F.count("*").alias("n")).collect()}

    # The k-th row that is over, counted over all shards, takes the k-th free place.
    over = F.lit(None).cast("long")
    first = 0
    for s in range(shards):
        excess = max(0, held.get(s, 0) - targets[s])
        if excess:
            over = F.when(
                (F.col("shard") == s) & (F.col("_nth") > targets[s]),
                F.col("_nth") - targets[s] - 1 + first,
            ).otherwise(over)
        first += excess
    numbered = numbered.withColumn("_over", over)
    to_shard, to_slot = F.col("shard"), F.col("_nth") - 1
    first = 0
    for t in range(shards):
        places = max(0, targets[t] - held.get(t, 0))
        if places:
            here = (F.col("_over") >= first) & (F.col("_over") < first + places)
            to_shard = F.when(here, F.lit(t)).otherwise(to_shard)
            to_slot = F.when(here, F.col("_over") - first + held.get(t, 0)).otherwise(to_slot)
        first += places
    settled = numbered.select(
        "row", to_shard.cast("int").alias("shard"), to_slot.cast("long").alias("slot")
    )
    return rows.join(settled, "row")


def shard_documents(
    docs: DataFrame, shards: int = 24, text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """``docs`` without their texts: size, text_crc32, law, shard, slot and grown_shard.

    Documents with equal texts are linked. The size is the text's UTF-8 bytes plus 8.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    output = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    others = [c for c in docs.columns if c != text and c.lower() not in output]
    row, hub = fresh(others, "row"), fresh(others, "hub")
    base = keep(
        docs.select(
            *others,
            (F.octet_length(content) + 8).cast("long").alias("size"),
            F.crc32(F.to_binary(content, F.lit("utf-8"))).alias("text_crc32"),
            F.xxhash64(content).alias(hub),
            F.monotonically_increasing_id().alias(row),
        ),
        "documents",
    )
    links = base.select(
        F.col(row).alias("row"), F.xxhash64(hub, "text_crc32", "size").alias("hub")
    )
    placed = balanced_shards(base.select(F.col(row).alias("row")), links, shards, rounds)
    return base.join(placed.withColumnRenamed("row", row), row).select(
        *others,
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def split_links(placed: DataFrame, links: DataFrame) -> DataFrame:
    """Per hub, its rows and how many of them are outside the shard that most are in."""
    return (
        links.join(placed.select("row", "shard"), "row")
        .groupBy("hub", "shard")
        .agg(F.count("*").alias("n"))
        .groupBy("hub")
        .agg(F.sum("n").alias("rows"), (F.sum("n") - F.max("n")).alias("outside"))
    )
