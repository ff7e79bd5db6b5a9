"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sendgate.session import broadcast_if_small, keep


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its larger (or its smaller) neighbours to its least one.

    ``links`` has rows (a, b) with a > b; so has the result.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    sides = links.unionAll(turned) if large else links
    least = keep(sides.groupBy("a").agg(F.min("b").alias("least")), "least")
    if large:
        least = least.withColumn("least", F.least("a", "least"))
    # From written tables, Spark can split the links of a large node in the join.
    joined = sides.join(broadcast_if_small(least), "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.unionAll(least.select("a", F.col("least").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """The least node that each linked node reaches: node and root.

    ``links`` has two bigint columns a and b, in any direction and number; a link of a node to
    itself counts for nothing. Rounds go on until nothing changes, about the logarithm of the
    longest path; each is written, so that a lost executor costs one round. Single nodes are
    not in the result.
    """
    ordered = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = keep(ordered.distinct(), "links")
    before = None
    while True:
        links = keep(_star(links, large=True), "links")
        links = keep(_star(links, large=False), "links")
        state = links.agg(F.count("*"), F.sum(F.hash("a", "b")), F.sum("b")).first()
        if state == before:
            break
        before = state
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
