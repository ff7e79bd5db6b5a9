"""Running sums and minima along sorted groups of any size, block by block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sendgate.session import keep

BLOCK = "_block"
PLACE = "_place"
ROWS_PER_BLOCK = 500_000


def in_blocks(
    df: DataFrame, by: str, order: Sequence[Column | str], columns: Sequence[str], rows: int | None = None
) -> DataFrame:
    """``columns`` of ``df``, sorted by group and order over all tasks, with block and place.

    A range of rows is a block, so a group of any size spans as many as it needs. The bounds
    are drawn from a sample, so the placed rows are written: all that follows sees the same.
    ``df`` should be a scan or a written table; it is counted unless ``rows`` says its size.
    """
    spark = df.sparkSession
    count = df.count() if rows is None else rows
    blocks = max(count // ROWS_PER_BLOCK + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(blocks, by, *order).sortWithinPartitions(by, *order)
    return keep(
        ranged.select(
            *columns,
            F.spark_partition_id().alias(BLOCK),
            F.monotonically_increasing_id().alias(PLACE),
        ),
        "placed",
    )


def inside(by: str):
    """The rows of one group in one block, up to the current one."""
    return Window.partitionBy(BLOCK, by).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)


def before(by: str):
    """The blocks of a group before the current one."""
    return Window.partitionBy(by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def spanning(parts: DataFrame, by: str) -> DataFrame:
    """Of the rows per block and group, those of groups in several blocks.

    Blocks are ranges, so no block has more than two such groups: the result has at most twice
    as many rows as there are blocks.
    """
    several = parts.groupBy(by).agg(F.count("*").alias("_blocks")).where("_blocks > 1")
    return keep(parts.join(several.select(by), by, "left_semi"), "spanning")


def running(
    df: DataFrame,
    by: str,
    order: Sequence[Column | str],
    sums: Sequence[str] = (),
    mins: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """``df`` with the columns ``sums`` and ``mins`` replaced by their running values per group.

    A window over the group would be one task; here it is one per block and group, and what
    the earlier blocks of the group add comes from a table of two rows per block at most.
    """
    columns = df.columns
    placed = in_blocks(df, by, order, columns, rows)
    folds = {**{c: F.sum for c in sums}, **{c: F.min for c in mins}}
    parts = placed.groupBy(BLOCK, by).agg(*[fold(c).alias(c) for c, fold in folds.items()])
    earlier = spanning(parts, by).select(
        BLOCK, by, *[fold(c).over(before(by)).alias(f"_earlier_{c}") for c, fold in folds.items()]
    )
    here = placed.withColumns({c: fold(c).over(inside(by)) for c, fold in folds.items()})
    joined = here.join(F.broadcast(earlier), [BLOCK, by], "left")
    whole = {c: F.col(c) + F.coalesce(F.col(f"_earlier_{c}"), F.lit(0)) for c in sums}
    whole |= {c: F.least(F.col(c), F.col(f"_earlier_{c}")) for c in mins}
    return joined.select(*[whole[c].alias(c) if c in whole else F.col(c) for c in columns])
