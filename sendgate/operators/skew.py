"""Key joins that aggregate only what is asked for, and stay even under hot and missing keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sendgate.session import broadcast_if_small, is_small, keep

POSITION = "_position"

# A key table is broadcast up to this many rows, and up to ``session.BROADCAST_BYTES``.
BROADCAST_KEYS = 1_000_000


def mark_position(df: DataFrame) -> DataFrame:
    """Number the rows of a scan, so that even copies of one row differ.

    ``df`` has to be a scan or a written table: its rows keep their places when a task is
    run again.
    """
    return df.withColumn(POSITION, F.monotonically_increasing_id())


@dataclass(frozen=True)
class KeyTable:
    """The other side of a join: its ``rows``, and how they become one row per ``on`` key."""

    on: str
    rows: DataFrame
    reduce: Callable[[DataFrame], DataFrame]

    def keys(self, asked: DataFrame) -> DataFrame:
        """One row per key; rows not ``asked`` for are dropped before anything is aggregated."""
        rows = self.rows.where(F.col(self.on).isNotNull())
        return self.reduce(rows.join(asked, self.on, "left_semi"))


def match_keys(
    df: DataFrame,
    tables: Sequence[KeyTable],
    how: str,
    rows: int | None = None,
    max_broadcast: int = BROADCAST_KEYS,
) -> DataFrame:
    """Left or left anti join of ``df`` to key tables, whose other columns all differ.

    ``rows`` is the size of ``df`` where it is known, ``df`` then being a scan.

    * If ``df`` is small, its keys are sent to the other side, and the key table, which then
      is no larger, is sent back.
    * Otherwise the different keys of ``df`` are written and counted, and cut the other side
      down before it is aggregated: by broadcast if they are few, else shuffled by key, which
      the aggregation needs anyway. The key table is written and counted too; a small one is
      broadcast, and ``df`` is not shuffled for it.
    * What is large on both sides is a plain join of two tables. Rows of a hot key, copies of
      one row, and rows without a key meet in one partition there, and Spark's skew join
      (``spark.sql.adaptive.skewJoin.enabled``) splits it by size when it has the sizes.
    """
    if rows is not None and rows <= max_broadcast:
        asked = df.select(*[t.on for t in tables])
        if is_small(asked, max_broadcast):
            few = [(t.on, t.keys(F.broadcast(df.select(t.on).distinct()))) for t in tables]
            for on, keys in few:
                df = df.join(F.broadcast(keys), on, how)
            return df
    few = []
    for t in tables:
        asked = df.where(F.col(t.on).isNotNull()).select(t.on).distinct()
        asked = broadcast_if_small(keep(asked, "asked"), max_broadcast)
        few.append((t.on, keep(t.keys(asked), "keys")))
    for on, keys in few:
        df = df.join(broadcast_if_small(keys, max_broadcast), on, how)
    return df
