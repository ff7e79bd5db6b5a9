"""Numbering of rows and their split into bounded batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sendgate import schemas as S
from sendgate.functions import scalars
from sendgate.operators.skew import POSITION, mark_position
from sendgate.session import broadcast_if_small, keep

_BLOCK = "_block"
_PLACE = "_place"
_SHIFT = "_shift"

ORDER = (S.APPL_ID, S.IMEI)

# Blocks are sized by rows, as copies pack so well that sizes in bytes say little about work.
ROWS_PER_BLOCK = 500_000


def number_rows(
    df: DataFrame,
    by: Sequence[str] = (),
    order: Sequence[str] = ORDER,
    name: str = "row_no",
    settled: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK,
    rows: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, ... per ``by`` group in ``order``, whatever the size of a group.

    A window would put each group into one task. Here the rows are sorted over all tasks by
    range, so a large group, or many copies of one row, spans many of them. Each row knows
    its place in its block; the sizes of the blocks before it give the rest. Ties are broken
    by the other columns, so the numbers depend on the rows alone.

    ``settled`` says that ``df`` is a scan or a written table already, ``rows`` how many rows
    it has; they are counted otherwise. The placed rows are written while the plan is built.
    """
    if not settled:
        df = keep(df, "unnumbered")
    columns = df.columns
    others = [c for c in columns if c not in by and c not in order]
    sort = [*by, *order, *others, POSITION]
    n_blocks = (df.count() if rows is None else rows) // rows_per_block + 1
    ranged = mark_position(df).repartitionByRange(n_blocks, *sort).sortWithinPartitions(*sort)
    # The range bounds are drawn from a sample, so the placed rows are written once and
    # both passes below read the same places.
    placed = keep(
        ranged.select(
            *columns,
            F.spark_partition_id().alias(_BLOCK),
            F.monotonically_increasing_id().alias(_PLACE),
        ),
        "placed",
    )

    # One row per block and group: a window holds a row per half a million of the table's.
    earlier = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = placed.groupBy(*by, _BLOCK).agg(
        F.min(_PLACE).alias("_first"), F.count("*").alias("_size")
    )
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    shifts = keep(
        blocks.select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col(_BLOCK).alias("_by_block"),
            (before - F.col("_first") + 1).alias(_SHIFT),
        ),
        "shifts",
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    same.append(F.col(_BLOCK) == F.col("_by_block"))
    return placed.join(broadcast_if_small(shifts), reduce(lambda a, b: a & b, same)).select(
        *columns, (F.col(_PLACE) + F.col(_SHIFT)).alias(name)
    )


def _with_batch_no(numbered: DataFrame, step: int) -> DataFrame:
    return numbered.withColumn("batch_no", F.expr(f"(row_no - 1) div {int(step)}"))


def assign_batches(
    df: DataFrame,
    step: int = S.BATCH_STEP,
    code: str = S.CODE,
    order: Sequence[str] = ORDER,
    settled: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Batch k holds the rows ``k*step+1 .. (k+1)*step`` of every code; none is empty."""
    return _with_batch_no(number_rows(df, [code], order, settled=settled, rows=rows), step)


def assign_batches_balanced(
    df: DataFrame,
    step: int = S.BATCH_STEP,
    order: Sequence[str] = ORDER,
    settled: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Batches of exactly ``step`` rows over all codes; the last may be smaller."""
    return _with_batch_no(number_rows(df, (), order, settled=settled, rows=rows), step)


def batch_slice(batches: DataFrame, batch_no: int) -> DataFrame:
    return batches.where(F.col("batch_no") == batch_no)


def add_trigger_ids(batches: DataFrame, run_id: str) -> DataFrame:
    return batches.withColumn(S.TRIGGER_ID, scalars.trigger_id(run_id))


def name_batches(
    batches: DataFrame, stamp: str, run_date: dt.date, business: str
) -> DataFrame:
    """Add the relative path of each row's batch file. ``stamp`` is the run's time."""
    file_name = scalars.batch_file_name(F.lit(stamp), F.col("batch_no"))
    path = scalars.staged_path(F.lit(run_date), F.lit(business), file_name)
    return batches.withColumn("DATA_C_FILENAME", path)


def batch_manifest(batches: DataFrame) -> DataFrame:
    """One row per batch file with its row count."""
    return batches.groupBy("batch_no", "DATA_C_FILENAME").agg(
        F.count("*").alias("BATCH_FILE_COUNT")
    )
