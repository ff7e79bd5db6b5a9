"""CSV payload text of the batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sendgate import schemas as S

HEADER = ",".join(S.PAYLOAD_COLUMNS)
PART_ROWS = 10_000

# Quotes are doubled and blanks are kept; nulls and empty texts are both written as nothing.
_CSV = {
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def payload_lines(batches: DataFrame, *others: str) -> DataFrame:
    """One CSV line per row, with the columns that place it in its file, and ``others``."""
    line = F.to_csv(F.struct(*S.PAYLOAD_COLUMNS), _CSV)
    return batches.select("DATA_C_FILENAME", S.CODE, "row_no", line.alias("line"), *others)


def build_payloads(
    batches: DataFrame, part_rows: int = PART_ROWS, others: Sequence[str] = ()
) -> DataFrame:
    """The payload text in parts of at most ``part_rows`` lines.

    A file is the header, then its parts by code and ``part_no``, each followed by a line
    end. No group is larger than a part, whatever the size of the batch. ``others`` are
    columns that the rows of a file share.
    """
    parts = payload_lines(batches, *others).withColumn(
        "part_no", F.expr(f"(row_no - 1) div {int(part_rows)}")
    )
    return parts.groupBy("DATA_C_FILENAME", S.CODE, "part_no").agg(
        F.count("*").alias("n_rows"),
        F.expr("listagg(line, '\n') within group (order by row_no)").alias("payload"),
        *[F.first(column).alias(column) for column in others],
    )
