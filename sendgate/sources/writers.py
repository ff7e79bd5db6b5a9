"""Writing the staged tables and the logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from sendgate import schemas as S
from sendgate.sources.layout import run_folder


def require_rows(file_name: str, rows: DataFrame) -> None:
    """Refuse a batch file without a name or without rows."""
    if not isinstance(file_name, str) or not file_name.strip():
        raise ValueError(f"a batch file needs a name, not {file_name!r}")
    if rows is None or rows.isEmpty():
        raise ValueError(f"no rows for {file_name}")


def write_status(
    status: DataFrame, root: str, run_date: dt.date, business: str, transaction_id: str
) -> str:
    """Write every row with its status; a rerun of the same transaction replaces it.

    The fan-out counts are written where there are any.
    """
    folder = run_folder(root, run_date, business, transaction_id)
    columns = [S.APPL_ID, S.IMEI, S.CODE, S.FILTER_STATUS]
    columns += [S.COPIES] if S.COPIES in status.columns else []
    status.select(*columns).write.mode("overwrite").parquet(folder)
    return folder


def write_batches(
    batches: DataFrame, root: str, run_date: dt.date, business: str, transaction_id: str
) -> str:
    """Write all batches in one job, as one table.

    Numbered rows come in number order per code, so each file holds a run of batches and a
    read of one batch skips the other files by their statistics. A folder per batch would
    cost a file per batch and task, and the day's history would be read from all of them.
    """
    folder = run_folder(root, run_date, business, transaction_id)
    columns = [
        S.APPL_ID, S.IMEI, S.CODE, S.TRIGGER_ID, "row_no", "batch_no", "DATA_C_FILENAME",
    ]
    batches.select(*columns).write.mode("overwrite").parquet(folder)
    return folder


def write_batch_csv(batch: DataFrame, base: str, file_name: str) -> str:
    """Write one batch as header CSV under ``base`` and return its relative path."""
    require_rows(file_name, batch)
    batch.select(*S.PAYLOAD_COLUMNS).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(base.rstrip("/") + file_name)
    return file_name


def write_log(
    rows: DataFrame,
    root: str,
    schema: StructType,
    run_date: dt.date,
    business: str,
    transaction_id: str,
) -> str:
    """Write the log rows of one run to its own folder; a rerun replaces them."""
    folder = run_folder(root, run_date, business, transaction_id)
    typed = [F.col(field.name).cast(field.dataType) for field in schema]
    rows.select(*typed).write.mode("overwrite").parquet(folder)
    return folder
