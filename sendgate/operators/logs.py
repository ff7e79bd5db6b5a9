"""Rows of the log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sendgate.functions.scalars import ist_text
from sendgate.operators.funnel import funnel_totals

def init_log(status: DataFrame, file_name: str, transaction_id: str) -> DataFrame:
    return funnel_totals(status).select(
        F.lit(file_name).alias("CG_FILENAME"),
        F.lit(transaction_id).alias("TRANSACTION_ID"),
        "CG_COUNT",
        "TRANSFORMATIONS",
        "ELIGIBLE_COUNT",
    )


def staging_log(manifest: DataFrame, file_name: str, transaction_id: str) -> DataFrame:
    return manifest.select(
        F.lit(transaction_id).alias("TRANSACTION_ID"),
        F.lit(file_name).alias("CG_FILENAME"),
        "DATA_C_FILENAME",
        "BATCH_FILE_COUNT",
    )


def manifest_for(log: DataFrame, transaction_id: str) -> DataFrame:
    """Batch files of one run, names trimmed."""
    return log.where(F.col("TRANSACTION_ID") == transaction_id).select(
        F.trim("DATA_C_FILENAME").alias("DATA_C_FILENAME")
    )


def kpi_log(runs: DataFrame) -> DataFrame:
    """Start and end of runs as local time text, and the time between in microseconds.

    ``runs`` has ``TRANSACTION_ID, CG_FILENAME, ITEM_TYPE`` and UTC ``started``, ``ended``.
    """
    taken = F.timestamp_diff(
        "MICROSECOND", F.col("started").cast("timestamp"), F.col("ended").cast("timestamp")
    )
    return runs.select(
        "TRANSACTION_ID",
        "CG_FILENAME",
        "ITEM_TYPE",
        ist_text(F.col("started")).alias("START_TIME"),
        ist_text(F.col("ended")).alias("END_TIME"),
        taken.alias("DURATION_US"),
    )


def failed_runs(run_log: DataFrame) -> DataFrame:
    return run_log.where(F.col("result").startswith("ERROR:"))


def raise_on_failed_runs(run_log: DataFrame, path: str) -> None:
    """Write the failed runs to ``path`` and stop with their number, if there are any."""
    failed = failed_runs(run_log)
    failed.write.mode("overwrite").parquet(path)
    number = run_log.sparkSession.read.schema(run_log.schema).parquet(path).count()
    if number:
        raise RuntimeError(f"{number} failed runs, listed in {path}")
