"""Runs that may fail: each leaves a row in the run log, and the work goes on."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from sendgate import schemas as S
from sendgate.plans.primary import Folders
from sendgate.sources import readers

RETRIES = 1


def run_logged(
    spark: SparkSession,
    folders: Folders,
    path: str,
    work: Callable[[], object],
    retries: int = RETRIES,
) -> bool:
    """Do ``work`` for ``path``, again after an error; log its result and the retries taken.

    A repeat for the same path replaces its row.
    """
    result = "ok"
    for taken in range(retries + 1):
        try:
            work()
            result = "ok"
            break
        except Exception as error:
            text = str(error).splitlines()
            result = f"ERROR: {type(error).__name__}: {text[0] if text else ''}"
    row = spark.createDataFrame([(path, result, taken)], S.RUN_LOG)
    row.write.mode("overwrite").parquet(f"{folders.logs}/runs/{quote(path, safe='')}")
    return result == "ok"


def run_log(spark: SparkSession, folders: Folders) -> DataFrame:
    return readers.read_log(spark, f"{folders.logs}/runs", S.RUN_LOG)
