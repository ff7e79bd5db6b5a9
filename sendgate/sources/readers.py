"""Reading the arriving file, the reference table and the staged tables."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sendgate import schemas as S
from sendgate.operators.dispatch import backoff_seconds
from sendgate.operators.status import day_of, normalise_due, overdue_keys
from sendgate.sources.layout import day_folder, run_folder
from sendgate.sources.records import read_records
from sendgate.sources.table_log import read_logged_table


_BAD = "_bad_record"
_T = TypeVar("_T")

# How errors of storage show: a path or file that cannot be read, or an exception of java.io, java.net.
_STORAGE = re.compile(
    r"PATH_NOT_FOUND|FAILED_READ_FILE|\bjava\.(?:io|net|nio)\.[\w.]*(?:Exception|Error)\b"
)


def retried(
    work: Callable[[], _T],
    attempts: int = S.SEND_ATTEMPTS,
    wait: Callable[[float], object] = time.sleep,
) -> _T:
    """Do ``work``, a read that ends in a written table or a value, again after errors of storage.

    Spark runs a failed task again by itself; this also covers the listing, the header and a job
    whose tasks have all failed. Waits grow from 2 to 20 s. Any other error, such as a missing column
    or a malformed record, is raised at once, and the last one of storage is raised, too.
    """
    for attempt in range(1, attempts + 1):
        try:
            return work()
        except Exception as error:
            if attempt == attempts or not _STORAGE.search(str(error)):
                raise
        wait(backoff_seconds(attempt))
    raise ValueError("no attempts")


def _ddl(header: StructType) -> str:
    """The header's columns and that of bad records, all text."""
    names = [field.name.replace("`", "``") for field in header] + [_BAD]
    return ", ".join(f"`{name}` string" for name in names)


def read_due(
    spark: SparkSession, path: str, multi_line: bool = False, drop_bad: bool = False
) -> DataFrame:
    """The candidates of one header CSV file, normalised.

    Columns are found by header name, as text; a missing one fails at once. A record with more
    or fewer values than the header, such as a line of a record whose quoted text goes over
    several lines, fails the read, or is left out with ``drop_bad``. ``multi_line`` allows line
    ends inside quotes (not in the header); a file is read by many tasks all the same.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)  # else the values of a record are not counted
    )
    header = reader.csv(path).schema
    if multi_line:
        parsed = F.from_csv("record", _ddl(header), {"escape": '"', "columnNameOfCorruptRecord": _BAD})
        records = read_records(spark, path).where(~F.col("first"))
        raw = records.select(parsed.alias("_r")).select("_r.*").select(*S.DUE_RAW.names, _BAD)
    else:
        raw = reader.schema(header.add(_BAD, "string")).csv(path).select(*S.DUE_RAW.names, _BAD)
    good = F.col(_BAD).isNull()
    if drop_bad:
        return normalise_due(raw.where(good))
    told = F.raise_error(F.concat(F.lit("not as many values as the header has: "), F.col(_BAD)))
    code = F.when(good, F.col(S.CODE)).otherwise(told.cast("string"))
    return normalise_due(raw.withColumn(S.CODE, code))


def read_overdue(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Overdue loan ids from the loan table; ``fmt`` may be any installed table format."""
    return overdue_keys(spark.read.format(fmt).load(path))


def read_overdue_as_of(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Overdue loan ids from a version of a loan table with a Delta log; the newest by default.

    Files without an overdue loan by the log are not opened.
    """
    overdue = [("BUCKET", ">", 0), ("INSTALLMENT_OVERDUE", ">", 0)]
    return overdue_keys(read_logged_table(spark, root, version, overdue))


def _read_staged(
    spark: SparkSession, root: str, folder: str, schema: StructType
) -> DataFrame:
    """A staged folder, or an empty frame of the same schema where there is none yet."""
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_history(
    spark: SparkSession, root: str, run_date: dt.date, exclude: str | None = None
) -> DataFrame:
    """Rows staged for sending on ``run_date``, without those of transaction ``exclude``."""
    staged = _read_staged(spark, root, day_folder(root, run_date), S.BATCHES)
    return day_of(staged, run_date, exclude)


def read_status(spark: SparkSession, root: str, run_date: dt.date) -> DataFrame:
    return _read_staged(spark, root, day_folder(root, run_date), S.STATUS)


def read_batches(
    spark: SparkSession, root: str, run_date: dt.date, transaction_id: str, business: str | None = None
) -> DataFrame:
    """The staged batches of a transaction; with ``business``, only its own folder is listed."""
    folder = day_folder(root, run_date)
    if business is not None:
        folder = run_folder(root, run_date, business, transaction_id)
    staged = _read_staged(spark, root, folder, S.BATCHES)
    return staged.where(F.col("transaction_id") == transaction_id)


def read_batch(
    spark: SparkSession, root: str, run_date: dt.date, transaction_id: str, batch_no: int
) -> DataFrame:
    """One staged batch; files without it are skipped by their statistics."""
    batches = read_batches(spark, root, run_date, transaction_id)
    return batches.where(F.col("batch_no") == batch_no)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The log rows under ``path``: of one run if that is its folder, else of all below."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_run_log(
    spark: SparkSession,
    root: str,
    schema: StructType,
    run_date: dt.date,
    business: str,
    transaction_id: str,
) -> DataFrame:
    """The log rows of one run; no other run's files are listed or read."""
    return read_log(spark, run_folder(root, run_date, business, transaction_id), schema)
