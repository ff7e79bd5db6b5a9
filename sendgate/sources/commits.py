"""Published runs: snapshot folders, and a log of commits that says which are current.

Every attempt of a run writes its tables to a snapshot folder of its own, which no reader looks
at yet. One commit record, the next version of the day's log, then makes all tables of the attempt
current at once, and the snapshot of an earlier attempt no longer is. A run that is killed before
its commit changes nothing that anybody reads; one that is repeated never leaves a gap.

A record is a folder ``v<version>`` with one file, put in place by a rename: of several runs that
try the same version one succeeds, and each reads back whether it was its own. This needs a file
system that renames folders atomically, as HDFS and local ones do.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sendgate import schemas as S
from sendgate.session import drop
from sendgate.sources.layout import run_folder

_RECORD = "record.json"


def _log_folder(base: str, run_date: dt.date) -> str:
    return f"{base.rstrip('/')}/commits/run_date={run_date.isoformat()}"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def snapshot_folder(
    base: str, table: str, run_date: dt.date, business: str, transaction_id: str, snapshot: str
) -> str:
    owned = run_folder(f"{base.rstrip('/')}/{table}", run_date, business, transaction_id)
    return f"{owned}/snapshot={snapshot}"


def read_commits(spark: SparkSession, base: str, run_date: dt.date) -> DataFrame:
    """The records of one day, a row per commit."""
    try:
        return spark.read.schema(S.COMMIT).json(f"{_log_folder(base, run_date)}/v*/{_RECORD}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], S.COMMIT)


def latest_version(spark: SparkSession, base: str, run_date: dt.date) -> int:
    """The last version of the day's log; 0 before the first commit."""
    return read_commits(spark, base, run_date).agg(F.max("version")).first()[0] or 0


def current_commits(
    spark: SparkSession, base: str, run_date: dt.date, version: int | None = None
) -> DataFrame:
    """The commits that no later one of the same transaction replaces, as of ``version``."""
    commits = read_commits(spark, base, run_date)
    if version is not None:
        commits = commits.where(F.col("version") <= version)
    later = commits.select(
        F.col("transaction_id").alias("_transaction"), F.col("version").alias("_later")
    )
    replaced = (F.col("transaction_id") == F.col("_transaction")) & (
        F.col("_later") > F.col("version")
    )
    return commits.join(later, replaced, "left_anti")


def try_commit(
    spark: SparkSession, base: str, run_date: dt.date, version: int, record: Mapping[str, object]
) -> bool:
    """Make ``record`` the given version of the day's log; false if another run has taken it."""
    token = uuid.uuid4().hex
    log = _log_folder(base, run_date)
    pending, files = _files(spark, f"{log}/pending-{token}")
    final, _ = _files(spark, f"{log}/v{version:012d}")
    if files.exists(final):
        return False
    files.mkdirs(pending)
    path = spark._jvm.org.apache.hadoop.fs.Path(pending, _RECORD)
    out = files.create(path, False)
    out.write(bytearray(json.dumps({**record, "version": version, "token": token}).encode()))
    out.close()
    # Onto a folder that is there, a rename fails or moves into it; the record in place decides.
    try:
        files.rename(pending, final)
    except Exception:  # the answer is in the log
        pass
    ours = spark.read.schema(S.COMMIT).json(f"{log}/v{version:012d}/{_RECORD}")
    won = ours.first()["token"] == token
    if not won:
        files.delete(pending, True)
    return won


def write_snapshot(
    table: DataFrame,
    base: str,
    name: str,
    run_date: dt.date,
    business: str,
    transaction_id: str,
    snapshot: str,
) -> str:
    """Write one table of an attempt; nobody reads it before the attempt is committed."""
    folder = snapshot_folder(base, name, run_date, business, transaction_id, snapshot)
    table.write.mode("error").parquet(folder)
    return folder


def read_snapshots(
    spark: SparkSession, commits: DataFrame, base: str, name: str, schema: StructType
) -> DataFrame:
    """One table of the given commits that have it: only their folders are listed and read.

    A commit is a run, so the paths are as many as the day has runs.
    """
    paths = [
        snapshot_folder(base, name, c.run_date, c.business, c.transaction_id, c.snapshot)
        for c in commits.where(F.array_contains("tables", name)).collect()
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    root = f"{base.rstrip('/')}/{name}"
    found = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    return found.select(*schema.names)


def read_published(
    spark: SparkSession,
    base: str,
    name: str,
    schema: StructType,
    run_date: dt.date,
    version: int | None = None,
) -> DataFrame:
    """One table of the day as its commits up to ``version`` left it."""
    return read_snapshots(spark, current_commits(spark, base, run_date, version), base, name, schema)


def publish(
    spark: SparkSession,
    base: str,
    run_date: dt.date,
    business: str,
    transaction_id: str,
    tables: Mapping[str, DataFrame],
) -> int:
    """Write and commit tables that do not depend on what others commit; returns the version."""
    snapshot = uuid.uuid4().hex
    owner = (run_date, business, transaction_id)
    for name, table in tables.items():
        write_snapshot(table, base, name, *owner, snapshot)
    record = commit_record(*owner, snapshot, list(tables))
    while True:
        version = latest_version(spark, base, run_date) + 1
        if try_commit(spark, base, run_date, version, record):
            return version


def commit_record(
    run_date: dt.date, business: str, transaction_id: str, snapshot: str, tables: list[str]
) -> dict[str, object]:
    return {
        "run_date": run_date.isoformat(),
        "business": business,
        "transaction_id": transaction_id,
        "snapshot": snapshot,
        "tables": tables,
    }


def drop_replaced(spark: SparkSession, base: str, run_date: dt.date) -> int:
    """Delete the snapshots of the day that a later commit has replaced; returns their number.

    Readers that resolved the log before that commit must be done. Snapshots that were never
    committed stay, as their run may still be about to.
    """
    commits = read_commits(spark, base, run_date)
    current = current_commits(spark, base, run_date).select("version")
    replaced = commits.join(current, "version", "left_anti").collect()
    for c in replaced:
        for name in c.tables:
            drop(
                spark,
                snapshot_folder(base, name, run_date, c.business, c.transaction_id, c.snapshot),
            )
    return len(replaced)
