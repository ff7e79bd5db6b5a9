"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType

# Runtime settings the jobs are planned for. The checksum pair makes Spark rerun a whole
# stage when a recomputed map task produces other rows than the lost one did.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


def local_session(app: str, cpus: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\[]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sendgate-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path; all of one application's lie together and can be dropped after it."""
    owner = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/sendgate-{owner}/{label}-{uuid.uuid4().hex}"


# Makes a job's shuffle files go as it ends; else they stay until the driver collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Keep no shuffle files of the jobs that are planned inside."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def keep(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders ``by`` columns, and go on from that table.

    The result is a plain scan: it prunes columns, its row order no longer changes, and it
    survives the loss of any executor without recomputing what came before.
    """
    path = new_path(df.sparkSession, label)
    held = _SCRATCH.get()
    if held is not None:
        held.append(path)
    with _without_shuffles(df.sparkSession):
        df.write.parquet(path, partitionBy=list(by) or None)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._kept_at = path
    return table


def read_kept(table: DataFrame, part: Mapping[str, object]) -> DataFrame:
    """The rows in one folder of a table that was kept ``by`` columns; no other folder is listed."""
    folder = "/".join([table._kept_at, *(f"{name}={value}" for name, value in part.items())])
    return table.sparkSession.read.schema(table.drop(*part).schema).parquet(folder)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop in the end what ``keep`` writes inside; nothing may be read from it after that."""
    held: list[str] = []
    outer = _SCRATCH.set(held)
    try:
        yield
    finally:
        _SCRATCH.reset(outer)
        for path in held:
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a written table, wherever it is; one that is not there is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(table: DataFrame) -> None:
    """Drop a table that ``keep`` gave, once all that reads it has been written elsewhere."""
    drop(table.sparkSession, table._kept_at)


def settle(spark: SparkSession) -> None:
    """Set what the plans rely on in a session that others have made."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


# Small control tables (a row per batch file or per sorted block, up to some 100 bytes each)
# are broadcast up to this many rows, and any table up to this many bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _bytes_of(column: Column, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, NumericType):
        return F.lit(8)
    return F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) + 16


def size_of(table: DataFrame) -> tuple[int, int]:
    """Rows of a table, and about how many bytes they take in memory; one job."""
    parts = [_bytes_of(table[f.name], f.dataType) for f in table.schema]
    each = sum(parts[1:], parts[0]) if parts else F.lit(0)
    rows, held = table.agg(F.count("*"), F.sum(each.cast("long"))).first()
    return rows, held or 0


def is_small(table: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, held = size_of(table)
    return rows <= max_rows and held <= max_bytes


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table if it is counted to be small, else leave the join to Spark."""
    return F.broadcast(table) if is_small(table, max_rows) else table
