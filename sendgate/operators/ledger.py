"""A durable ledger of sends, so that no file whose answer is known is ever sent again.

Files are sent in waves. Before a wave, an intent row per file is put in place; in it, each file is
a task of its own, whose answer becomes readable when that task commits, whether or not the job ever
ends. A wave of one file is a job of one task, and its answer becomes readable, through the driver, as
that job ends, before the next file's intent. So whatever is lost (a task, an executor, the driver), the ledger tells the files apart:

* with an answer: acknowledged, left out of every later attempt by an anti join;
* with an intent and no answer: in flight when something was lost. The receiver may have it or not,
  so it is ``unresolved`` and not sent again, unless that is asked for;
* with neither: still to be sent.

There may be as many waves as files, so a wave costs no more than its own files: the payloads and
the intents of all waves are written once before the first, in a folder per wave, and a wave reads
its own folder. Its planned intents become readable as their file is moved, which takes no job.
Waves of one file are planned once for all: each is a job over one partition of the same plan.

A task that Spark runs again, or twice by speculation, finds itself to be a further attempt and
reports its file as unresolved instead of sending it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import RDD, TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.util import _load_from_socket

from sendgate import schemas as S
from sendgate.operators import dispatch
from sendgate.operators.payloads import PART_ROWS, build_payloads
from sendgate.session import broadcast_if_small, drop, keep, read_kept

UNRESOLVED = "unresolved"
_NOT_SENT = -1
_WAVE = "_wave"

# The answers of a task are moved to the table as the task commits, not as the job does.
_AT_TASK_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_intents(spark: SparkSession, ledger: str) -> DataFrame:
    """The files that were about to be sent, with the wave, a row per try."""
    return _read(spark, f"{ledger}/intents", S.INTENTS)


def read_answers(spark: SparkSession, ledger: str) -> DataFrame:
    """Every attempt of the files whose task has ended."""
    return _read(spark, f"{ledger}/answers", S.ATTEMPTS).where(F.col("status") != UNRESOLVED)


def acknowledged(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per file with a known answer: that of its last attempt."""
    return dispatch.latest_attempt(read_answers(spark, ledger))


def unresolved(spark: SparkSession, ledger: str) -> DataFrame:
    """Files that were about to be sent and have no answer."""
    files = read_intents(spark, ledger).select("filename").distinct()
    return files.join(read_answers(spark, ledger).select("filename").distinct(), "filename", "left_anti")


def _first_attempt_only(transport: dispatch.Transport) -> dispatch.Transport:
    """The transport for the first attempt of a task; a later one does not send."""

    def send(file_name: str, payload: Iterator[str], token: str) -> tuple[int, str]:
        if TaskContext.get().attemptNumber():
            return _NOT_SENT, ""
        return transport(file_name, payload, token)

    return send


def _planned(ledger: str) -> str:
    return f"{ledger}/planned"


def _plan_intents(files: DataFrame, ledger: str, first: int) -> None:
    """The intents of all waves, in a folder per wave that no reader looks at; the first is ``first``."""
    told = files.select(
        F.col("DATA_C_FILENAME").alias("filename"), (F.lit(first) + F.col(_WAVE)).alias("wave"), _WAVE
    )
    # Beside the intents, so that a move does not leave the file system.
    told.coalesce(1).write.mode("overwrite").partitionBy(_WAVE).parquet(_planned(ledger))


class _Files:
    """The driver's hands on the ledger's folders; what a wave needs of them is looked up once."""

    def __init__(self, spark: SparkSession, ledger: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._ledger = ledger
        self._intents, self._answers = (self._path(f"{ledger}/{name}") for name in ("intents", "answers"))
        self._store = self._intents.getFileSystem(spark._jsc.hadoopConfiguration())
        self._store.mkdirs(self._intents)

    def declare(self, number: int) -> None:
        """Make the planned intents of a wave readable."""
        planned = self._path(f"{_planned(self._ledger)}/{_WAVE}={number}")
        parts = [status.getPath() for status in self._store.listStatus(planned)]
        for part in parts:
            # Parts have the same name in the folders of all waves.
            self._move(part, self._intents, f"wave-{number:06d}-{part.getName()}")
        if not parts:
            raise OSError(f"no planned intents in {planned}")

    def record(self, answers: list[Row]) -> None:
        """Make the attempts of one file readable."""
        self._store.mkdirs(self._answers)
        table = pa.Table.from_pylist([row.asDict() for row in answers], to_arrow_schema(S.ATTEMPTS))
        held = pa.BufferOutputStream()
        pq.write_table(table, held)
        name = f"part-{uuid.uuid4().hex}.parquet"
        # No reader looks at it by this name.
        unfinished = self._path(self._answers, f"_{name}")
        out = self._store.create(unfinished, False)
        out.write(bytearray(held.getvalue()))
        out.close()
        self._move(unfinished, self._answers, name)

    def _move(self, part, folder, name: str) -> None:
        if not self._store.rename(part, self._path(folder, name)):
            raise OSError(f"{part} could not be moved to {folder}")


def _run_one(rows: RDD, number: int) -> list[Row]:
    """The rows of one partition, as ``runJob`` gives them, which would start a second Python worker."""
    context = rows.context
    served = context._jvm.PythonRDD.runJob(context._jsc.sc(), rows._jrdd, [number])
    return list(_load_from_socket(served, rows._jrdd_deserializer))


def send_with_ledger(
    listed: DataFrame,
    ledger: str,
    transport: dispatch.Transport,
    tokens: dispatch.TokenSource,
    wave: int | None = None,
    resend_unresolved: bool = False,
    wait: Callable[[int], float] = dispatch.backoff_seconds,
    max_attempts: int = S.SEND_ATTEMPTS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Send the batches that the ledger has no answer for; returns one outcome per file known to it.

    ``listed`` has staged rows, as a scan or a written table. ``wave`` files are sent at the same
    time, by default as many as there are shuffle partitions, and so many may become unresolved
    together. A repeat with the same ``ledger`` goes on where the one before was lost. A file that
    was refused, or failed after its retries, has an answer too, and is not sent again.
    ``resend_unresolved`` sends again what has an intent and no answer. ``max_attempts`` and
    ``part_rows`` are those of ``dispatch_batches``.

    Whole stages that Spark runs again, because executors lost the parts of a payload before
    they were read, cannot be told from first ones by their tasks: there the file name stays the
    receiver's key for repeats. A wave of one file has a single task, which has read all its parts
    before it sends, so there this cannot be.
    """
    spark = listed.sparkSession
    wave = wave or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def names(files: DataFrame) -> DataFrame:
        return files.select(F.col("filename").alias("DATA_C_FILENAME"))

    files = listed.select("batch_no", "DATA_C_FILENAME").distinct()
    files = files.join(names(acknowledged(spark, ledger)), "DATA_C_FILENAME", "left_anti")
    if not resend_unresolved:
        files = files.join(names(unresolved(spark, ledger)), "DATA_C_FILENAME", "left_anti")
    # A row is a whole batch file, so one task can number them.
    place = F.row_number().over(Window.orderBy("batch_no", "DATA_C_FILENAME")) - 1
    files = files.select("DATA_C_FILENAME", place.alias("_place"))
    files = keep(files.withColumn(_WAVE, F.floor(F.col("_place") / wave)), "to-send")
    waves = -(-files.count() // wave)
    if not waves:
        return outcomes(spark, ledger)
    before = read_intents(spark, ledger).agg(F.max("wave")).first()[0]
    first = 0 if before is None else before + 1
    # The place in the wave deals each file to a task of its own.
    rows = listed.join(broadcast_if_small(files), "DATA_C_FILENAME").withColumn("batch_no", F.col("_place"))
    parts = build_payloads(rows, part_rows, ["batch_no", _WAVE])
    once = _first_attempt_only(transport)
    lost = F.col("status_code") == str(_NOT_SENT)

    def sending(dealt: DataFrame) -> DataFrame:
        sent = dispatch.send_payloads(dealt, once, tokens, max_attempts, wait)
        return sent.withColumn("status", F.when(lost, UNRESOLVED).otherwise(F.col("status")))

    try:
        _plan_intents(files, ledger, first)
        store = _Files(spark, ledger)
        if wave == 1:
            # A partition per file; nothing is sent but by a job over that partition.
            answers = sending(dispatch.deal_payloads(keep(parts, "payloads"), waves)).rdd
            for number in range(waves):
                store.declare(number)
                store.record(_run_one(answers, number))
        else:
            parts = keep(parts.hint("rebalance", F.col(_WAVE)), "payloads", by=[_WAVE])
            for number in range(waves):
                store.declare(number)
                sent = sending(dispatch.deal_payloads(read_kept(parts, {_WAVE: number}), wave))
                sent.write.mode("append").options(**_AT_TASK_COMMIT).parquet(f"{ledger}/answers")
    finally:
        drop(spark, _planned(ledger))
    return outcomes(spark, ledger)


def outcomes(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per file the ledger knows: its last answer, or ``unresolved`` without any."""
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in S.ATTEMPTS}
    empty |= {"filename": F.col("filename"), "status": F.lit(UNRESOLVED).alias("status")}
    open_ = unresolved(spark, ledger).select(*empty.values())
    return acknowledged(spark, ledger).select(*S.ATTEMPTS.names).unionByName(open_)
