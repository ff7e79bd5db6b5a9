"""Runs per arriving file, driven by Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sendgate import schemas as S
from sendgate.plans.primary import Folders, Run, run_primary, utc_now
from sendgate.plans.runs import run_logged

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def process_arrivals(
    spark: SparkSession,
    landing: str,
    overdue: Callable[[SparkSession], DataFrame],
    folders: Folders,
    checkpoint: str,
    clock: Callable[[], dt.datetime] = utc_now,
    cap: int = S.DAILY_CAP,
    step: int = S.BATCH_STEP,
) -> StreamingQuery:
    """Run the primary plan once for each file that arrives in ``landing``, a folder or a pattern.

    Files are taken one at a time, as the result of each depends on those before it. The
    stream carries only paths; the run reads the file itself. The transaction id comes from
    the file's name and time of change and keeps the time of its first attempt, so a repeated
    micro-batch replaces what it wrote before, after midnight too, and a file of the same name on
    a later day is a run of its own. The stream takes a path once, so such files have to come
    in folders of their own (``landing/*``). A file that fails, or whose name has no business, is a
    row in the run log, and the stream goes on with the next.
    """

    def run_one(arrived: DataFrame, _epoch: int) -> None:
        for row in arrived.collect():  # one path per micro-batch
            path = row["path"]
            name = path.rsplit("/", 1)[-1]

            def work(path: str = path, name: str = name, changed: int = row["changed"]) -> None:
                run = Run(name, f"arrival-{name}-{changed}", clock())
                run_primary(spark, path, overdue(spark), folders, run, cap, step)

            run_logged(spark, folders, path, work)

    return (
        spark.readStream.schema(_FILES)
        .format("binaryFile")
        .option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path", F.unix_millis("modificationTime").alias("changed"))
        .writeStream.foreachBatch(run_one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
