"""One run for one arriving file: decide, audit, batch, stage and log."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sendgate import schemas as S
from sendgate.operators import batching, logs
from sendgate.operators.status import eligibility_cascade, eligible
from sendgate.session import keep, scratch, settle
from sendgate.sources import readers, writers


@dataclass(frozen=True)
class Folders:
    """Roots of the staged tables and logs. Status and batches never share a folder."""

    status: str
    batches: str
    logs: str

    @classmethod
    def under(cls, base: str) -> Folders:
        base = base.rstrip("/")
        return cls(f"{base}/status", f"{base}/batches", f"{base}/logs")


@dataclass(frozen=True)
class Run:
    """One run: its file, id and start (UTC), fixed once so that all steps see the same day."""

    file_name: str
    transaction_id: str
    started: dt.datetime

    def __post_init__(self) -> None:
        object.__setattr__(self, "file_name", self.file_name.strip())
        object.__setattr__(self, "transaction_id", self.transaction_id.strip())
        if self.started.tzinfo:
            utc = self.started.astimezone(dt.timezone.utc).replace(tzinfo=None)
            object.__setattr__(self, "started", utc)
        if not self.business:
            raise ValueError(f"no business in file name {self.file_name!r}")

    @property
    def business(self) -> str:
        parts = self.file_name.split("_")
        return parts[1] if len(parts) > 1 else ""

    @property
    def local_start(self) -> dt.datetime:
        return self.started + dt.timedelta(minutes=330)

    @property
    def run_date(self) -> dt.date:
        return self.local_start.date()

    @property
    def stamp(self) -> str:
        return self.local_start.strftime("%Y%m%d%H%M%S")

    @property
    def owner(self) -> tuple[dt.date, str, str]:
        """What names the run's own folders."""
        return self.run_date, self.business, self.transaction_id


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def first_start(spark: SparkSession, folders: Folders, run: Run) -> Run:
    """``run`` with the start of its transaction's first attempt, which is noted if this is it.

    So a run that is repeated, be it after midnight, has the same day, folders and file names.
    """
    path = f"{folders.logs}/start/{quote(run.transaction_id, safe='')}"
    schema = "started timestamp_ntz"
    mine = spark.createDataFrame([(run.started,)], schema)
    mine.write.mode("ignore").parquet(path)
    noted = spark.read.schema(schema).parquet(path).first()
    if noted is None:  # the first attempt was cut short while it wrote this
        mine.write.mode("overwrite").parquet(path)
        return run
    return replace(run, started=noted["started"])


def log_kpi(
    spark: SparkSession, folders: Folders, run: Run, item: str, started: dt.datetime
) -> None:
    def moment(time: dt.datetime) -> Column:
        return F.lit(time.isoformat()).cast("timestamp_ntz")

    one = spark.range(1).select(
        F.lit(run.transaction_id).alias("TRANSACTION_ID"),
        F.lit(run.file_name).alias("CG_FILENAME"),
        F.lit(item).alias("ITEM_TYPE"),
        moment(started).alias("started"),
        moment(utc_now()).alias("ended"),
    )
    writers.write_log(logs.kpi_log(one), f"{folders.logs}/kpi/{item}", S.KPI_LOG, *run.owner)


def run_primary(
    spark: SparkSession,
    due_path: str,
    overdue: DataFrame,
    folders: Folders,
    run: Run,
    cap: int = S.DAILY_CAP,
    step: int = S.BATCH_STEP,
    balanced: bool = False,
    count_audit: bool = False,
    dedupe_keys: bool = True,
    multi_line: bool = False,
    drop_bad: bool = False,
) -> DataFrame:
    """Run the file through the cascade and stage its batches; returns the manifest rows.

    The cascade runs once: the written status table feeds the log and the batches. Running
    the same transaction again, at whatever time, replaces its status, batches and log rows.
    ``count_audit`` also counts the day's status rows of other transactions towards the cap,
    ``dedupe_keys=False`` counts the fan-out of several overdue records; ``multi_line`` and
    ``drop_bad`` go to ``read_due``. Intermediate tables are dropped in the end.
    """
    started = utc_now()
    settle(spark)
    run = first_start(spark, folders, run)
    with scratch(spark):
        # The text is parsed once; later passes read only the columns they need.
        due = readers.retried(
            lambda: keep(readers.read_due(spark, due_path, multi_line, drop_bad), "due")
        )
        history = readers.read_history(spark, folders.batches, run.run_date, run.transaction_id)
        audit = readers.read_status(spark, folders.status, run.run_date) if count_audit else None
        status = eligibility_cascade(
            due,
            overdue,
            history,
            run.run_date,
            run.business,
            cap,
            include_audit=audit,
            dedupe_keys=dedupe_keys,
            exclude=run.transaction_id,
        )
        if count_audit:  # it is read and replaced in one folder
            status = keep(status, "status")
        written = writers.write_status(status, folders.status, *run.owner)
        status = spark.read.schema(status.schema).parquet(written)

        init = writers.write_log(
            logs.init_log(status, run.file_name, run.transaction_id),
            f"{folders.logs}/init",
            S.INIT_LOG,
            *run.owner,
        )
        totals = readers.read_log(spark, init, S.INIT_LOG).first()

        assign = batching.assign_batches_balanced if balanced else batching.assign_batches
        rows = eligible(status).drop(S.COPIES)
        batches = assign(rows, step, settled=True, rows=totals["ELIGIBLE_COUNT"])
        batches = batching.add_trigger_ids(batches, run.transaction_id)
        batches = batching.name_batches(batches, run.stamp, run.run_date, run.business)
        writers.write_batches(batches, folders.batches, *run.owner)

    staged = readers.read_batches(
        spark, folders.batches, run.run_date, run.transaction_id, run.business
    )
    manifest = batching.batch_manifest(staged)
    writers.write_log(
        logs.staging_log(manifest, run.file_name, run.transaction_id),
        f"{folders.logs}/staging",
        S.STAGING_LOG,
        *run.owner,
    )
    log_kpi(spark, folders, run, S.ITEM_PRIMARY, started)
    return manifest.orderBy(F.col("batch_no"))
