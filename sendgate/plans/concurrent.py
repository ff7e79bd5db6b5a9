"""Primary runs that may go at the same time: the daily cap holds as if they had gone in turn.

A run reads the day as of a version, decides, writes a snapshot, and tries to commit the next
version. If others have committed since, it looks at the keys of their batches alone: rows of its
own with such a key are labelled anew from the history as it is now, and the batches are written
again only if a label changed. So the result is that of the runs one after another, in the order of
their commits, and no run waits for another.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sendgate import schemas as S
from sendgate.operators import batching, logs
from sendgate.operators.status import cascade_over_parts, contacts_of_day, day_of, eligible
from sendgate.plans.primary import Folders, Run, first_start, log_kpi, utc_now
from sendgate.session import broadcast_if_small, drop, keep, scratch, settle
from sendgate.sources import commits as C, readers
from sendgate.sources.compacted import history_parts

STATUS, BATCHES, INIT, STAGING = TABLES = ["status", "batches", "init", "staging"]

_AGAIN = (S.UNIQUE_GLOBAL, S.DUPLICATE_GLOBAL, S.DUPLICATE_BIZ)


def published_history(spark: SparkSession, base: str, run: Run, version: int) -> DataFrame:
    """The day's staged rows as of ``version``, without the run's own."""
    day = C.read_published(spark, base, BATCHES, S.BATCHES, run.run_date, version)
    return day_of(day, run.run_date, run.transaction_id)


def touched_keys(spark: SparkSession, base: str, run: Run, since: int, now: int) -> DataFrame:
    """Keys of all batches that commits after ``since`` and up to ``now`` added or replaced."""
    before = C.current_commits(spark, base, run.run_date, since)
    after = C.current_commits(spark, base, run.run_date, now)
    other = F.col("transaction_id") != run.transaction_id
    changed = [
        one.join(two.select("version"), "version", "left_anti").where(other)
        for one, two in ((before, after), (after, before))
    ]
    rows = [C.read_snapshots(spark, part, base, BATCHES, S.BATCHES) for part in changed]
    return rows[0].unionByName(rows[1]).where(F.col(S.IMEI).isNotNull()).select(S.IMEI).distinct()


def relabel_touched(
    status: DataFrame, touched: DataFrame, history: DataFrame, run: Run, cap: int
) -> DataFrame:
    """``status`` with the rows of touched keys labelled by the history as it is now.

    A row that the file alone decides (no key, or an overdue loan) stays as it is. The history is
    cut down to the touched keys before it is aggregated.
    """
    touched = keep(touched, "touched")
    contacts = contacts_of_day(history, run.run_date, run.business, cap)
    known = contacts.keys(broadcast_if_small(touched))
    label = (
        F.when(F.col("_biz"), S.DUPLICATE_BIZ)
        .when(F.col("_capped"), S.DUPLICATE_GLOBAL)
        .otherwise(S.UNIQUE_GLOBAL)
    )
    labels = keep(touched.join(known, S.IMEI, "left").select(S.IMEI, label.alias("_label")), "labels")
    joined = status.join(broadcast_if_small(labels), S.IMEI, "left")
    again = F.col(S.FILTER_STATUS).isin(*_AGAIN) & F.col("_label").isNotNull()
    new = F.when(again, F.col("_label")).otherwise(F.col(S.FILTER_STATUS))
    return joined.select(
        *[new.alias(c) if c == S.FILTER_STATUS else F.col(c) for c in status.columns],
        (again & (F.col("_label") != F.col(S.FILTER_STATUS))).alias("_changed"),
    )


def _write(
    spark: SparkSession, base: str, run: Run, status: DataFrame, step: int, balanced: bool
) -> str:
    """All tables of one attempt, in a snapshot of their own; returns its name."""
    snapshot = uuid.uuid4().hex

    def write(table: DataFrame, name: str) -> DataFrame:
        path = C.write_snapshot(table, base, name, *run.owner, snapshot)
        return spark.read.schema(table.schema).parquet(path)

    columns = [S.APPL_ID, S.IMEI, S.CODE, S.FILTER_STATUS]
    status = write(status.select(*columns), STATUS)
    init = write(logs.init_log(status, run.file_name, run.transaction_id), INIT).first()
    assign = batching.assign_batches_balanced if balanced else batching.assign_batches
    rows = assign(eligible(status), step, settled=True, rows=init["ELIGIBLE_COUNT"])
    rows = batching.add_trigger_ids(rows, run.transaction_id)
    rows = batching.name_batches(rows, run.stamp, run.run_date, run.business)
    owned = {"run_date", "business", "transaction_id"}
    staged = write(rows.select(*[c for c in S.BATCHES.names if c not in owned]), BATCHES)
    manifest = batching.batch_manifest(staged)
    write(logs.staging_log(manifest, run.file_name, run.transaction_id), STAGING)
    return snapshot


def _drop(spark: SparkSession, base: str, run: Run, snapshot: str) -> None:
    for name in TABLES:
        drop(spark, C.snapshot_folder(base, name, *run.owner, snapshot))


def run_concurrent(
    spark: SparkSession,
    due_path: str,
    overdue: DataFrame,
    base: str,
    run: Run,
    cap: int = S.DAILY_CAP,
    step: int = S.BATCH_STEP,
    balanced: bool = False,
    multi_line: bool = False,
    drop_bad: bool = False,
    before_commit: Callable[[int], None] | None = None,
) -> tuple[int, DataFrame]:
    """Run the file, at the same time as others of the day; the version it became, its manifest.

    Its tables (status, batches, init, staging) become readable together, by ``read_published``
    under ``base``, when it commits. Running a transaction again replaces its tables in the same
    way; until then the earlier ones stay readable. ``before_commit`` is called before every try
    with the number of tries so far.
    """
    started = utc_now()
    settle(spark)
    folders = Folders.under(base)
    run = first_start(spark, folders, run)
    tries = 0
    with scratch(spark):
        due = readers.retried(
            lambda: keep(readers.read_due(spark, due_path, multi_line, drop_bad), "due")
        )
        version = C.latest_version(spark, base, run.run_date)
        parts = history_parts(spark, base, run.run_date, version, run.transaction_id)
        status = keep(cascade_over_parts(due, overdue, parts, run.business, cap), "status")
        snapshot = _write(spark, base, run, status, step, balanced)
        while True:
            if before_commit is not None:
                before_commit(tries)
            tries += 1
            record = C.commit_record(*run.owner, snapshot, TABLES)
            if C.try_commit(spark, base, run.run_date, version + 1, record):
                version += 1
                break
            now = C.latest_version(spark, base, run.run_date)
            touched = touched_keys(spark, base, run, version, now)
            history = published_history(spark, base, run, now)
            again = keep(relabel_touched(status, touched, history, run, cap), "status")
            version = now
            if not again.where("_changed").isEmpty():
                _drop(spark, base, run, snapshot)
                status = again.drop("_changed")
                snapshot = _write(spark, base, run, status, step, balanced)
    log_kpi(spark, folders, run, S.ITEM_PRIMARY, started)
    path = C.snapshot_folder(base, STAGING, *run.owner, snapshot)
    return version, spark.read.schema(S.STAGING_LOG).parquet(path)
