"""One query per operator over the star-schema tables."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sendgate import schemas as S
from sendgate.fixtures import BUSINESS, FILE_NAME, RUN_DATE, RUN_ID, STAMP, STEP, LoggedLoans, Roles
from sendgate.functions import scalars
from sendgate.operators import batching, dispatch, funnel, logs, payloads, status as st
from sendgate.plans import concurrent
from sendgate.plans.bulk import run_bulk
from sendgate.plans.primary import Folders, Run, run_primary
from sendgate.plans.runs import run_log, run_logged
from sendgate.session import keep, new_path
from sendgate.sources import commits, compacted, readers, table_log, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Roles(spark, sf_dir))
    return build


# Eligibility ------------------------------------------------------------------------


@_query
def due_normalised(r: Roles) -> DataFrame:
    return st.normalise_due(r.due_raw)


@_query
def due_from_csv(r: Roles) -> DataFrame:
    path = new_path(r.spark, "due-csv")
    r.due_raw.write.option("header", True).csv(path)
    return readers.read_due(r.spark, path)


@_query
def overdue_keys(r: Roles) -> DataFrame:
    return st.overdue_keys(r.loans)


@_query
def due_from_odd_csv(r: Roles) -> DataFrame:
    """A file with line ends inside quotes, and lines with a value too many, left out."""
    path = new_path(r.spark, "due-csv")
    raw = r.due_raw.withColumn("OTHER", F.lit("two\nlines"))
    line = F.to_csv(F.struct(*raw.columns), {"escape": '"'})
    more = F.when(F.col("LOAN_OVERVIEW_IMEI").isNull(), ",1").otherwise("")
    text = raw.select(F.concat(line, more).alias("value"))
    header = r.spark.createDataFrame([(",".join(raw.columns),)], "value string")
    # One file with its header first, as it would arrive.
    header.unionAll(text).coalesce(1).write.text(path)
    return readers.read_due(r.spark, path, multi_line=True, drop_bad=True)


@_query
def overdue_from_table(r: Roles) -> DataFrame:
    path = new_path(r.spark, "loans")
    r.loans.write.parquet(path)
    return readers.read_overdue(r.spark, path)


@_query
def overdue_from_log(r: Roles) -> DataFrame:
    """The newest version of a loan table that keeps a log of its files."""
    return readers.read_overdue_as_of(r.spark, LoggedLoans(r).root)


@_query
def overdue_from_log_as_of(r: Roles) -> DataFrame:
    return readers.read_overdue_as_of(r.spark, LoggedLoans(r).root, version=2)


@_query
def loans_from_log(r: Roles) -> DataFrame:
    """All rows of the version that a checkpoint gives."""
    return table_log.read_logged_table(r.spark, LoggedLoans(r).root, version=1)


@_query
def null_key_flag(r: Roles) -> DataFrame:
    return st.flag_null_key(r.due)


def _overdue_step(r: Roles, **options) -> DataFrame:
    flagged = st.flag_null_key(r.due)
    return st.step_overdue(flagged, st.overdue_keys(r.loans), **options)


def _business_step(r: Roles) -> DataFrame:
    return st.step_business(_overdue_step(r), r.history, RUN_DATE, BUSINESS)


@_query
def step_overdue(r: Roles) -> DataFrame:
    return _overdue_step(r)


@_query
def step_overdue_fanout(r: Roles) -> DataFrame:
    return _overdue_step(r, dedupe_keys=False)


@_query
def business_keys(r: Roles) -> DataFrame:
    return st.business_keys(r.history, RUN_DATE, BUSINESS)


@_query
def step_business(r: Roles) -> DataFrame:
    return _business_step(r)


@_query
def capped_keys(r: Roles) -> DataFrame:
    return st.capped_keys(r.history, RUN_DATE)


@_query
def step_global_cap(r: Roles) -> DataFrame:
    return st.step_global_cap(_business_step(r), r.history, RUN_DATE)


def _cascade(r: Roles, history: DataFrame | None = None, **options) -> DataFrame:
    history = r.history if history is None else history
    overdue = st.overdue_keys(r.loans)
    return st.eligibility_cascade(r.due, overdue, history, RUN_DATE, BUSINESS, **options)


@_query
def cascade_status(r: Roles) -> DataFrame:
    return _cascade(r)


# The joins as they are run when no side is small: shuffled.
_SHUFFLED = {"max_broadcast": 0}


@_query
def cascade_shuffled(r: Roles) -> DataFrame:
    return _cascade(r, **_SHUFFLED)


@_query
def cascade_fanout(r: Roles) -> DataFrame:
    return _cascade(r, dedupe_keys=False)


@_query
def funnel_fanout(r: Roles) -> DataFrame:
    return funnel.funnel_counts(_cascade(r, dedupe_keys=False))


@_query
def cap_with_audit(r: Roles) -> DataFrame:
    """Audit rows of an earlier run count towards the cap, those of rejected rows too."""
    root = new_path(r.spark, "audit")
    writers.write_status(_cascade(r), root, RUN_DATE, "EARLIER", "EARLIER")
    return _cascade(r, include_audit=readers.read_status(r.spark, root, RUN_DATE))


@_query
def empty_history_cascade(r: Roles) -> DataFrame:
    return funnel.funnel_counts(_cascade(r, r.no_history))


@_query
def absent_history_cascade(r: Roles) -> DataFrame:
    """The first run ever: the folder of the history is not there yet."""
    nothing = readers.read_history(r.spark, new_path(r.spark, "none"), RUN_DATE)
    return funnel.funnel_counts(_cascade(r, nothing))


@_query
def cascade_rerun(r: Roles) -> DataFrame:
    """The run's own rows in the history do not count against it."""
    own = r.history.withColumn("transaction_id", F.col("business"))
    return funnel.funnel_counts(_cascade(r, own, exclude=BUSINESS))


@_query
def eligible(r: Roles) -> DataFrame:
    return st.eligible(_cascade(r))


@_query
def eligible_only(r: Roles) -> DataFrame:
    overdue = st.overdue_keys(r.loans)
    return st.eligible_only(r.due, overdue, r.history, RUN_DATE, BUSINESS)


@_query
def eligible_only_shuffled(r: Roles) -> DataFrame:
    overdue = st.overdue_keys(r.loans)
    return st.eligible_only(r.due, overdue, r.history, RUN_DATE, BUSINESS, **_SHUFFLED)


# Funnel -----------------------------------------------------------------------------


@_query
def funnel_counts(r: Roles) -> DataFrame:
    return funnel.funnel_counts(_cascade(r))


@_query
def funnel_json(r: Roles) -> DataFrame:
    return funnel.funnel_json(_cascade(r))


@_query
def funnel_conservation(r: Roles) -> DataFrame:
    return funnel.funnel_conservation(r.due, _cascade(r))


# Batches ----------------------------------------------------------------------------


def _batches(r: Roles) -> DataFrame:
    return batching.assign_batches(eligible_only(r), STEP)


def _named(r: Roles) -> DataFrame:
    triggered = batching.add_trigger_ids(_batches(r), RUN_ID)
    return batching.name_batches(triggered, STAMP, RUN_DATE, BUSINESS)


@_query
def batch_assign(r: Roles) -> DataFrame:
    return _batches(r)


@_query
def batch_slice(r: Roles) -> DataFrame:
    return batching.batch_slice(_batches(r), 1)


@_query
def batch_manifest(r: Roles) -> DataFrame:
    return batching.batch_manifest(_named(r))


@_query
def batch_balanced(r: Roles) -> DataFrame:
    return batching.assign_batches_balanced(eligible_only(r), STEP)


@_query
def trigger_ids(r: Roles) -> DataFrame:
    return batching.add_trigger_ids(_batches(r), RUN_ID)


@_query
def batch_file_names(r: Roles) -> DataFrame:
    return _named(r).groupBy("batch_no", "DATA_C_FILENAME").agg(
        F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row")
    )


@_query
def status_roundtrip(r: Roles) -> DataFrame:
    root = new_path(r.spark, "status")
    writers.write_status(_cascade(r), root, RUN_DATE, BUSINESS, RUN_ID)
    return readers.read_status(r.spark, root, RUN_DATE).withColumn(
        "run_date", F.date_format("run_date", "yyyy-MM-dd")
    )


@_query
def batches_roundtrip(r: Roles) -> DataFrame:
    """Batches written, then read back as the day's history of other transactions."""
    root = new_path(r.spark, "batches")
    writers.write_batches(_named(r), root, RUN_DATE, BUSINESS, RUN_ID)
    return readers.read_history(r.spark, root, RUN_DATE, exclude="RUN-2").select(
        S.APPL_ID, S.IMEI, S.CODE, "batch_no", "business", "transaction_id"
    )


@_query
def read_batch(r: Roles) -> DataFrame:
    root = new_path(r.spark, "batches")
    writers.write_batches(_named(r), root, RUN_DATE, BUSINESS, RUN_ID)
    batch = readers.read_batch(r.spark, root, RUN_DATE, RUN_ID, 0)
    return batch.select(S.IMEI, S.CODE, S.TRIGGER_ID)


@_query
def batch_csv(r: Roles) -> DataFrame:
    """One batch as header CSV, read back."""
    base = new_path(r.spark, "batch-csv")
    batch = keep(batching.batch_slice(_named(r), 0), "batch")
    name = f"/{RUN_DATE:%Y/%m/%d}/{BUSINESS}/batch_0.csv"
    writers.write_batch_csv(batch, base, name)
    return r.spark.read.option("header", True).csv(base + name)


# Logs -------------------------------------------------------------------------------


@_query
def init_log(r: Roles) -> DataFrame:
    return logs.init_log(_cascade(r), FILE_NAME, RUN_ID)


@_query
def init_log_appended(r: Roles) -> DataFrame:
    """Two runs log, one of them twice; a row of each is read back."""
    path = new_path(r.spark, "init-log")
    for run_id in (RUN_ID, "RUN-2", RUN_ID):
        log = logs.init_log(_cascade(r), FILE_NAME, run_id)
        writers.write_log(log, path, S.INIT_LOG, RUN_DATE, BUSINESS, run_id)
    return readers.read_log(r.spark, path, S.INIT_LOG)


@_query
def staging_log(r: Roles) -> DataFrame:
    return logs.staging_log(batching.batch_manifest(_named(r)), FILE_NAME, RUN_ID)


@_query
def manifest_for_run(r: Roles) -> DataFrame:
    """A log of many runs: the event type is the run, the padded user its file."""
    log = r.events.select(
        F.col("event_type").alias("TRANSACTION_ID"),
        F.concat(F.lit("  user_"), F.col("user_id"), F.lit(".csv ")).alias("DATA_C_FILENAME"),
    ).distinct()
    return logs.manifest_for(log, BUSINESS)


@_query
def kpi_log(r: Roles) -> DataFrame:
    """Each user's events of one type as a run from the first to the last."""
    runs = r.events.groupBy("user_id", "event_type").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended")
    )
    return logs.kpi_log(
        runs.select(
            F.concat(F.lit("user_"), F.col("user_id")).alias("TRANSACTION_ID"),
            F.concat(F.lit("FILE_"), F.col("event_type")).alias("CG_FILENAME"),
            F.when(F.col("event_type") == "view", S.ITEM_BULK)
            .otherwise(S.ITEM_PRIMARY)
            .alias("ITEM_TYPE"),
            "started",
            "ended",
        )
    )


@_query
def failed_runs(r: Roles) -> DataFrame:
    return logs.failed_runs(r.run_log)


@_query
def run_date_ist(r: Roles) -> DataFrame:
    return r.events.groupBy(scalars.run_date_ist(F.col("ts")).alias("run_date")).agg(
        F.count("*").alias("n"),
        F.min(scalars.ist_text(F.col("ts"))).alias("first_time"),
        F.max(scalars.ist_text(F.col("ts"))).alias("last_time"),
    )


@_query
def business_of_file(r: Roles) -> DataFrame:
    """Names with a business part, and names without one."""
    named = F.concat(F.lit(" FILE_"), F.col("event_type"), F.lit("_"), F.col("event_id"))
    plain = F.concat(F.lit("X"), F.col("event_id"))
    name = F.when(F.col("event_type") == "error", plain).otherwise(named)
    return r.events.select("event_id", scalars.business_of(name).alias("business"))


# Dispatch ---------------------------------------------------------------------------


@_query
def payload_lines(r: Roles) -> DataFrame:
    return payloads.payload_lines(_named(r))


@_query
def payload_digest(r: Roles) -> DataFrame:
    parts = payloads.build_payloads(_named(r), part_rows=100)
    return parts.withColumn("payload", F.md5("payload")).withColumnRenamed("payload", "digest")


@_query
def response_classes(r: Roles) -> DataFrame:
    return r.attempts.select(
        "event_id",
        dispatch.classify_response(F.col("code")).alias("status"),
        F.col("code").cast("string").alias("status_code"),
    )


def _latest(r: Roles) -> DataFrame:
    attempts = r.attempts.select(
        "filename",
        "ts",
        "event_id",
        dispatch.classify_response(F.col("code")).alias("status"),
        F.col("code").cast("string").alias("status_code"),
        "api_response",
    )
    return dispatch.latest_attempt(attempts, order=["ts", "event_id"])


def _sent_manifest(r: Roles) -> DataFrame:
    """Every device of an order is a file to send; only some were attempted."""
    return (
        r.table("orders")
        .select(F.concat(F.lit("user_"), F.col("o_custkey")).alias("DATA_C_FILENAME"))
        .distinct()
    )


@_query
def latest_attempt(r: Roles) -> DataFrame:
    return _latest(r).select("filename", "event_id", "status", "status_code", "api_response")


@_query
def dispatch_report(r: Roles) -> DataFrame:
    return dispatch.dispatch_report(_sent_manifest(r), _latest(r))


@_query
def response_log(r: Roles) -> DataFrame:
    return dispatch.response_log(dispatch_report(r), RUN_ID)


@_query
def response_log_parsed(r: Roles) -> DataFrame:
    return dispatch.parse_responses(response_log(r))


def _fake_transport(file_name: str, payload: Iterator[str], token: str) -> tuple[int, str]:
    """Refuses the first token, then answers with the size and digest of what it was sent."""
    if token == "stale":
        return 401, "expired"
    lines = size = 0
    digest = hashlib.md5()
    for piece in payload:
        raw = piece.encode()
        lines, size = lines + raw.count(b"\n"), size + len(raw)
        digest.update(raw)
    answer = f'"rows": {lines - 1}, "bytes": {size}, "md5": "{digest.hexdigest()}"'
    return 200, "{" + answer + "}"


class _Flaky:
    """Raises twice for every file, then answers with the digest of what it was sent."""

    def __init__(self) -> None:
        self.calls: Counter[str] = Counter()

    def __call__(self, file_name: str, payload: Iterator[str], token: str) -> tuple[int, str]:
        self.calls[file_name] += 1
        if self.calls[file_name] < 3:
            next(payload)
            raise ConnectionError("down")
        return _fake_transport(file_name, payload, token)


class _Tokens:
    """Gives an outdated token first and a good one after."""

    def __init__(self) -> None:
        self.given = 0

    def __call__(self) -> str:
        self.given += 1
        return "stale" if self.given == 1 else "fresh"


@_query
def dispatch_fake_transport(r: Roles) -> DataFrame:
    attempts = dispatch.dispatch_batches(_named(r), _fake_transport, _Tokens())
    return dispatch.latest_attempt(attempts).select(
        "filename", "status", "status_code", "api_response"
    )


@_query
def dispatch_retried(r: Roles) -> DataFrame:
    """Every file is sent whole at the third attempt."""
    attempts = dispatch.dispatch_batches(
        _named(r), _Flaky(), lambda: "fresh", wait=lambda _: 0.0, part_rows=100
    )
    return dispatch.latest_attempt(attempts)


# The whole run ----------------------------------------------------------------------


def _staged(r: Roles) -> tuple[str, Folders]:
    """The arriving file, and folders with the day's earlier sends of each business."""
    due = new_path(r.spark, "arrival")
    r.due_raw.write.option("header", True).csv(due)
    folders = Folders.under(new_path(r.spark, "run"))
    (
        r.history.withColumn("transaction_id", F.lit("EARLIER"))
        .select(S.IMEI, "run_date", "business", "transaction_id")
        .write.partitionBy("run_date", "business", "transaction_id")
        .parquet(folders.batches)
    )
    return due, folders


_STARTED = dt.datetime(2024, 1, 2, 4, 0)


def _primary(r: Roles, runs: Sequence[tuple[dt.datetime, int]] = ((_STARTED, STEP),)):
    """The primary run, once per given start and step, always as the same transaction."""
    due, folders = _staged(r)
    overdue = st.overdue_keys(r.loans)
    for started, step in runs:
        run = Run(FILE_NAME, RUN_ID, started)
        manifest = run_primary(r.spark, due, overdue, folders, run, step=step)
    return folders, run, manifest


# Repeated with a larger step, at last after midnight.
_AGAIN = (
    (_STARTED, STEP // 2),
    (_STARTED + dt.timedelta(minutes=5), 10 * STEP),
    (_STARTED + dt.timedelta(days=1), STEP),
)


@_query
def primary_run(r: Roles) -> DataFrame:
    """File in, manifest out: the run's status, batches and logs are written on the way."""
    return _primary(r)[2]


@_query
def primary_status(r: Roles) -> DataFrame:
    """The status table that a whole run wrote."""
    folders, run, _ = _primary(r)
    status = readers.read_status(r.spark, folders.status, run.run_date)
    return status.select(S.APPL_ID, S.IMEI, S.CODE, S.FILTER_STATUS)


@_query
def primary_init_log(r: Roles) -> DataFrame:
    """The init log of a whole run that was repeated."""
    folders, _, _ = _primary(r, _AGAIN)
    return readers.read_log(r.spark, f"{folders.logs}/init", S.INIT_LOG)


@_query
def primary_run_twice(r: Roles) -> DataFrame:
    """The staging log after repeats: what the last one staged, and nothing else."""
    folders, _, _ = _primary(r, _AGAIN)
    return readers.read_log(r.spark, f"{folders.logs}/staging", S.STAGING_LOG)


@_query
def bulk_run(r: Roles) -> DataFrame:
    """The staged batches of a run, sent and reported."""
    folders, run, _ = _primary(r)
    return run_bulk(r.spark, folders, run, _fake_transport, _Tokens())


@_query
def bulk_after_rerun(r: Roles) -> DataFrame:
    """One outcome per file that is staged in the end."""
    folders, run, _ = _primary(r, _AGAIN)
    return run_bulk(r.spark, folders, run, _fake_transport, _Tokens())


@_query
def run_log_written(r: Roles) -> DataFrame:
    """A good file, one without a business in its name, one that is not there, and a good one."""
    due, folders = _staged(r)
    overdue = st.overdue_keys(r.loans)
    for path, name in ((due, FILE_NAME), (due, "noname.csv"), (due + "-x", "X_view_1.csv"), (due, "X_error_2.csv")):

        def work(path: str = path, name: str = name) -> None:
            run = Run(name, f"T-{name}", _STARTED)
            run_primary(r.spark, path, overdue, folders, run, step=STEP)

        run_logged(r.spark, folders, name, work)
    log = run_log(r.spark, folders)
    counted = readers.read_log(r.spark, f"{folders.logs}/init", S.INIT_LOG)
    failed = logs.failed_runs(log).select("path", F.lit(True).alias("failed"))
    return (
        log.join(failed, "path", "left")
        .join(counted.select(F.col("CG_FILENAME").alias("path"), "CG_COUNT"), "path", "left")
        .select("path", F.coalesce("failed", F.lit(False)).alias("failed"), "retries", "CG_COUNT")
    )


class _Killed:
    """Ends the whole task, as a lost executor does, while the given file is in flight."""

    def __init__(self, ending: str) -> None:
        self.ending = ending

    def __call__(self, file_name: str, payload: Iterator[str], token: str) -> tuple[int, str]:
        if file_name.endswith(self.ending):
            raise SystemExit("lost")
        return _fake_transport(file_name, payload, token)


@_query
def bulk_after_loss(r: Roles) -> DataFrame:
    """A dispatch that is lost with a file in flight, and the repeat that sends the rest."""
    folders, run, _ = _primary(r)
    try:
        run_bulk(r.spark, folders, run, _Killed("_1_REQ.csv"), lambda: "fresh", tasks=1, ledger=True)
    except Exception:  # as the driver sees it, the job has failed
        pass
    return run_bulk(r.spark, folders, run, _fake_transport, lambda: "fresh", tasks=1, ledger=True)


@_query
def cap_within_file(r: Roles) -> DataFrame:
    """Each device gets at most three rows a day, those of this file included."""
    return st.cap_within_file(_cascade(r), r.history, RUN_DATE)


@_query
def cap_within_file_shuffled(r: Roles) -> DataFrame:
    return st.cap_within_file(_cascade(r), r.history, RUN_DATE, **_SHUFFLED)


# Runs at the same time ----------------------------------------------------------------

RIVAL = "click"
RIVAL_ID = "RUN-2"


def _published(r: Roles) -> tuple[str, str]:
    """The arriving file, and a folder where the day's earlier sends are published."""
    due = new_path(r.spark, "arrival")
    r.due_raw.write.option("header", True).csv(due)
    base = new_path(r.spark, "published")
    for business in ("view", "click", "purchase", "signup", "error"):
        _publish_earlier(r, base, business)
    return due, base


def _publish_earlier(r: Roles, base: str, business: str) -> None:
    rows = r.history.where(F.col("business") == business)
    known = {S.IMEI: F.col(S.IMEI)}
    columns = [f for f in S.BATCHES if f.name not in ("run_date", "business", "transaction_id")]
    batches = rows.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in columns]
    )
    commits.publish(r.spark, base, RUN_DATE, business, f"EARLIER-{business}", {"batches": batches})


def _race(r: Roles) -> str:
    """Two businesses' runs read the same day; the rival commits while the other is about to."""
    due, base = _published(r)
    overdue = st.overdue_keys(r.loans)
    mine = Run(FILE_NAME, RUN_ID, _STARTED)
    rival = Run(f"CUSTOMERS_{RIVAL}_20240102.csv", RIVAL_ID, _STARTED)

    def overtake(tries: int) -> None:
        if not tries:
            concurrent.run_concurrent(r.spark, due, overdue, base, rival, step=STEP)

    concurrent.run_concurrent(r.spark, due, overdue, base, mine, step=STEP, before_commit=overtake)
    return base


@_query
def race_status(r: Roles) -> DataFrame:
    """The status of both runs, as if the one that committed last had begun after the other."""
    status = commits.read_published(r.spark, _race(r), concurrent.STATUS, S.STATUS, RUN_DATE)
    return status.select(S.APPL_ID, S.IMEI, S.CODE, S.FILTER_STATUS, "business", "transaction_id")


@_query
def race_batches(r: Roles) -> DataFrame:
    """The batches of both runs, numbered without the rows that lost."""
    batches = commits.read_published(r.spark, _race(r), concurrent.BATCHES, S.BATCHES, RUN_DATE)
    ours = batches.where(F.col("transaction_id").isin(RUN_ID, RIVAL_ID))
    return ours.select(S.APPL_ID, S.IMEI, S.CODE, "row_no", "batch_no", "transaction_id")


@_query
def killed_before_commit(r: Roles) -> DataFrame:
    """A repeat that ends between its last write and its commit: the first attempt's log is read."""
    due, base = _published(r)
    overdue = st.overdue_keys(r.loans)
    run = Run(FILE_NAME, RUN_ID, _STARTED)
    concurrent.run_concurrent(r.spark, due, overdue, base, run, step=STEP)

    def die(_tries: int) -> None:
        raise InterruptedError

    try:
        concurrent.run_concurrent(r.spark, due, overdue, base, run, step=10 * STEP, before_commit=die)
    except InterruptedError:
        pass
    return commits.read_published(r.spark, base, concurrent.STAGING, S.STAGING_LOG, RUN_DATE)


def _compacted(r: Roles) -> str:
    """A day that is compacted after three runs, before two more, one of them for the second time."""
    base = new_path(r.spark, "published")
    for business in ("view", "click", "purchase"):
        _publish_earlier(r, base, business)
    compacted.compact_day(r.spark, base, RUN_DATE)
    for business in ("signup", "error", "view"):
        _publish_earlier(r, base, business)
    return base


def _cascade_over_parts(r: Roles, **options) -> DataFrame:
    parts = compacted.history_parts(r.spark, _compacted(r), RUN_DATE)
    return st.cascade_over_parts(r.due, st.overdue_keys(r.loans), parts, BUSINESS, **options)


@_query
def cascade_compacted(r: Roles) -> DataFrame:
    """The cascade over a bucketed part of the day and what was committed after it."""
    return _cascade_over_parts(r)


@_query
def cascade_compacted_shuffled(r: Roles) -> DataFrame:
    return _cascade_over_parts(r, **_SHUFFLED)


@_query
def compacted_day(r: Roles) -> DataFrame:
    """A second compaction, made of the first and the runs since."""
    _, rows = compacted.compact_day(r.spark, _compacted(r), RUN_DATE)
    return rows.select(S.IMEI, "business", "sent")
