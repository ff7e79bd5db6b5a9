"""One dispatch run: send the staged batches of a transaction and log every outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sendgate import schemas as S
from sendgate.operators import dispatch, ledger as L, logs
from sendgate.plans.primary import Folders, Run, first_start, log_kpi, utc_now
from sendgate.session import broadcast_if_small, keep, scratch, settle
from sendgate.sources import readers, writers
from sendgate.sources.layout import run_folder


def run_bulk(
    spark: SparkSession,
    folders: Folders,
    run: Run,
    transport: dispatch.Transport,
    tokens: dispatch.TokenSource,
    tasks: int | None = None,
    wait: Callable[[int], float] = dispatch.backoff_seconds,
    ledger: bool = False,
    resend_unresolved: bool = False,
) -> DataFrame:
    """Send what the manifest of this transaction lists; returns one outcome per file.

    Only files in the run's own manifest are sent, and each gets exactly one row in the
    response log. Sending again replaces these rows. With ``ledger``, files whose answer is known
    from an earlier, perhaps lost, call are not sent again, ``tasks`` files go at a time, and
    those that were in flight as it was lost are ``unresolved``.
    """
    started = utc_now()
    settle(spark)
    run = first_start(spark, folders, run)
    with scratch(spark):
        staging = readers.read_run_log(
            spark, f"{folders.logs}/staging", S.STAGING_LOG, *run.owner
        )
        manifest = keep(logs.manifest_for(staging, run.transaction_id), "manifest")
        staged = readers.read_batches(
            spark, folders.batches, run.run_date, run.transaction_id, run.business
        )
        listed = staged.join(broadcast_if_small(manifest), "DATA_C_FILENAME", "left_semi")
        if ledger:
            path = run_folder(f"{folders.logs}/ledger", *run.owner)
            listed = keep(listed, "listed")
            last = L.send_with_ledger(
                listed, path, transport, tokens, tasks, resend_unresolved, wait=wait
            )
        else:
            # Written before anything reads it: evaluating the attempts again would send again.
            sent = dispatch.dispatch_batches(listed, transport, tokens, tasks, wait=wait)
            last = dispatch.latest_attempt(keep(sent, "sent"))
        report = dispatch.dispatch_report(manifest, last)
        outcomes = writers.write_log(report, f"{folders.logs}/outcomes", S.OUTCOMES, *run.owner)
    report = readers.read_log(spark, outcomes, S.OUTCOMES)
    writers.write_log(
        dispatch.response_log(report, run.transaction_id),
        f"{folders.logs}/response",
        S.RESPONSE_LOG,
        *run.owner,
    )
    log_kpi(spark, folders, run, S.ITEM_BULK, started)
    return report
