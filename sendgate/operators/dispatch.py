"""Sending batches from the executors, and the outcome of each."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import sendgate
from sendgate import schemas as S
from sendgate.functions.scalars import response_json
from sendgate.operators.payloads import HEADER, PART_ROWS, build_payloads

# transport(file name, pieces of the payload text, token) -> (HTTP status code, response text)
Transport = Callable[[str, Iterator[str], str], tuple[int, str]]
TokenSource = Callable[[], str]

# The sending function goes to the executors with its code, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sendgate)

_UNAUTHORISED = 401
_SENT_SCHEMA = "filename string, attempt int, code int, api_response string, last boolean"
# A payload is held in memory up to this many bytes, and on the task's own disk beyond.
SPOOLED_BYTES = 16 << 20
_PIECE = 1 << 20


def backoff_seconds(attempt: int) -> float:
    """Exponential wait after the given failed attempt."""
    return float(min(S.BACKOFF_MAX_SECONDS, max(S.BACKOFF_MIN_SECONDS, 2**attempt)))


def classify_response(code: Column) -> Column:
    """The outcome class of an HTTP status code; null is an attempt that raised."""
    return (
        F.when(code.isNull(), "failed")
        .when(code.between(200, 399), "success")
        .when(code == _UNAUTHORISED, "auth_retry")
        .when(code >= 400, "error")
        .otherwise("unknown")
    )


class _Tokens:
    """The token of one task. A source that failed is not asked again by the same task."""

    def __init__(self, source: TokenSource, wait: Callable[[int], float]) -> None:
        self._source = source
        self._wait = wait
        self._token: str | None = None
        self._failure: Exception | None = None

    def get(self, fresh: bool = False) -> str:
        if self._failure is not None:
            raise self._failure
        if self._token is None or fresh:
            for asked in range(1, S.TOKEN_ATTEMPTS + 1):
                try:
                    self._token = self._source()
                    break
                except Exception as error:
                    if asked == S.TOKEN_ATTEMPTS:
                        self._failure = error
                        raise
                    time.sleep(self._wait(asked))
        return self._token


def _send_with_retry(
    file_name: str,
    payload: Callable[[], Iterator[str]],
    tokens: _Tokens,
    transport: Transport,
    max_attempts: int,
    wait: Callable[[int], float],
) -> list[tuple[str, int, int | None, str, bool]]:
    """Every attempt for one file; the last one decides.

    A raised error is retried up to ``max_attempts`` times; one 401 refreshes the token and
    sends again; any other answer is final. A token that cannot be had ends the file at once.
    """
    answers: list[tuple[int | None, str]] = []
    raised = 0
    refreshed = False
    while raised < max_attempts:
        try:
            token = tokens.get(fresh=refreshed and answers[-1][0] == _UNAUTHORISED)
        except Exception as error:  # the outcome is a row, so no batch is lost from the log
            answers.append((None, f"{error!r}"))
            break
        try:
            code, text = transport(file_name, payload(), token)
        except Exception as error:
            raised += 1
            answers.append((None, f"{error!r}"))
            if raised < max_attempts:
                time.sleep(wait(raised))
            continue
        answers.append((int(code), text))
        if code != _UNAUTHORISED or refreshed:
            break
        refreshed = True
    return [
        (file_name, number, code, text, number == len(answers))
        for number, (code, text) in enumerate(answers, 1)
    ]


def dispatch_batches(
    batches: DataFrame,
    transport: Transport,
    tokens: TokenSource,
    tasks: int | None = None,
    max_attempts: int = S.SEND_ATTEMPTS,
    wait: Callable[[int], float] = backoff_seconds,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Send every batch as one payload and return one row per attempt.

    ``tasks`` is the number of files sent at the same time. The payload is put together in the
    JVM, in parts of at most ``part_rows`` lines; a task spools the parts of one file at a time,
    beyond ``SPOOLED_BYTES`` to its disk, and hands them to the transport piece by piece, again
    from the start for a retry. So memory does not bound the size of a batch. A task that is
    run again, or twice by speculation, sends again: the file name is the receiver's key for
    repeats. Write the result once and read that, as each evaluation sends.
    """
    tasks = tasks or int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = build_payloads(batches, part_rows, ["batch_no"])
    return send_payloads(deal_payloads(parts, tasks), transport, tokens, max_attempts, wait)


def deal_payloads(parts: DataFrame, tasks: int) -> DataFrame:
    """Payload parts with their ``batch_no``, dealt to ``tasks`` tasks, a file to one of them."""
    # Batches are dealt to the tasks in turn, as hashing would give some tasks many more.
    return parts.repartitionById(tasks, F.pmod("batch_no", F.lit(tasks)).cast("int"))


def send_payloads(
    dealt: DataFrame,
    transport: Transport,
    tokens: TokenSource,
    max_attempts: int = S.SEND_ATTEMPTS,
    wait: Callable[[int], float] = backoff_seconds,
) -> DataFrame:
    """Send payload parts that are dealt already, each task the files it has; a row per attempt."""
    parts = dealt.sortWithinPartitions("batch_no", "DATA_C_FILENAME", S.CODE, "part_no").select(
        "DATA_C_FILENAME", "payload"
    )

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Tokens(tokens, wait)

        def rows() -> Iterator[tuple[str, str]]:
            for frame in frames:
                yield from zip(frame["DATA_C_FILENAME"], frame["payload"], strict=True)

        def flush(file_name: str, spool: tempfile.SpooledTemporaryFile) -> pd.DataFrame:
            def pieces() -> Iterator[str]:
                spool.seek(0)
                yield from iter(lambda: spool.read(_PIECE), "")

            attempts = _send_with_retry(file_name, pieces, known, transport, max_attempts, wait)
            spool.close()
            columns = ["filename", "attempt", "code", "api_response", "last"]
            frame = pd.DataFrame(attempts, columns=columns)
            frame["code"] = frame["code"].astype("Int32")
            return frame

        current: str | None = None
        spool = None
        for file_name, part in rows():
            if file_name != current:
                if spool is not None:
                    yield flush(current, spool)
                current = file_name
                spool = tempfile.SpooledTemporaryFile(
                    SPOOLED_BYTES, "w+", encoding="utf-8", newline=""
                )
                spool.write(f"{HEADER}\n")
            spool.write(f"{part}\n")
        if spool is not None:
            yield flush(current, spool)

    # No retry follows a refusal that decides.
    refused = F.col("last") & (F.col("code") == _UNAUTHORISED)
    return parts.mapInPandas(send, _SENT_SCHEMA).select(
        "filename",
        "attempt",
        F.when(refused, "error").otherwise(classify_response(F.col("code"))).alias("status"),
        F.col("code").cast("string").alias("status_code"),
        "api_response",
    )


def latest_attempt(
    attempts: DataFrame, file: str = "filename", order: Sequence[str] = ("attempt",)
) -> DataFrame:
    """The last attempt of each file decides its outcome."""
    rest = [c for c in attempts.columns if c != file]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return attempts.groupBy(file).agg(last.alias("_last")).select(file, "_last.*")


def dispatch_report(manifest: DataFrame, latest: DataFrame) -> DataFrame:
    """One outcome per manifest row; a file without any attempt shows as ``not_sent``."""
    outcome = latest.select(
        F.col("filename").alias("DATA_C_FILENAME"), "status", "status_code", "api_response"
    )
    return manifest.join(outcome, "DATA_C_FILENAME", "left").withColumn(
        "status", F.coalesce(F.col("status"), F.lit("not_sent"))
    )


def response_log(report: DataFrame, transaction_id: str) -> DataFrame:
    return report.select(
        F.lit(transaction_id).alias("TRANSACTION_ID"),
        "DATA_C_FILENAME",
        response_json(F.col("status"), F.col("status_code"), F.col("api_response")).alias(
            "DATA_C_RESPONSE"
        ),
    )


def parse_responses(log: DataFrame) -> DataFrame:
    """Status and code read back from the logged JSON text."""
    parsed = F.from_json("DATA_C_RESPONSE", "status string, status_code string")
    return log.select("TRANSACTION_ID", "DATA_C_FILENAME", parsed.alias("_r")).select(
        "TRANSACTION_ID", "DATA_C_FILENAME", "_r.status", "_r.status_code"
    )
