"""Column expressions: identifiers, dates, names and JSON texts. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sendgate.schemas import APPL_ID, CODE, IMEI

# Formats of dates, times and batch file names.
RUN_DATE_FORMAT = "yyyy/MM/dd"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
STAMP_FORMAT = "yyyyMMddHHmmss"
FILE_PREFIX = "DCNOTIF_"
FILE_SUFFIX = "_REQ.csv"
IST_ZONE = "Asia/Kolkata"
# End of the fixed values.


def whole_number(text: Column) -> Column:
    """Text such as ``' 0356.0 '`` or ``'3.5E2'`` as an exact bigint, else null.

    A fraction is cut off. The way over decimal keeps all digits, unlike one over double.
    """
    return F.trim(text).try_cast("decimal(38,10)").try_cast("bigint")


def imei_of(text: Column) -> Column:
    return whole_number(text).cast("string")


def to_ist(ts: Column, instant: bool = False) -> Column:
    """UTC time as Indian Standard Time, which has no daylight saving.

    ``ts`` is a timestamp without time zone that holds UTC, or, with ``instant``, a timestamp
    with one, whatever the time zone of the session.
    """
    plain = ts.cast("timestamp_ntz")
    if instant:
        return F.convert_timezone(None, F.lit(IST_ZONE), plain)
    return F.convert_timezone(F.lit("UTC"), F.lit(IST_ZONE), plain)


def run_date_ist(ts: Column, instant: bool = False) -> Column:
    return F.date_format(to_ist(ts, instant), RUN_DATE_FORMAT)


def ist_text(ts: Column, instant: bool = False) -> Column:
    return F.date_format(to_ist(ts, instant), TIME_FORMAT)


def business_of(file_name: Column) -> Column:
    """Second ``_`` part of the file name; null when there is none."""
    part = F.split_part(F.trim(file_name), F.lit("_"), F.lit(2))
    return F.when(part != "", part)


def batch_file_name(stamp: Column, batch_no: Column) -> Column:
    """One name per batch: the batch number keeps batches of the same second apart."""
    return F.concat(
        F.lit(FILE_PREFIX), stamp, F.lit("_"), batch_no.cast("string"), F.lit(FILE_SUFFIX)
    )


def staged_path(run_date: Column, business: Column, file_name: Column) -> Column:
    return F.concat(
        F.lit("/"),
        F.concat_ws("/", F.date_format(run_date, RUN_DATE_FORMAT), business, file_name),
    )


def trigger_id(run_id: str) -> Column:
    """A stable id per numbered row.

    ``row_no`` is unique within its code, so copies of a row get different ids, and the same
    run gives the same ids again.
    """
    parts = [F.lit(run_id), F.col("row_no"), F.col(CODE), F.col(APPL_ID), F.col(IMEI)]
    return F.md5(
        F.concat_ws("|", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])
    )


def response_json(status: Column, status_code: Column, api_response: Column) -> Column:
    """The outcome as valid JSON; an API text that is no JSON is kept under ``raw``."""
    body = F.when(
        api_response.isNotNull(),
        F.coalesce(
            F.try_parse_json(api_response),
            F.to_variant_object(F.struct(api_response.alias("raw"))),
        ),
    )
    return F.to_json(
        F.struct(
            status.alias("status"), status_code.alias("status_code"), body.alias("api_response")
        ),
        {"ignoreNullFields": "false"},
    )
