"""The eligibility cascade: each row is kept or labelled with the first reason against it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from sendgate import schemas as S
from sendgate.functions.scalars import imei_of, whole_number
from sendgate.operators.batching import number_rows
from sendgate.operators.skew import KeyTable, match_keys
from sendgate.session import keep

_MATCHES = "_matches"
_BIZ = "_biz"
_CAPPED = "_capped"
_RANK = "_rank"
_SENT = "_sent"


def normalise_due(raw: DataFrame) -> DataFrame:
    """Rename the raw columns, make the ids exact whole numbers, drop everything else."""
    return raw.withColumnsRenamed(S.DUE_RENAMES).select(
        whole_number(F.col(S.APPL_ID)).alias(S.APPL_ID),
        imei_of(F.col(S.IMEI)).alias(S.IMEI),
        F.col(S.CODE).cast("string").alias(S.CODE),
    )


def overdue_keys(loans: DataFrame) -> DataFrame:
    """Ids of loans with an overdue instalment, one row per overdue record."""
    return loans.where((F.col("BUCKET") > 0) & (F.col("INSTALLMENT_OVERDUE") > 0)).select(
        S.APPL_ID
    )


def flag_null_key(df: DataFrame, key: str = S.IMEI) -> DataFrame:
    return df.withColumn(
        S.FILTER_STATUS,
        F.when(F.col(key).isNull(), F.lit(S.NULL)).otherwise(F.lit(S.NOT_NULL)),
    )


def relabel(matched: Column, hit: str, miss: str, frozen: Sequence[str]) -> Column:
    """The status after one step. A frozen or missing status stays as it is."""
    status = F.col(S.FILTER_STATUS)
    return (
        F.when(status.isNull() | status.isin(list(frozen)), status)
        .when(matched, F.lit(hit))
        .otherwise(F.lit(miss))
    )


def status_step(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    hit: str,
    miss: str,
    frozen: Sequence[str],
    dedupe_keys: bool = True,
    **join: Any,
) -> DataFrame:
    """Label rows by whether their ``on`` value is among ``keys``; all columns are kept.

    The keys are counted down to one row each before the join, so no row is repeated. With
    ``dedupe_keys=False`` the column ``copies`` tells how often an outer join with the keys as
    they are would repeat it: the repeats are counted, never made, as a loan with many
    records would multiply all of its rows. The key table is written while the plan is built.
    ``join`` holds options for ``match_keys``.
    """
    joined = match_keys(df, [_counted(keys, on)], "left", **join)
    status = relabel(F.col(_MATCHES).isNotNull(), hit, miss, frozen).alias(S.FILTER_STATUS)
    columns = [c for c in df.columns if c != S.FILTER_STATUS]
    if dedupe_keys:
        return joined.select(*columns, status)
    return joined.select(*columns, status, _copies())


def _counted(keys: DataFrame, on: str) -> KeyTable:
    return KeyTable(on, keys, lambda rows: rows.groupBy(on).agg(F.count("*").alias(_MATCHES)))


def _copies() -> Column:
    """How often an outer join with every matching record would repeat the row."""
    return F.coalesce(F.col(_MATCHES), F.lit(1)).alias(S.COPIES)


def step_overdue(
    df: DataFrame, overdue: DataFrame, dedupe_keys: bool = True, **join: Any
) -> DataFrame:
    return status_step(
        df, overdue, S.APPL_ID, S.DELINQUENT, S.NOT_DELINQUENT, [S.NULL], dedupe_keys, **join
    )


def day_of(history: DataFrame, run_date: dt.date, exclude: str | None = None) -> DataFrame:
    """History of one day, without the rows of transaction ``exclude``."""
    day = history.where(F.col("run_date") == F.lit(run_date))
    if exclude is None:
        return day
    return day.where(~F.col("transaction_id").eqNullSafe(F.lit(exclude)))


def business_keys(history: DataFrame, run_date: dt.date, business: str) -> DataFrame:
    """Distinct keys this business has already contacted on ``run_date``."""
    day = day_of(history, run_date).where(F.col("business") == business)
    return day.where(F.col(S.IMEI).isNotNull()).select(S.IMEI).distinct()


def capped_keys(
    history: DataFrame,
    run_date: dt.date,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
) -> DataFrame:
    """Keys contacted at least ``cap`` times on ``run_date``, with the count."""
    rows = day_of(history, run_date).select(S.IMEI)
    if include_audit is not None:
        rows = rows.unionByName(day_of(include_audit, run_date).select(S.IMEI))
    counts = rows.where(F.col(S.IMEI).isNotNull()).groupBy(S.IMEI).count()
    return counts.where(F.col("count") >= cap)


def step_business(
    df: DataFrame, history: DataFrame, run_date: dt.date, business: str, **join: Any
) -> DataFrame:
    return status_step(
        df,
        business_keys(history, run_date, business),
        S.IMEI,
        S.DUPLICATE_BIZ,
        S.UNIQUE_BIZ,
        [S.NULL, S.DELINQUENT],
        **join,
    )


def step_global_cap(
    df: DataFrame,
    history: DataFrame,
    run_date: dt.date,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
    **join: Any,
) -> DataFrame:
    return status_step(
        df,
        capped_keys(history, run_date, cap, include_audit),
        S.IMEI,
        S.DUPLICATE_GLOBAL,
        S.UNIQUE_GLOBAL,
        [S.NULL, S.DELINQUENT, S.DUPLICATE_BIZ],
        **join,
    )


def contacts_of_day(
    history: DataFrame,
    run_date: dt.date,
    business: str,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
    exclude: str | None = None,
) -> KeyTable:
    """Both history questions in one aggregation: the keys either history step would stop."""
    by_business = F.col("business") == business
    rows = day_of(history, run_date, exclude).select(S.IMEI, by_business.alias(_BIZ))
    if include_audit is not None:
        audit = day_of(include_audit, run_date, exclude)
        rows = rows.unionByName(audit.select(S.IMEI, F.lit(False).alias(_BIZ)))

    def summary(rows: DataFrame) -> DataFrame:
        per_key = rows.groupBy(S.IMEI).agg(
            F.coalesce(F.max(_BIZ), F.lit(False)).alias(_BIZ),
            (F.count("*") >= cap).alias(_CAPPED),
        )
        return per_key.where(F.col(_BIZ) | F.col(_CAPPED))

    return KeyTable(S.IMEI, rows, summary)


def eligibility_cascade(
    due: DataFrame,
    overdue: DataFrame,
    history: DataFrame,
    run_date: dt.date,
    business: str,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
    dedupe_keys: bool = True,
    exclude: str | None = None,
    rows: int | None = None,
    **join: Any,
) -> DataFrame:
    """All steps at once: ``due`` with the final status of every row.

    Gives what the steps give one after another, but reads the history once and joins it
    once. ``due`` has to be a scan or a written table; it is counted at once unless ``rows``
    says its size. If it is large, the key tables are written while the plan is built.
    ``join`` holds options for ``match_keys``.
    """
    contacts = contacts_of_day(history, run_date, business, cap, include_audit, exclude)
    tables = [_counted(overdue, S.APPL_ID), contacts]
    joined = match_keys(due, tables, "left", due.count() if rows is None else rows, **join)
    status = (
        F.when(F.col(S.IMEI).isNull(), S.NULL)
        .when(F.col(_MATCHES).isNotNull(), S.DELINQUENT)
        .when(F.col(_BIZ), S.DUPLICATE_BIZ)
        .when(F.col(_CAPPED), S.DUPLICATE_GLOBAL)
        .otherwise(S.UNIQUE_GLOBAL)
    )
    labelled = [*due.columns, status.alias(S.FILTER_STATUS)]
    return joined.select(*labelled if dedupe_keys else [*labelled, _copies()])


def cascade_over_parts(
    due: DataFrame,
    overdue: DataFrame,
    parts: Sequence[DataFrame],
    business: str,
    cap: int = S.DAILY_CAP,
    rows: int | None = None,
    **join: Any,
) -> DataFrame:
    """``eligibility_cascade`` over a day that is given in parts of ``schemas.SENT`` rows.

    Each part is aggregated and joined by itself, so that one that is bucketed by key is read
    as it lies; the counts of all parts are added up per row of ``due``.
    """

    def counted(part: DataFrame, i: int) -> KeyTable:
        by_business = F.coalesce(F.max(F.col("business") == business), F.lit(False))
        aggregates = [by_business.alias(f"{_BIZ}{i}"), F.sum("sent").alias(f"{_SENT}{i}")]
        return KeyTable(S.IMEI, part, lambda found: found.groupBy(S.IMEI).agg(*aggregates))

    tables = [_counted(overdue, S.APPL_ID), *[counted(part, i) for i, part in enumerate(parts)]]
    joined = match_keys(due, tables, "left", due.count() if rows is None else rows, **join)
    by_biz, sent = F.lit(False), F.lit(0)
    for i in range(len(parts)):
        by_biz = by_biz | F.coalesce(F.col(f"{_BIZ}{i}"), F.lit(False))
        sent = sent + F.coalesce(F.col(f"{_SENT}{i}"), F.lit(0))
    status = (
        F.when(F.col(S.IMEI).isNull(), S.NULL)
        .when(F.col(_MATCHES).isNotNull(), S.DELINQUENT)
        .when(by_biz, S.DUPLICATE_BIZ)
        .when(sent >= cap, S.DUPLICATE_GLOBAL)
        .otherwise(S.UNIQUE_GLOBAL)
    )
    return joined.select(*due.columns, status.alias(S.FILTER_STATUS))


def cap_within_file(
    status: DataFrame,
    history: DataFrame,
    run_date: dt.date,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
    exclude: str | None = None,
    settled: bool = False,
    rows: int | None = None,
    **join: Any,
) -> DataFrame:
    """``status`` with the cap kept inside the file as well, not only between files.

    Each key has a running quota: what was sent earlier in the day, then the file's eligible rows
    of that key one by one, in the order of loan id and code. Rows beyond ``cap`` become
    ``DUPLICATE_GLOBAL``. The ranks come from the block numbering, so a hot key, or one with very
    many copies, is never one task. ``settled`` says that ``status`` is a scan or a written table,
    ``rows`` how many eligible rows it has; ``join`` holds options for ``match_keys``.
    """
    status = status if settled else keep(status, "status")
    open_ = F.col(S.FILTER_STATUS) == S.UNIQUE_GLOBAL
    order = [S.APPL_ID, S.CODE]
    ranked = number_rows(status.where(open_), [S.IMEI], order, _RANK, settled=True, rows=rows)
    sent = day_of(history, run_date, exclude).select(S.IMEI)
    if include_audit is not None:
        sent = sent.unionByName(day_of(include_audit, run_date, exclude).select(S.IMEI))
    table = KeyTable(S.IMEI, sent, lambda found: found.groupBy(S.IMEI).agg(F.count("*").alias(_SENT)))
    joined = match_keys(ranked, [table], "left", **join)
    over = F.col(_RANK) + F.coalesce(_SENT, F.lit(0)) > cap
    label = F.when(over, S.DUPLICATE_GLOBAL).otherwise(S.UNIQUE_GLOBAL)
    capped = joined.select(
        *[label.alias(c) if c == S.FILTER_STATUS else F.col(c) for c in status.columns]
    )
    # A row without a status is not eligible either.
    return status.where(~F.coalesce(open_, F.lit(False))).unionByName(capped)


def eligible(status: DataFrame) -> DataFrame:
    return status.where(F.col(S.FILTER_STATUS) == S.UNIQUE_GLOBAL).drop(S.FILTER_STATUS)


def eligible_only(
    due: DataFrame,
    overdue: DataFrame,
    history: DataFrame,
    run_date: dt.date,
    business: str,
    cap: int = S.DAILY_CAP,
    include_audit: DataFrame | None = None,
    exclude: str | None = None,
    rows: int | None = None,
    **join: Any,
) -> DataFrame:
    """The eligible rows alone, by anti joins, for runs that need no status of the others.

    Like ``eligibility_cascade``, it counts ``due`` unless ``rows`` says its size.
    """
    contacts = contacts_of_day(history, run_date, business, cap, include_audit, exclude)
    keyed = due.where(F.col(S.IMEI).isNotNull())
    tables = [_counted(overdue, S.APPL_ID), contacts]
    kept = match_keys(keyed, tables, "left_anti", due.count() if rows is None else rows, **join)
    return kept.select(*due.columns)
