"""Counts of where rows were stopped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sendgate import schemas as S


def funnel_counts(status: DataFrame) -> DataFrame:
    """Rows per status; a row with ``copies`` counts that often."""
    rows = F.sum(S.COPIES) if S.COPIES in status.columns else F.count("*")
    return status.groupBy(S.FILTER_STATUS).agg(rows.alias("count"))


def _as_json(counts: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(counts)))


def funnel_json(status: DataFrame) -> DataFrame:
    """One row: the funnel as JSON text, keys in alphabetical order."""
    pair = F.struct(F.col(S.FILTER_STATUS), F.col("count"))
    return funnel_counts(status).agg(_as_json(F.collect_list(pair)).alias("TRANSFORMATIONS"))


def funnel_totals(status: DataFrame) -> DataFrame:
    """One row from one pass: rows in all, rows eligible and the funnel as JSON text."""
    pair = F.struct(F.col(S.FILTER_STATUS), F.col("count"))
    is_eligible = F.col(S.FILTER_STATUS) == S.UNIQUE_GLOBAL
    return funnel_counts(status).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("CG_COUNT"),
        _as_json(F.collect_list(pair)).alias("TRANSFORMATIONS"),
        F.coalesce(F.sum(F.when(is_eligible, F.col("count"))), F.lit(0)).alias("ELIGIBLE_COUNT"),
    )


def funnel_conservation(due: DataFrame, status: DataFrame) -> DataFrame:
    """Rows in against rows labelled; equal unless overdue records fan out."""
    rows_in = due.agg(F.count("*").alias("rows_in"))
    totals = funnel_totals(status).select(
        F.col("CG_COUNT").alias("rows_labelled"), F.col("ELIGIBLE_COUNT").alias("rows_eligible")
    )
    both = rows_in.unionByName(totals, allowMissingColumns=True)
    return both.agg(
        *[F.max(c).alias(c) for c in ("rows_in", "rows_labelled", "rows_eligible")]
    ).withColumn("conserved", F.col("rows_in") == F.col("rows_labelled"))
