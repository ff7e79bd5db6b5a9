"""Times the headline queries on the tables in BENCH_SF_DIR; prints one JSON line.

``BENCH_NAIVE=1`` times a plain form of the primary run instead: the steps one after another as
outer joins, evaluated anew for the log, the batches and the staging, and one write per batch.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sendgate import schemas as S
from sendgate.fixtures import BUSINESS, RUN_DATE, STEP, Roles
from sendgate.queries import QUERIES
from sendgate.session import local_session, new_path

HEADLINE = [
    "due_normalised",
    "due_from_csv",
    "step_overdue",
    "step_overdue_fanout",
    "capped_keys",
    "cascade_status",
    "funnel_counts",
    "funnel_json",
    "eligible_only",
    "batch_assign",
    "batch_balanced",
    "batch_manifest",
    "status_roundtrip",
    "batches_roundtrip",
    "payload_digest",
    "latest_attempt",
    "response_log",
    "dispatch_fake_transport",
    "kpi_log",
    "primary_run",
]


def naive_primary(spark: SparkSession, sf_dir: str) -> None:
    """File in, batches out, without sharing any work between the parts."""
    r = Roles(spark, sf_dir)
    path = new_path(spark, "naive")
    r.due_raw.write.option("header", True).csv(f"{path}/due")

    def labelled() -> DataFrame:
        raw = spark.read.option("header", True).csv(f"{path}/due")
        due = raw.select(
            F.trim("LOAN_OVERVIEW_APPL_ID").cast("long").alias(S.APPL_ID),
            F.col("LOAN_OVERVIEW_IMEI").cast("double").cast("long").cast("string").alias(S.IMEI),
            S.CODE,
        )
        loans = r.loans.where("BUCKET > 0 and INSTALLMENT_OVERDUE > 0").select(S.APPL_ID).distinct()
        day = r.history.where(F.col("run_date") == F.lit(RUN_DATE)).where("IMEI is not null")
        sent = day.where(F.col("business") == BUSINESS).select(S.IMEI).distinct()
        capped = day.groupBy(S.IMEI).count().where("count >= 3").select(S.IMEI)
        for keys, on, name in ((loans, S.APPL_ID, "a"), (sent, S.IMEI, "b"), (capped, S.IMEI, "c")):
            due = due.join(keys.withColumn(name, F.lit(1)), on, "left")
        status = (
            F.when(F.col(S.IMEI).isNull(), S.NULL)
            .when(F.col("a") == 1, S.DELINQUENT)
            .when(F.col("b") == 1, S.DUPLICATE_BIZ)
            .when(F.col("c") == 1, S.DUPLICATE_GLOBAL)
            .otherwise(S.UNIQUE_GLOBAL)
        )
        return due.select(S.APPL_ID, S.IMEI, S.CODE, status.alias(S.FILTER_STATUS))

    labelled().write.parquet(f"{path}/status")
    labelled().groupBy(S.FILTER_STATUS).count().collect()
    order = Window.partitionBy(S.CODE).orderBy(S.APPL_ID, S.IMEI)
    kept = labelled().where(F.col(S.FILTER_STATUS) == S.UNIQUE_GLOBAL)
    numbered = kept.withColumn("row_no", F.row_number().over(order))
    batches = -(-(numbered.agg(F.max("row_no")).first()[0] or 0) // STEP)
    for number in range(batches):
        rows = numbered.where((F.col("row_no") - 1).between(number * STEP, (number + 1) * STEP - 1))
        rows.withColumn(S.TRIGGER_ID, F.expr("uuid()")).write.parquet(f"{path}/batch={number}")


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    if name == "naive_primary":
        naive_primary(spark, sf_dir)
    else:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    if os.environ.get("BENCH_NAIVE"):
        names = ["naive_primary", "primary_run"]
    spark = local_session("bench", cpus)
    # One untimed query starts the executors and compiles common code.
    run(spark, sf_dir, "funnel_counts")
    times = {
        name: round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        for name in names
    }
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
