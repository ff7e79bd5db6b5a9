import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from sendgate.operators import batching, skew, status as st
from sendgate.operators.funnel import funnel_counts
from sendgate.session import is_small, keep
from tests.test_status import DAY, HISTORY


@contextlib.contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


SHUFFLED = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


def share_of_largest(frame):
    """Part of all rows that the fullest partition holds."""
    sizes = [row["count"] for row in frame.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def skewed_due(spark, rows=30_000):
    """A third has no device, a third has one device, a third are copies of a single row."""
    n = F.col("id")
    kind = n % 3
    return skew_table(
        spark.range(rows).select(
            F.when(kind == 2, 77).otherwise(n).alias("APPL_ID"),
            F.when(kind == 1, "hot").when(kind == 2, "copy").alias("IMEI"),
            F.lit("N1").alias("Notification_Code"),
        )
    )


def skew_table(frame):
    return frame.repartition(4)


# What Spark's skew join does beyond 256 MB, at the size of these tables.
SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200b",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def spread_over(frame):
    """The part of all rows in the fullest task, with the plan that ran."""
    counted = frame.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("count"), F.max("APPL_ID"), F.max("FILTER_STATUS")
    )
    sizes = [row["count"] for row in counted.collect()]
    return max(sizes) / sum(sizes), counted._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", ["missing", "hot", "copies", "many hot keys", "small hot key"])
def test_skew_join_splits_what_meets_under_one_key(spark, key):
    """No list of hot keys is needed: rows need no marked position, and no key is missed."""
    n = F.col("id")
    imei = {
        "missing": F.when(n % 2 == 0, F.concat(F.lit("k"), n)),
        "hot": F.when(n % 2 == 0, F.concat(F.lit("k"), n)).otherwise("hot"),
        "copies": F.when(n >= 0, "copy"),
        "many hot keys": F.concat(F.lit("k"), n % 3_000),
        "small hot key": F.when(n % 4_000 == 0, "small").otherwise(F.concat(F.lit("k"), n)),
    }[key]
    appl = F.when(n >= 0, 1).cast("long") if key == "copies" else n
    rows = spark.range(400_000 if key == "small hot key" else 40_000).repartition(32)
    due = rows.select(appl.alias("APPL_ID"), imei.alias("IMEI"), F.lit("N").alias("c"))
    history = spark.createDataFrame([("hot",), ("copy",), ("k2",), ("small",)], "IMEI string")
    with settings(spark, **SKEW):
        got = st.status_step(
            st.flag_null_key(due), history, "IMEI", "HIT", "MISS", [], max_broadcast=0
        )
        share, plan = spread_over(got)
        assert share < 0.1
        assert "SortMergeJoin" in plan
        if key in ("missing", "hot", "copies"):
            assert "skew=true" in plan


def test_numbering_spreads_one_code_and_copies(spark):
    with settings(spark, **SHUFFLED):
        due = skewed_due(spark)
        got = batching.number_rows(due, ["Notification_Code"], rows_per_block=2_000)
        placed = spark.read.parquet(*[f for f in got.inputFiles() if "/placed-" in f])
        blocks = [r["count"] for r in placed.groupBy("_block").count().collect()]
        assert len(blocks) >= 12 and max(blocks) < 30_000 / 8
        numbers = got.agg(F.min("row_no"), F.max("row_no"), F.countDistinct("row_no")).first()
        assert tuple(numbers) == (1, 30_000, 30_000)


def test_fanout_of_a_hot_loan_is_counted_not_made(spark):
    loans = spark.range(5_000).select(F.lit(1).cast("long").alias("APPL_ID"))
    due = st.flag_null_key(
        spark.createDataFrame(
            [(1, "1", "N")] * 3 + [(2, "2", "N")], "APPL_ID long, IMEI string, c string"
        )
    )
    got = st.step_overdue(due, loans, dedupe_keys=False)
    counts = {tuple(r) for r in got.groupBy("APPL_ID", "FILTER_STATUS", "copies").count().collect()}
    assert counts == {(1, "DELINQUENT", 5_000, 3), (2, "NOT_DELINQUENT", 1, 1)}
    funnel = {tuple(r) for r in funnel_counts(got).collect()}
    assert funnel == {("DELINQUENT", 15_000), ("NOT_DELINQUENT", 1)}


def test_cascade_plan(spark):
    due = spark.createDataFrame(
        [(1, "1", "N"), (2, "2", "N")], "APPL_ID long, IMEI string, Notification_Code string"
    )
    overdue = spark.createDataFrame([(1,)], "APPL_ID long")
    history = spark.createDataFrame([("1", "CD", DAY, "t")], HISTORY)
    args = (due, overdue, history, DAY, "CD")

    def plans(limit):
        with settings(spark, **SHUFFLED):
            status = plan_of(st.eligibility_cascade(*args, max_broadcast=limit))
            only = plan_of(st.eligible_only(*args, max_broadcast=limit))
        for text in (status, only):
            assert not re.search("Python|Cartesian|NestedLoop|Window", text)
        return (status, "LeftOuter"), (only, "LeftAnti")

    def count(pattern, text):
        return len(re.findall(pattern, text))

    # Both key tables beyond the limit: one shuffle per side and join.
    for text, kind in plans(0):
        assert count(f"SortMergeJoin .*{kind}", text) == 2
        assert count("Exchange hashpartitioning", text) == 4
    # Key tables within it: the rows are not shuffled.
    for text, kind in plans(1):
        assert count(f"BroadcastHashJoin .*{kind}", text) == 2
        assert count("Exchange hashpartitioning", text) == 0
    # Few rows: only the keys asked for reach the aggregations of the other side.
    for text, kind in plans(2):
        assert count(f"BroadcastHashJoin .*{kind}", text) == 2
        assert "SortMergeJoin" not in text
        assert count("HashAggregate.*\\n.*(Project.*\\n.*)?BroadcastHashJoin.*LeftSemi", text) == 2


@pytest.mark.parametrize("max_broadcast", [0, 2_000_000])
def test_keys_not_asked_for_are_never_aggregated(spark, max_broadcast):
    """Two million candidates: the other side is cut down below its aggregation."""
    asked = skew.broadcast_if_small(
        keep(spark.range(2_000_000).select(F.col("id").alias("APPL_ID")), "asked"), max_broadcast
    )
    loans = spark.range(3_000_000).select((F.col("id") % 2_500_000).alias("APPL_ID"))
    with settings(spark, **{**SHUFFLED, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        keys = st._counted(loans, "APPL_ID").keys(asked)
        plan = plan_of(keys)
        lines = [i for i, line in enumerate(plan.splitlines()) if "HashAggregate" in line]
        semi = next(i for i, line in enumerate(plan.splitlines()) if "LeftSemi" in line)
        assert lines and max(lines) < semi
        assert keys.count() == 2_000_000


def test_long_keys_are_not_broadcast(spark):
    """Few rows whose keys are long texts: the size in bytes decides."""
    due = spark.range(300).select(F.expr("repeat('x', 300000) || id").alias("IMEI"))
    assert not is_small(due, 1_000)
    assert is_small(due.select(F.substr("IMEI", F.lit(1), F.lit(10))), 1_000)


def test_scan_reads_only_what_is_needed(spark):
    from sendgate.fixtures import Roles

    plan = plan_of(st.overdue_keys(Roles(spark, "/root/testdata/sf0.001").loans))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_quantity", "l_returnflag"}
