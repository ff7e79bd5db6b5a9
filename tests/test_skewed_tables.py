"""Queries against their SQL where a third of the rows share a key and a third are copies."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from sendgate.operators import batching, skew
from tests.test_queries import TABLES, rows_of

ROWS = 6_000

QUERIES = [
    "due_normalised", "step_overdue", "step_overdue_fanout", "step_business", "step_global_cap",
    "cascade_status", "cascade_shuffled", "cascade_fanout", "funnel_fanout", "cap_with_audit",
    "eligible_only", "eligible_only_shuffled", "init_log", "batch_assign", "batch_balanced",
    "batch_manifest", "trigger_ids", "batches_roundtrip", "payload_digest", "latest_attempt",
    "response_log", "dispatch_fake_transport", "primary_run", "bulk_run",
]


def pick(n, seed):
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n))


def one_of(words, seed):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (pick(len(words), seed) + 1).cast("int"))


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    kind = F.col("id") % 3
    codes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    spark.range(ROWS).select(
        F.when(kind == 2, 5).otherwise(F.col("id")).alias("o_orderkey"),
        F.when(kind == 2, 123).when(kind == 1, 77).otherwise(pick(900, 1)).alias("o_custkey"),
        F.when(kind == 2, "5-LOW").otherwise(one_of(codes, 2)).alias("o_orderpriority"),
    ).repartition(3).write.parquet(f"{folder}/orders.parquet")
    spark.range(ROWS).select(
        F.when(kind == 0, 7).otherwise(pick(ROWS, 3) + 6).alias("l_orderkey"),
        (pick(50, 4) + 1).cast("double").alias("l_quantity"),
        one_of(["A", "N", "R"], 5).alias("l_returnflag"),
    ).repartition(3).write.parquet(f"{folder}/lineitem.parquet")
    day = F.date_add(F.lit("2024-01-01").cast("date"), pick(4, 6).cast("int"))
    spark.range(ROWS).select(
        F.col("id").alias("event_id"),
        F.when(kind == 0, F.lit("2024-01-02").cast("date")).otherwise(day).cast("timestamp_ntz").alias("ts"),
        F.when(kind == 0, 234).otherwise(pick(400, 7)).cast("long").alias("user_id"),
        one_of(["view", "purchase", "click", "signup", "error"], 8).alias("event_type"),
        F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"),
    ).repartition(3).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(skewed_dir):
    connection = duckdb.connect()
    for name in TABLES:
        files = f"{skewed_dir}/{name}.parquet/*.parquet"
        connection.execute(f"create view {name} as select * from read_parquet('{files}')")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_query_matches_sql(spark, duck, skewed_dir, monkeypatch, name):
    # Blocks small enough that the hot groups span many, and key tables too large to broadcast.
    defaults = batching.number_rows.__defaults__
    monkeypatch.setattr(batching.number_rows, "__defaults__", (*defaults[:-2], 300, None))
    monkeypatch.setattr(skew.match_keys, "__defaults__", (None, 100))
    frame = entry_point.queries()[name](spark, skewed_dir)
    got = frame.collect()
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = result.fetchall()
    assert len(got) == len(expected) > 0
    assert rows_of(frame.columns, got) == rows_of(columns, expected)
