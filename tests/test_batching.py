import datetime as dt
from collections import Counter

import pytest

from sendgate.operators import batching
from tests import brute


@pytest.fixture(autouse=True, params=[batching.ROWS_PER_BLOCK, 4])
def block_size(request, monkeypatch):
    """Every test with one block and with many."""
    defaults = batching.number_rows.__defaults__
    monkeypatch.setattr(batching.number_rows, "__defaults__", (*defaults[:-1], request.param))

COLUMNS = "APPL_ID bigint, IMEI string, Notification_Code string"


def frame(spark, sizes, partitions=3):
    rows = [(i, f"{code}{i}", code) for code, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS).repartition(partitions), rows


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def test_batches_of_codes_of_all_sizes(spark):
    df, rows = frame(spark, {"A": 0, "B": 1, "C": 2, "D": 3, "E": 5})
    got = batching.assign_batches(df, 2)
    assert bag(got) == Counter(brute.numbered(rows, 2))
    sizes = Counter((row["Notification_Code"], row["batch_no"]) for row in got.collect())
    assert max(sizes.values()) <= 2
    assert {row["batch_no"] for row in got.collect()} == {0, 1, 2}


def test_balanced_batches(spark):
    df, rows = frame(spark, {"B": 1, "C": 2, "D": 3, "E": 5})
    got = batching.assign_batches_balanced(df, 4)
    assert bag(got) == Counter(brute.numbered(rows, 4, per_code=False))
    assert Counter(row["batch_no"] for row in got.collect()) == {0: 4, 1: 4, 2: 3}


def test_copies_and_missing_values_are_numbered(spark):
    rows = [(1, "a", "N")] * 7 + [(None, "b", "N"), (2, "c", None), (3, "d", None), (1, "a", None)]
    got = batching.assign_batches(spark.createDataFrame(rows, COLUMNS).repartition(5), 3)
    assert bag(got) == Counter(brute.numbered(rows, 3))
    ids = [row["TriggerID"] for row in batching.add_trigger_ids(got, "run").collect()]
    assert len(set(ids)) == len(rows)


def test_no_rows(spark):
    got = batching.assign_batches(spark.createDataFrame([], COLUMNS), 3)
    assert got.collect() == []


def test_trigger_ids_are_stable_whatever_the_layout(spark):
    once, _ = frame(spark, {"A": 40, "B": 25}, partitions=2)
    again, _ = frame(spark, {"A": 40, "B": 25}, partitions=7)
    first, second = (
        bag(batching.add_trigger_ids(batching.assign_batches(df, 10), "run")) for df in (once, again)
    )
    assert first == second and len(first) == 65
    other = bag(batching.add_trigger_ids(batching.assign_batches(once, 10), "next"))
    assert not {r[-1] for r in other} & {r[-1] for r in first}


def test_slice_and_manifest(spark):
    df, rows = frame(spark, {"A": 5, "B": 2})
    named = batching.name_batches(
        batching.assign_batches(df, 2), "20240102030405", dt.date(2024, 1, 2), "CD"
    )
    manifest = {r["batch_no"]: (r[1], r[2]) for r in batching.batch_manifest(named).collect()}
    assert manifest == {
        k: (f"/2024/01/02/CD/DCNOTIF_20240102030405_{k}_REQ.csv", n) for k, n in ((0, 4), (1, 2), (2, 1))
    }
    assert batching.batch_slice(named, 1).count() == 2
    assert sum(n for _, n in manifest.values()) == len(rows)


@pytest.mark.parametrize("limit", [0, 10])
def test_shifts_are_joined_alike_with_and_without_broadcast(spark, monkeypatch, limit):
    from sendgate import session

    monkeypatch.setattr(session.broadcast_if_small, "__defaults__", (limit,))
    df, rows = frame(spark, {"A": 30, "B": 11})
    assert bag(batching.assign_batches(df, 7)) == Counter(brute.numbered(rows, 7))
