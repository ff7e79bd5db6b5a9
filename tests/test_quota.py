"""The cap inside a file: a running quota per key."""

import datetime as dt
import random
from collections import Counter

import pytest

from sendgate import schemas as S
from sendgate.operators import batching
from sendgate.operators.status import cap_within_file
from tests.brute import nulls_first

DAY = dt.date(2024, 1, 2)
STATUS = "APPL_ID bigint, IMEI string, Notification_Code string, FILTER_STATUS string"
HISTORY = "IMEI string, run_date date, business string, transaction_id string"


def brute(rows, sent, cap):
    counts, found = Counter(sent), []
    for row in sorted(rows, key=nulls_first):
        appl, imei, code, status = row
        if status == S.UNIQUE_GLOBAL:
            counts[imei] += 1
            if counts[imei] > cap:
                status = S.DUPLICATE_GLOBAL
        found.append((appl, imei, code, status))
    return sorted(found, key=str)


def capped(spark, rows, sent, cap, **options):
    history = [(imei, DAY, "AB", "T0") for imei in sent] + [("k1", DAY - dt.timedelta(1), "AB", "T0")] * 5
    history += [("k1", DAY, "AB", "MINE")] * 5 + [(None, DAY, "AB", "T0")] * 5
    got = cap_within_file(
        spark.createDataFrame(rows, STATUS).repartition(3), spark.createDataFrame(history, HISTORY), DAY, cap,
        exclude="MINE", **options,
    )
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}])
def test_running_quota(spark, options):
    draw = random.Random(1)
    labels = [S.UNIQUE_GLOBAL] * 4 + [S.DELINQUENT, S.NULL, S.DUPLICATE_BIZ, None]
    rows = []
    for i in range(300):
        label = draw.choice(labels)
        key = None if label == S.NULL else f"k{draw.randrange(40)}"
        rows.append((draw.choice([i, None, 7]), key, draw.choice(["N1", "N2", None]), label))
    sent = [f"k{draw.randrange(40)}" for _ in range(50)]
    assert capped(spark, rows, sent, 3, **options) == brute(rows, sent, 3)


def test_copies_and_a_hot_key_over_many_blocks(spark, monkeypatch):
    """A third of all rows has one key; its quota runs on from block to block."""
    defaults = list(batching.number_rows.__defaults__)
    at = defaults.index(batching.ROWS_PER_BLOCK)
    defaults[at] = 16
    monkeypatch.setattr(batching.number_rows, "__defaults__", tuple(defaults))
    rows = [(i, "hot", "N1", S.UNIQUE_GLOBAL) for i in range(100)] + [(1, "copy", "N1", S.UNIQUE_GLOBAL)] * 100
    rows += [(i, f"k{i}", "N1", S.UNIQUE_GLOBAL) for i in range(100)]
    got = capped(spark, rows, ["hot"] * 2 + ["k3"] * 90, 90)
    assert got == brute(rows, ["hot"] * 2 + ["k3"] * 90, 90)
    kept = Counter(r[1] for r in got if r[3] == S.UNIQUE_GLOBAL)
    assert (kept["hot"], kept["copy"], kept["k3"], kept["k4"]) == (88, 90, 0, 1)


def test_no_rows(spark):
    assert capped(spark, [], [], 3) == []
    assert capped(spark, [(1, None, "N", S.NULL)], [], 0) == [(1, None, "N", S.NULL)]
