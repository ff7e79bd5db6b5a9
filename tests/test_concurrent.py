"""Runs at the same time, and what readers see of a run before, while and after it is published."""

import datetime as dt
import threading
from collections import Counter

import pytest

from sendgate import schemas as S
from sendgate.operators.status import overdue_keys
from sendgate.plans import concurrent as P
from sendgate.plans.primary import Run
from sendgate.sources import commits as C
from tests.brute import status_of

START = dt.datetime(2024, 1, 1, 20, 0)
DAY = dt.date(2024, 1, 2)
HEADER = "LOAN_OVERVIEW_APPL_ID,LOAN_OVERVIEW_IMEI,Notification_Code"


@pytest.fixture
def overdue(spark):
    loans = [(2, 1, 5.0), (9, 1, 0.0)]
    return overdue_keys(spark.createDataFrame(loans, "APPL_ID bigint, BUCKET int, INSTALLMENT_OVERDUE double"))


def write_due(path, rows):
    lines = [",".join("" if v is None else str(v) for v in row) for row in rows]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def status_rows(spark, base, transaction):
    rows = C.read_published(spark, base, P.STATUS, S.STATUS, DAY).where(f"transaction_id = '{transaction}'")
    return sorted(((r.APPL_ID, r.IMEI, r.Notification_Code, r.FILTER_STATUS) for r in rows.collect()), key=str)


def serial(runs, order):
    """Statuses of the runs one after another; ``runs``: transaction to business and rows."""
    history, found = [], {}
    for transaction in order:
        business, due = runs[transaction]
        labelled = status_of(due, {2}, history, business)
        history += [(imei, business) for _, imei, _, status in labelled if status == S.UNIQUE_GLOBAL]
        found[transaction] = sorted(labelled, key=str)
    return found


def committed(spark, base):
    rows = C.current_commits(spark, base, DAY).orderBy("version").collect()
    return [r.transaction_id for r in rows]


def test_three_runs_race(spark, tmp_path, overdue):
    """All read the empty day, then commit at the same time: the result is that of one of their orders."""
    base = str(tmp_path / "published")
    keys = [str(100 + i) for i in range(8)]
    runs = {
        "T1": ("AB", [(i, key, "N1") for i, key in enumerate(keys, 3)] + [(2, "100", "N1"), (None, None, "N2")]),
        "T2": ("CD", [(i, key, "N2") for i, key in enumerate(keys[:6] * 2, 3)]),
        "T3": ("CD", [(i, key, "N1") for i, key in enumerate(keys[2:], 3)]),
    }
    ready = threading.Barrier(len(runs), timeout=120)
    tries, errors = Counter(), []

    def work(name):
        def meet(tried):
            tries[name] = tried + 1
            if not tried:
                ready.wait()

        business, rows = runs[name]
        try:
            due = write_due(tmp_path / f"{name}.csv", rows)
            P.run_concurrent(spark, due, overdue, base, Run(f"A_{business}_1.csv", name, START), step=3, before_commit=meet)
        except BaseException as error:
            errors.append(str(error)[:600])
            ready.abort()

    threads = [threading.Thread(target=work, args=(name,)) for name in runs]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(240)
    assert not errors, errors
    order = committed(spark, base)
    assert sorted(order) == sorted(runs)
    assert sum(tries.values()) > len(runs)  # somebody lost and looked again
    expected = serial(runs, order)
    for name in runs:
        assert status_rows(spark, base, name) == expected[name]
        batches = C.read_published(spark, base, P.BATCHES, S.BATCHES, DAY).where(f"transaction_id = '{name}'").collect()
        sent = Counter(x[1] for x in expected[name] if x[3] == S.UNIQUE_GLOBAL)
        assert Counter(r.IMEI for r in batches) == sent
        for code in {r.Notification_Code for r in batches}:
            numbers = sorted((r.row_no, r.batch_no) for r in batches if r.Notification_Code == code)
            assert numbers == [(i, (i - 1) // 3) for i in range(1, len(numbers) + 1)]


def test_a_commit_that_touches_no_key_costs_no_second_snapshot(spark, tmp_path, overdue):
    base = str(tmp_path / "published")
    mine = write_due(tmp_path / "a.csv", [(3, "101", "N1")])
    other = write_due(tmp_path / "b.csv", [(3, "999", "N1")])
    written = []

    def overtake(tried):
        written.append(len(list((tmp_path / "published" / "batches").rglob("snapshot=*"))))
        if not tried:
            P.run_concurrent(spark, other, overdue, base, Run("A_CD_1.csv", "T2", START))

    version, manifest = P.run_concurrent(
        spark, mine, overdue, base, Run("A_AB_1.csv", "T1", START), before_commit=overtake
    )
    assert version == 2 and [r.BATCH_FILE_COUNT for r in manifest.collect()] == [1]
    assert written == [1, 2]


def test_a_replaced_run_frees_its_keys(spark, tmp_path, overdue):
    """While a run decides, an earlier one of its business is repeated with fewer rows."""
    base = str(tmp_path / "published")
    many = write_due(tmp_path / "many.csv", [(3, "101", "N1"), (4, "102", "N1")])
    few = write_due(tmp_path / "few.csv", [(4, "102", "N1")])
    first = Run("A_AB_1.csv", "T1", START)
    P.run_concurrent(spark, many, overdue, base, first)

    def repeat(tried):
        if not tried:
            P.run_concurrent(spark, few, overdue, base, first)

    P.run_concurrent(spark, many, overdue, base, Run("A_AB_2.csv", "T2", START), before_commit=repeat)
    assert [x[3] for x in status_rows(spark, base, "T2")] == [S.UNIQUE_GLOBAL, S.DUPLICATE_BIZ]
    assert C.drop_replaced(spark, base, DAY) == 1
    assert [x[3] for x in status_rows(spark, base, "T1")] == [S.UNIQUE_GLOBAL]


@pytest.mark.parametrize("step", [1, 5])
def test_killed_between_write_and_commit(spark, tmp_path, overdue, step):
    base = str(tmp_path / "published")
    due = write_due(tmp_path / "a.csv", [(i, str(100 + i), "N1") for i in range(3, 7)])
    run = Run("A_AB_1.csv", "T1", START)
    P.run_concurrent(spark, due, overdue, base, run, step=2)

    def seen():
        tables = ((P.STATUS, S.STATUS), (P.BATCHES, S.BATCHES), (P.STAGING, S.STAGING_LOG), (P.INIT, S.INIT_LOG))
        return [sorted(map(str, C.read_published(spark, base, *t, DAY).collect())) for t in tables]

    before = seen()
    during = []

    def die(_tried):
        during.append(seen())
        raise InterruptedError

    with pytest.raises(InterruptedError):
        P.run_concurrent(spark, due, overdue, base, run, step=step, before_commit=die)
    assert during == [before] and seen() == before
    P.run_concurrent(spark, due, overdue, base, run, step=step)
    assert seen()[0] == before[0] and len(seen()[2]) == -(-4 // step)
    # The earlier state can still be read by its version.
    old = C.read_published(spark, base, P.STAGING, S.STAGING_LOG, DAY, version=1)
    assert sorted(map(str, old.collect())) == before[2]


def test_one_of_many_commits_wins(spark, tmp_path):
    base = str(tmp_path / "published")
    won = []

    def work(i):
        record = C.commit_record(DAY, "AB", f"T{i}", f"s{i}", [])
        won.append((i, C.try_commit(spark, base, DAY, 1, record)))

    threads = [threading.Thread(target=work, args=(i,)) for i in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(120)
    winners = [i for i, w in won if w]
    assert len(won) == 8 and len(winners) == 1
    assert [r.transaction_id for r in C.read_commits(spark, base, DAY).collect()] == [f"T{winners[0]}"]


def test_nothing_published_yet(spark, tmp_path):
    base = str(tmp_path / "none")
    assert C.latest_version(spark, base, DAY) == 0
    empty = C.read_published(spark, base, P.BATCHES, S.BATCHES, DAY)
    assert empty.count() == 0 and empty.schema == S.BATCHES
