"""Whole runs: file in, batches staged, dispatched and logged."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from sendgate import schemas as S
from sendgate.operators import logs
from sendgate.operators.status import overdue_keys
from sendgate.plans.bulk import run_bulk
from sendgate.plans.primary import Folders, Run, run_primary
from sendgate.plans.runs import run_log, run_logged
from sendgate.session import keep
from sendgate.sources import layout, readers, writers
from sendgate.streaming.arrivals import process_arrivals

START = dt.datetime(2024, 1, 1, 20, 0)  # the next day in local time
DAY = dt.date(2024, 1, 2)


@pytest.fixture
def overdue(spark):
    return overdue_keys(
        spark.createDataFrame([(2, 1, 5.0)], "APPL_ID bigint, BUCKET int, INSTALLMENT_OVERDUE double")
    )


def write_due(path, rows, header="Notification_Code,EXTRA,LOAN_OVERVIEW_IMEI,LOAN_OVERVIEW_APPL_ID"):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


ROWS = ["N1,x,0101.0,1", "N1,x,102,2", "N2,x,,3", '"N,2",x,104,4', "N1,x,105,", "N1,x,106,6"]


def statuses(spark, folders, run):
    frame = readers.read_status(spark, folders.status, run.run_date)
    rows = frame.where(frame.transaction_id == run.transaction_id).collect()
    return {(r["APPL_ID"], r["IMEI"]): r["FILTER_STATUS"] for r in rows}


def test_due_is_found_by_header(spark, tmp_path):
    got = readers.read_due(spark, write_due(tmp_path / "due.csv", ROWS))
    assert got.columns == [S.APPL_ID, S.IMEI, S.CODE]
    assert {tuple(r) for r in got.collect()} == {
        (1, "101", "N1"), (2, "102", "N1"), (3, None, "N2"), (4, "104", "N,2"),
        (None, "105", "N1"), (6, "106", "N1"),
    }
    bad = write_due(tmp_path / "bad.csv", ["1,2"], "LOAN_OVERVIEW_APPL_ID,Notification_Code")
    with pytest.raises(AnalysisException):
        readers.read_due(spark, bad)


def test_overdue_is_read_from_the_loan_table(spark, tmp_path):
    rows = [(1, 1, 0.5, "a"), (1, 2, 9.0, "b"), (2, 0, 9.0, "c"), (3, 1, 0.0, "d"), (4, None, 1.0, "e")]
    loans = spark.createDataFrame(rows, S.LOAN_FACT)
    for fmt in ("parquet", "orc"):
        loans.write.format(fmt).save(str(tmp_path / fmt))
        got = readers.read_overdue(spark, str(tmp_path / fmt), fmt)
        assert [tuple(r) for r in got.collect()] == [(1,), (1,)]


def test_missing_history_is_empty_and_other_errors_are_not_hidden(spark, tmp_path):
    empty = readers.read_history(spark, str(tmp_path / "none"), DAY)
    assert empty.count() == 0 and empty.schema == S.BATCHES
    with pytest.raises(AnalysisException):
        readers.read_overdue(spark, str(tmp_path / "none"))


def test_run_rerun_and_second_file(spark, tmp_path, overdue):
    folders = Folders.under(str(tmp_path / "staging"))
    due = write_due(tmp_path / "due.csv", ROWS)
    run = Run(" A_CD_1.csv ", " T1 ", START)
    assert (run.business, run.run_date, run.stamp) == ("CD", DAY, "20240102013000")

    manifest = run_primary(spark, due, overdue, folders, run, step=2).collect()
    prefix = "/2024/01/02/CD/DCNOTIF_20240102013000_"
    assert [tuple(r) for r in manifest] == [(0, f"{prefix}0_REQ.csv", 3), (1, f"{prefix}1_REQ.csv", 1)]
    assert Counter(statuses(spark, folders, run).values()) == {
        S.UNIQUE_GLOBAL: 4, S.DELINQUENT: 1, S.NULL: 1,
    }
    staged = readers.read_batches(spark, folders.batches, DAY, "T1")
    first = Counter(tuple(r) for r in staged.collect())

    # The same run again: same content, as its own rows are not held against it.
    run_primary(spark, due, overdue, folders, run, step=2)
    staged = readers.read_batches(spark, folders.batches, DAY, "T1")
    assert Counter(tuple(r) for r in staged.collect()) == first

    # With a larger step the old second batch is gone.
    run_primary(spark, due, overdue, folders, run, step=100)
    assert readers.read_batches(spark, folders.batches, DAY, "T1").select("batch_no").distinct().count() == 1

    # Another file of the same business that day, then one of another business, then a third.
    again = Run("B_CD_2.csv", "T2", START)
    run_primary(spark, due, overdue, folders, again)
    assert Counter(statuses(spark, folders, again).values())[S.DUPLICATE_BIZ] == 4
    for name, business in (("T3", "AB"), ("T4", "EF"), ("T5", "GH")):
        later = Run(f"C_{business}_3.csv", name, START)
        run_primary(spark, due, overdue, folders, later)
        kept = Counter(statuses(spark, folders, later).values())
        assert kept[S.UNIQUE_GLOBAL if name != "T5" else S.DUPLICATE_GLOBAL] == 4
    tomorrow = Run("D_CD_4.csv", "T6", START + dt.timedelta(days=1))
    run_primary(spark, due, overdue, folders, tomorrow)
    assert Counter(statuses(spark, folders, tomorrow).values())[S.UNIQUE_GLOBAL] == 4

    init = readers.read_log(spark, f"{folders.logs}/init", S.INIT_LOG).where("TRANSACTION_ID = 'T1'")
    assert {(r["CG_COUNT"], r["ELIGIBLE_COUNT"], r["CG_FILENAME"]) for r in init.collect()} == {
        (6, 4, "A_CD_1.csv")
    }


def test_bulk_run(spark, tmp_path, overdue):
    folders = Folders.under(str(tmp_path / "staging"))
    due = write_due(tmp_path / "due.csv", ROWS)
    run = Run("A_CD_1.csv", "T1", START)
    run_primary(spark, due, overdue, folders, run, step=2)
    run_primary(spark, due, overdue, folders, Run("A_AB_1.csv", "T2", START))
    calls = tmp_path / "calls"
    calls.mkdir()

    def api(name, payload, token):
        with open(calls / name.replace("/", "-"), "a") as f:
            f.writelines(payload)
        return (200, '{"ok": true}') if name.endswith("_0_REQ.csv") else (503, "busy")

    report = run_bulk(spark, folders, run, api, lambda: "t", tasks=2, wait=lambda _: 0.0)
    for _ in range(2):  # reading the report again sends nothing again
        assert {(r["DATA_C_FILENAME"][-9:], r["status"], r["status_code"]) for r in report.collect()} == {
            ("0_REQ.csv", "success", "200"), ("1_REQ.csv", "error", "503"),
        }
    sent = {p.name: p.read_text() for p in calls.iterdir()}
    assert len(sent) == 2 and all(text.count("IMEI,") == 1 for text in sent.values())
    log = readers.read_log(spark, f"{folders.logs}/response", S.RESPONSE_LOG).collect()
    assert {r["TRANSACTION_ID"] for r in log} == {"T1"} and len(log) == 2
    kpi = readers.read_log(spark, f"{folders.logs}/kpi", S.KPI_LOG).collect()
    assert Counter(r["ITEM_TYPE"] for r in kpi) == {"Primary": 2, "BulkNotification": 1}
    assert all(r["START_TIME"] <= r["END_TIME"] and r["DURATION_US"] >= 0 for r in kpi)


def test_balanced_run_and_no_eligible_rows(spark, tmp_path, overdue):
    folders = Folders.under(str(tmp_path / "staging"))
    due = write_due(tmp_path / "due.csv", ROWS)
    run = Run("A_CD_1.csv", "T1", START)
    got = run_primary(spark, due, overdue, folders, run, step=3, balanced=True).collect()
    assert [r["BATCH_FILE_COUNT"] for r in got] == [3, 1]
    nobody = write_due(tmp_path / "none.csv", ["N1,x,,1"])
    again = run_primary(spark, nobody, overdue, folders, Run("A_CD_2.csv", "T2", START))
    assert again.collect() == []


def test_names_and_folders_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        Run("nobusiness.csv", "T", START)
    with pytest.raises(ValueError):
        layout.run_folder("/r", DAY, "", "T")
    assert layout.run_folder("/r/", DAY, "a b", "x/y") == (
        "/r/run_date=2024-01-02/business=a%20b/transaction_id=x%2Fy"
    )
    frame = spark.createDataFrame([("1", "N", "t")], "IMEI string, Notification_Code string, TriggerID string")
    for name, data in (("", frame), (" ", frame), (None, frame), ("/a", frame.limit(0)), ("/a", None)):
        with pytest.raises(ValueError):
            writers.require_rows(name, data)
    assert writers.write_batch_csv(frame, str(tmp_path), "/a.csv") == "/a.csv"
    assert spark.read.option("header", True).csv(f"{tmp_path}/a.csv").collect() == frame.collect()


def test_odd_names_survive_the_folder_names(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, "1", "N", "UNIQUE_GLOBAL")],
        "APPL_ID bigint, IMEI string, Notification_Code string, FILTER_STATUS string",
    )
    writers.write_status(frame, str(tmp_path / "s"), DAY, "a b", "x/y:1=2%")
    got = readers.read_status(spark, str(tmp_path / "s"), DAY).first()
    assert (got["business"], got["transaction_id"], got["run_date"]) == ("a b", "x/y:1=2%", DAY)


def test_failed_runs_raise(spark, tmp_path):
    ok = spark.createDataFrame([("a", "ok", 0), ("b", None, 0)], S.RUN_LOG)
    logs.raise_on_failed_runs(ok, str(tmp_path / "none"))
    rows = [("a", "ok", 0)] + [(f"b{i}", "ERROR: x", 1) for i in range(300)]
    path = str(tmp_path / "failed")
    with pytest.raises(RuntimeError, match="^300 failed runs, listed in "):
        logs.raise_on_failed_runs(spark.createDataFrame(rows, S.RUN_LOG), path)
    assert {r["path"] for r in spark.read.parquet(path).collect()} == {f"b{i}" for i in range(300)}


def test_a_failed_run_is_a_row(spark, tmp_path):
    folders = Folders.under(str(tmp_path / "staging"))
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 2:
            raise OSError("later\nmore")

    assert run_logged(spark, folders, "/in/a b.csv", work)
    assert not run_logged(spark, folders, "/in/x.csv", lambda: 1 / 0)
    assert run_logged(spark, folders, "/in/x.csv", lambda: None)
    assert not run_logged(spark, folders, "/in/y.csv", lambda: 1 / 0, retries=2)
    assert {tuple(r) for r in run_log(spark, folders).collect()} == {
        ("/in/a b.csv", "ok", 1), ("/in/x.csv", "ok", 0),
        ("/in/y.csv", "ERROR: ZeroDivisionError: division by zero", 2),
    }


def test_repeat_after_midnight_replaces_everything(spark, tmp_path, overdue):
    folders = Folders.under(str(tmp_path / "staging"))
    due = write_due(tmp_path / "due.csv", ROWS)
    for hours, step in ((0, 1), (1, 2), (30, 100)):
        run = Run("A_CD_1.csv", "T1", START + dt.timedelta(hours=hours))
        manifest = run_primary(spark, due, overdue, folders, run, step=step).collect()
    assert [r["BATCH_FILE_COUNT"] for r in manifest] == [4]
    assert readers.read_batches(spark, folders.batches, DAY + dt.timedelta(days=1), "T1").count() == 0
    assert readers.read_log(spark, f"{folders.logs}/init", S.INIT_LOG).count() == 1
    report = run_bulk(spark, folders, run, lambda n, p, t: (200, ""), lambda: "t")
    assert [r["status"] for r in report.collect()] == ["success"]
    # Nothing of other runs is listed to find the manifest.
    own = readers.read_run_log(
        spark, f"{folders.logs}/staging", S.STAGING_LOG, DAY, "CD", "T1"
    )
    assert all("transaction_id=T1" in path for path in own.inputFiles())


def test_audit_fanout_and_odd_records_of_a_run(spark, tmp_path):
    folders = Folders.under(str(tmp_path / "staging"))
    overdue = spark.createDataFrame([(2,), (2,), (2,)], "APPL_ID bigint")
    due = write_due(tmp_path / "due.csv", ROWS)
    run_primary(spark, due, overdue, folders, Run("A_AB_1.csv", "T1", START), dedupe_keys=False)
    init = readers.read_log(spark, f"{folders.logs}/init", S.INIT_LOG).first()
    assert (init["CG_COUNT"], init["ELIGIBLE_COUNT"]) == (8, 4)
    # 102 was rejected, so it is in the audit only; the others are there and sent as well.
    nobody = spark.createDataFrame([], "APPL_ID bigint")
    for name, cap in (("T2", 1), ("T3", 2)):
        run = Run(f"A_{name}_1.csv", name, START)
        run_primary(spark, due, nobody, folders, run, cap, count_audit=True)
    kept = statuses(spark, folders, Run("A_T2_1.csv", "T2", START))
    assert kept[2, "102"] == S.DUPLICATE_GLOBAL
    odd = write_due(tmp_path / "odd.csv", ['N1,"two', 'lines",101,1', "N1,x,102,2,9", "N1,x,103,3"])
    with pytest.raises(Exception, match="not as many values"):
        run_primary(spark, odd, nobody, folders, Run("A_CD_9.csv", "T9", START))
    run = Run("A_CD_9.csv", "T9", START)
    run_primary(spark, odd, nobody, folders, run, 99, multi_line=True, drop_bad=True)
    assert set(statuses(spark, folders, run)) == {(1, "101"), (3, "103")}


def test_arrivals(spark, tmp_path, overdue):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_due(landing / "A_CD_1.csv", ROWS)
    folders = Folders.under(str(tmp_path / "staging"))

    def process():
        query = process_arrivals(
            spark, str(landing), lambda _s: overdue, folders, str(tmp_path / "checkpoint"),
            clock=lambda: START,
        )
        query.awaitTermination(120)
        assert query.exception() is None

    process()
    write_due(landing / "B_CD_2 a%20b.csv", ROWS + ["N1,x,107,7"])
    write_due(landing / "noname.csv", ROWS)
    (landing / "ignored.txt").write_text("x")
    process()
    process()
    failed = logs.failed_runs(run_log(spark, folders)).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["retries"]) for r in failed] == [("noname.csv", 1)]
    assert "no business in file name" in failed[0]["result"]
    assert run_log(spark, folders).count() == 3
    log = readers.read_log(spark, f"{folders.logs}/init", S.INIT_LOG).collect()
    assert {(r["CG_FILENAME"], r["CG_COUNT"], r["ELIGIBLE_COUNT"]) for r in log} == {
        ("A_CD_1.csv", 6, 4), ("B_CD_2 a%20b.csv", 7, 1),
    }
    assert len(log) == 2


def test_a_name_that_arrives_again_is_a_run_of_its_own(spark, tmp_path, overdue):
    """The same file name on two days, in a folder per day: both days keep their rows."""
    folders = Folders.under(str(tmp_path / "staging"))
    for i in range(2):
        day = tmp_path / "landing" / f"day{i}"
        day.mkdir(parents=True)
        path = write_due(day / "A_CD_1.csv", ROWS + [f"N1,x,20{i},7"])
        os.utime(path, (1_700_000_000 + 86_400 * i,) * 2)
        for _ in range(2):
            query = process_arrivals(
                spark, str(tmp_path / "landing" / "*"), lambda _s: overdue, folders,
                str(tmp_path / "checkpoint"), clock=lambda: START + dt.timedelta(days=i),
            )
            query.awaitTermination(120)
            assert query.exception() is None
        for earlier in range(i + 1):
            status = readers.read_status(spark, folders.status, DAY + dt.timedelta(days=earlier)).collect()
            assert len(status) == 7 and f"20{earlier}" in {r["IMEI"] for r in status}
            assert len({r["transaction_id"] for r in status}) == 1
    assert readers.read_log(spark, f"{folders.logs}/init", S.INIT_LOG).count() == 2
    assert run_log(spark, folders).count() == 2


def test_a_read_is_tried_again_after_errors_of_storage(spark, tmp_path):
    """The file is not there at first, then goes while it is read, and is there in the end."""
    path, waits = tmp_path / "late.csv", []

    def wait(seconds):
        waits.append(seconds)
        write_due(path, ROWS)

    def read():
        due = readers.read_due(spark, str(path))
        if len(waits) == 1:
            path.unlink()
        return keep(due, "due")

    assert readers.retried(read, wait=wait).count() == len(ROWS)
    assert waits == [2, 4]


def test_a_read_that_never_works_fails_loudly(spark, tmp_path):
    waits = []
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.retried(lambda: readers.read_due(spark, str(tmp_path / "none.csv")).count(), wait=waits.append)
    assert waits == [2, 4]


@pytest.mark.parametrize("header", ["LOAN_OVERVIEW_APPL_ID,Notification_Code", None])
def test_a_bad_file_is_not_read_again(spark, tmp_path, header):
    rows = ["1,2"] if header else ["1,2"] + ROWS
    path = write_due(tmp_path / "bad.csv", rows, *([header] if header else []))
    waits = []
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN" if header else "not as many values"):
        readers.retried(lambda: keep(readers.read_due(spark, path), "due"), wait=waits.append)
    assert waits == []
