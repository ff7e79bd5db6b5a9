"""Sends that are lost and repeated: what has an answer is sent once."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sendgate.operators import dispatch, ledger as L
from sendgate.plans.bulk import run_bulk
from sendgate.plans.primary import Folders, Run, run_primary
from tests.test_dispatch import batches, no_wait, token
from tests.test_runs import ROWS, START, write_due
from tests.test_runs import overdue  # noqa: F401


class Api:
    """Notes every call in a file of its own; ends the task at the files named once."""

    def __init__(self, folder, killed=(), refused=()):
        self.folder, self.killed, self.refused = str(folder), killed, refused

    def __call__(self, name, payload, token):
        text = "".join(payload)
        with open(f"{self.folder}/{name.replace('/', '-')}", "a") as calls:
            calls.write("x")
        if name in self.killed:
            raise SystemExit("lost")
        return (503, "busy") if name in self.refused else (200, f"{len(text)}")


def calls(folder):
    return {p.name.replace("-", "/"): len(p.read_text()) for p in folder.iterdir()}


def listed(spark, tmp_path, files=7):
    path = str(tmp_path / "listed")
    batches(spark, files=files).write.parquet(path)
    return spark.read.parquet(path)


def statuses(frame):
    rows = frame.collect()
    found = {r["filename"]: r["status"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture
def api_folder(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return folder


def test_nothing_lost(spark, tmp_path, api_folder):
    rows, ledger = listed(spark, tmp_path), str(tmp_path / "ledger")
    api = Api(api_folder, refused=["/f2.csv"])
    for _ in range(2):  # the second call sends nothing
        got = statuses(L.send_with_ledger(rows, ledger, api, token, wave=3, wait=no_wait))
        assert got == {f"/f{i}.csv": "error" if i == 2 else "success" for i in range(7)}
        assert calls(api_folder) == {f"/f{i}.csv": 1 for i in range(7)}
    assert Counter(r.wave for r in L.read_intents(spark, ledger).collect()) == {0: 3, 1: 3, 2: 1}


def test_lost_mid_way_and_repeated(spark, tmp_path, api_folder):
    rows, ledger = listed(spark, tmp_path), str(tmp_path / "ledger")
    with pytest.raises(Exception, match="SystemExit|lost"):
        L.send_with_ledger(rows, ledger, Api(api_folder, killed=["/f4.csv"]), token, wave=1, wait=no_wait)
    first = calls(api_folder)
    assert first == {f"/f{i}.csv": 1 for i in range(5)}
    assert statuses(L.outcomes(spark, ledger)) == {
        **{f"/f{i}.csv": "success" for i in range(4)}, "/f4.csv": L.UNRESOLVED,
    }
    got = statuses(L.send_with_ledger(rows, ledger, Api(api_folder), token, wave=3, wait=no_wait))
    assert got == {f"/f{i}.csv": L.UNRESOLVED if i == 4 else "success" for i in range(7)}
    assert calls(api_folder) == {f"/f{i}.csv": 1 for i in range(7)}
    # Only on request is it sent again, and then it has an answer.
    again = L.send_with_ledger(rows, ledger, Api(api_folder), token, resend_unresolved=True, wait=no_wait)
    assert set(statuses(again).values()) == {"success"}
    assert calls(api_folder) == {f"/f{i}.csv": 1 + (i == 4) for i in range(7)}


def test_answers_of_a_wave_outlive_its_job(spark, tmp_path, api_folder):
    """Others of the wave that ended before the loss keep their answers, though the job failed."""
    rows, ledger = listed(spark, tmp_path, files=24), str(tmp_path / "ledger")
    with pytest.raises(Exception, match="SystemExit|lost"):
        L.send_with_ledger(rows, ledger, Api(api_folder, killed=["/f23.csv"]), token, wave=24, wait=no_wait)
    answered = {r.filename for r in L.read_answers(spark, ledger).collect()}
    assert answered and "/f23.csv" not in answered
    statuses(L.send_with_ledger(rows, ledger, Api(api_folder), token, wave=24, wait=no_wait))
    assert all(n == 1 for n in calls(api_folder).values())
    assert {r.filename for r in L.read_answers(spark, ledger).collect()} == answered


def test_a_wave_is_one_job_on_its_own_files(spark, tmp_path, api_folder):
    """The staged rows are read before the first wave, so a wave costs the same however many there are."""

    class Emptied(Api):
        def __call__(self, name, payload, token):
            shutil.rmtree(tmp_path / "listed", ignore_errors=True)
            return super().__call__(name, payload, token)

    jobs = {}
    for files in (3, 8):
        rows, ledger = listed(spark, tmp_path, files=files), str(tmp_path / f"ledger-{files}")
        spark.sparkContext.setJobGroup(ledger, "sends")
        try:
            got = L.send_with_ledger(rows, ledger, Emptied(api_folder), token, wave=1, wait=no_wait)
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        jobs[files] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(ledger))
        assert statuses(got) == {f"/f{i}.csv": "success" for i in range(files)}
    assert jobs[8] - jobs[3] < 2 * 5  # one per wave; how the tables are read may take a further one


def test_waves_of_one_file_are_planned_once(spark, tmp_path, api_folder, monkeypatch):
    """And each answer is readable before the next file's intent."""
    rows, ledger = listed(spark, tmp_path, files=6), tmp_path / "ledger"
    planned = []
    plain = dispatch.send_payloads
    monkeypatch.setattr(dispatch, "send_payloads", lambda *a, **k: planned.append(a) or plain(*a, **k))

    class Seen(Api):
        def __call__(self, name, payload, token):
            super().__call__(name, payload, token)
            held = [len([*(ledger / kind).glob("[!._]*")]) for kind in ("intents", "answers")]
            return 200, str(held)

    sent = L.send_with_ledger(rows, str(ledger), Seen(api_folder), token, wave=1, wait=no_wait)
    seen = {r["filename"]: r["api_response"] for r in sent.collect()}
    assert seen == {f"/f{i}.csv": str([i + 1, i]) for i in range(6)}
    assert len(planned) == 1 and calls(api_folder) == {f"/f{i}.csv": 1 for i in range(6)}


@pytest.mark.parametrize("wave", [1, 3])
def test_payloads_are_those_of_a_plain_dispatch(spark, tmp_path, wave):
    """Files of several codes and parts are sent in order, whatever the wave."""

    def echo(name, payload, token):
        return 200, "".join(payload)

    def texts(frame):
        return {r["filename"]: r["api_response"] for r in frame.collect()}

    rows = listed(spark, tmp_path, files=5)
    plain = dispatch.dispatch_batches(rows, echo, token, tasks=2, wait=no_wait, part_rows=1)
    sent = L.send_with_ledger(rows, str(tmp_path / "ledger"), echo, token, wave, wait=no_wait, part_rows=1)
    assert texts(sent) == texts(plain)
    assert len(texts(sent)) == 5


def test_planned_intents_are_gone_in_the_end(spark, tmp_path, api_folder):
    """Also after a loss; and a plan that a lost driver left behind is not taken for intents."""
    rows, ledger = listed(spark, tmp_path, files=3), tmp_path / "ledger"
    with pytest.raises(Exception, match="SystemExit|lost"):
        L.send_with_ledger(rows, str(ledger), Api(api_folder, killed=["/f0.csv"]), token, wave=1, wait=no_wait)
    assert (ledger / "intents").exists() and not (ledger / "planned").exists()
    left = spark.createDataFrame([("/f2.csv", 9, 0)], "filename string, wave long, _wave long")
    left.write.partitionBy("_wave").parquet(L._planned(str(ledger)))
    got = statuses(L.send_with_ledger(rows, str(ledger), Api(api_folder), token, wave=2, wait=no_wait))
    assert got == {"/f0.csv": L.UNRESOLVED, "/f1.csv": "success", "/f2.csv": "success"}
    waves = {r.filename: r.wave for r in L.read_intents(spark, str(ledger)).collect()}
    assert waves == {"/f0.csv": 0, "/f1.csv": 1, "/f2.csv": 1}


def test_a_further_attempt_of_a_task_does_not_send(monkeypatch):
    class Second:
        def attemptNumber(self):
            return 1

    monkeypatch.setattr(L.TaskContext, "get", staticmethod(lambda: Second()))
    assert L._first_attempt_only(lambda *_: 1 / 0)("/f", iter(()), "t") == (L._NOT_SENT, "")


def test_bulk_run_with_ledger(spark, tmp_path, overdue, api_folder):  # noqa: F811
    folders = Folders.under(str(tmp_path / "staging"))
    run = Run("A_CD_1.csv", "T1", START)
    run_primary(spark, write_due(tmp_path / "due.csv", ROWS), overdue, folders, run, step=1)
    names = sorted(r[0] for r in spark.read.option("recursiveFileLookup", True).parquet(f"{folders.logs}/staging")
                   .select("DATA_C_FILENAME").collect())
    with pytest.raises(Exception, match="SystemExit|lost"):
        run_bulk(spark, folders, run, Api(api_folder, killed=names[1:2]), token, 1, no_wait, ledger=True)
    for _ in range(2):
        report = run_bulk(spark, folders, run, Api(api_folder), token, 1, no_wait, ledger=True)
        got = {r["DATA_C_FILENAME"]: r["status"] for r in report.collect()}
        assert got == {n: L.UNRESOLVED if n == names[1] else "success" for n in names}
    assert calls(api_folder) == {n: 1 for n in names}
    assert report.where(F.col("status") == "not_sent").isEmpty()
