import csv
import datetime as dt
import io
from collections import Counter

import pandas as pd
import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from sendgate.operators import batching, dispatch, payloads

COLUMNS = (
    "APPL_ID bigint, IMEI string, Notification_Code string, TriggerID string, row_no bigint,"
    " DATA_C_FILENAME string, batch_no bigint"
)


def no_wait(_attempt):
    return 0.0


def token():
    return "good"


def batches(spark, files=3, rows=4):
    data = [
        (i, f"{i}", f"N{i % 2}", f"t{f}-{i}", i // 2 + 1, f"/f{f}.csv", f)
        for f in range(files) for i in range(rows)
    ]
    return spark.createDataFrame(data, COLUMNS).repartition(4)


def outcomes(attempts):
    return {
        r["filename"]: (r["status"], r["status_code"], r["attempt"], r["api_response"])
        for r in dispatch.latest_attempt(attempts).collect()
    }


def test_classes(spark):
    codes = [100, 200, 302, 399, 400, 401, 500, None]
    frame = spark.createDataFrame([(c,) for c in codes], "code int")
    got = [r[0] for r in frame.select(dispatch.classify_response(F.col("code"))).collect()]
    assert got == [
        "unknown", "success", "success", "success", "error", "auth_retry", "error", "failed",
    ]


def test_waits():
    assert [dispatch.backoff_seconds(n) for n in (1, 2, 3, 4, 5)] == [2, 4, 8, 16, 20]


def test_whole_payload_reaches_the_transport(spark):
    def echo(name, payload, token):
        return 200, "".join(payload)

    frame = batches(spark)
    got = outcomes(dispatch.dispatch_batches(frame, echo, token, tasks=2, wait=no_wait))
    assert set(got) == {"/f0.csv", "/f1.csv", "/f2.csv"}
    for name, (status, code, attempt, text) in got.items():
        assert (status, code, attempt) == ("success", "200", 1)
        rows = list(csv.reader(io.StringIO(text)))
        assert rows[0] == ["IMEI", "Notification_Code", "TriggerID"]
        f = name[2]
        # By code, then by number.
        assert rows[1:] == [[str(i), f"N{i % 2}", f"t{f}-{i}"] for i in (0, 2, 1, 3)]


def test_batches_are_dealt_evenly(spark):
    def where(name, payload, token):
        return 200, str(TaskContext.get().partitionId())

    frame = batches(spark, files=12)
    got = outcomes(dispatch.dispatch_batches(frame, where, token, tasks=4, wait=no_wait))
    assert sorted(Counter(v[3] for v in got.values()).values()) == [3, 3, 3, 3]


def test_payload_longer_than_one_arrow_batch(spark):
    def lines(name, payload, token):
        return 200, str("".join(payload).count("\n"))

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        frame = batches(spark, files=5, rows=100)
        got = outcomes(dispatch.dispatch_batches(frame, lines, token, tasks=2, wait=no_wait))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {v[3] for v in got.values()} == {"101"} and len(got) == 5


def test_retry_refresh_and_errors(spark):
    class Tokens:
        given = 0

        def __call__(self):
            self.given += 1
            return f"token{self.given}"

    class Api:
        """f0 fails twice, f1 always, f2 is refused, f3 knows only the second token, f4 none."""

        def __init__(self):
            self.calls = Counter()

        def __call__(self, name, payload, token):
            self.calls[name] += 1
            if name == "/f0.csv" and self.calls[name] < 3:
                raise ConnectionError("down")
            if name == "/f1.csv":
                raise ConnectionError("down")
            if name == "/f2.csv":
                return 500, "broken"
            if name == "/f4.csv" or (name == "/f3.csv" and token == "token1"):
                return 401, "expired"
            return 200, token

    frame = batches(spark, files=5)
    attempts = dispatch.dispatch_batches(frame, Api(), Tokens(), tasks=1, wait=no_wait)
    rows = attempts.collect()
    assert Counter(r["filename"] for r in rows) == {
        "/f0.csv": 3, "/f1.csv": 3, "/f2.csv": 1, "/f3.csv": 2, "/f4.csv": 2,
    }
    got = outcomes(spark.createDataFrame(rows, attempts.schema))
    assert got["/f0.csv"] == ("success", "200", 3, "token1")
    assert got["/f1.csv"] == ("failed", None, 3, "ConnectionError('down')")
    assert got["/f2.csv"] == ("error", "500", 1, "broken")
    assert got["/f3.csv"] == ("success", "200", 2, "token2")
    # No retry follows the second refusal.
    assert got["/f4.csv"] == ("error", "401", 2, "expired")
    first = {r["attempt"]: r["status"] for r in rows if r["filename"] == "/f4.csv"}
    assert first == {1: "auth_retry", 2: "error"}


def test_a_dead_token_source_is_asked_five_times_by_a_task(spark, tmp_path):
    asked = tmp_path / "asked"

    def no_token():
        with open(asked, "a") as f:
            f.write("x")
        raise PermissionError("locked")

    got = outcomes(
        dispatch.dispatch_batches(batches(spark, 9), lambda *_: (200, ""), no_token, 1, wait=no_wait)
    )
    assert set(got.values()) == {("failed", None, 1, "PermissionError('locked')")} and len(got) == 9
    assert len(asked.read_text()) == 5


def test_a_token_that_cannot_be_renewed_ends_the_file(spark):
    class Tokens:
        asked = 0

        def __call__(self):
            self.asked += 1
            if self.asked > 1:
                raise PermissionError("locked")
            return "old"

    frame = dispatch.dispatch_batches(
        batches(spark, 2), lambda *_: (401, "expired"), Tokens(), 1, wait=no_wait
    )
    rows = sorted((r["filename"], r["attempt"], r["status"]) for r in frame.collect())
    assert rows == [("/f0.csv", 1, "auth_retry"), ("/f0.csv", 2, "failed"), ("/f1.csv", 1, "failed")]


def test_a_retry_gets_the_payload_from_its_start(spark, monkeypatch):
    class Api:
        def __init__(self):
            self.calls = Counter()

        def __call__(self, name, payload, token):
            self.calls[name] += 1
            if self.calls[name] < 3:
                next(payload)
                raise ConnectionError("down")
            return 200, "".join(payload)

    frame = batches(spark, files=2, rows=500)
    got = outcomes(dispatch.dispatch_batches(frame, Api(), token, 1, wait=no_wait, part_rows=7))
    for status, _, attempt, text in got.values():
        assert (status, attempt) == ("success", 3) and text.count("\n") == 501
        assert text.startswith("IMEI,") and text.count("IMEI") == 1


def test_a_token_source_is_asked_again(spark):
    class Tokens:
        """Fails four times, then gives a token."""

        asked = 0

        def __call__(self):
            self.asked += 1
            if self.asked < 5:
                raise TimeoutError
            return "late"

    got = outcomes(
        dispatch.dispatch_batches(
            batches(spark, 1), lambda n, p, t: (200, t), Tokens(), 1, wait=no_wait
        )
    )
    assert got == {"/f0.csv": ("success", "200", 1, "late")}


def test_executors_need_no_copy_of_the_package():
    assert "sendgate" in cloudpickle.list_registry_pickle_by_value()


def test_report_has_one_row_per_manifest_row(spark):
    manifest = spark.createDataFrame([("a",), ("b",), ("c",)], "DATA_C_FILENAME string")
    attempts = spark.createDataFrame(
        [("a", 1, "failed", None, "x"), ("a", 2, "success", "200", '{"ok": [1, 2]}'),
         ("b", 1, "error", "500", 'no "json"')],
        "filename string, attempt int, status string, status_code string, api_response string",
    )
    report = dispatch.dispatch_report(manifest, dispatch.latest_attempt(attempts))
    log = {r["DATA_C_FILENAME"]: r["DATA_C_RESPONSE"] for r in dispatch.response_log(report, "T").collect()}
    assert log == {
        "a": '{"status":"success","status_code":"200","api_response":{"ok":[1,2]}}',
        "b": '{"status":"error","status_code":"500","api_response":{"raw":"no \\"json\\""}}',
        "c": '{"status":"not_sent","status_code":null,"api_response":null}',
    }
    parsed = dispatch.parse_responses(dispatch.response_log(report, "T"))
    assert {(r[1], r[2], r[3]) for r in parsed.collect()} == {
        ("a", "success", "200"), ("b", "error", "500"), ("c", "not_sent", None),
    }


def test_lines_equal_the_pandas_form(spark):
    values = [
        ("1", 'a "quoted", code', "t1"), ("2", None, "t2"), (None, "", "t3"), ("4", " padded ", "t4"),
        ("5", "two\nlines", "t5"), ("6", "back\\slash", "t6"), ("7", "it's", "t7"),
    ]
    frame = spark.createDataFrame(
        [(i, imei, code, t, i, "/f.csv", 0) for i, (imei, code, t) in enumerate(values)], COLUMNS
    )
    got = [r["line"] for r in payloads.payload_lines(frame).orderBy("row_no").collect()]
    expected = pd.DataFrame(values).to_csv(index=False, header=False)
    assert "\n".join(got) + "\n" == expected


@pytest.mark.parametrize("part_rows", [1, 3, 100])
def test_parts_make_the_file(spark, part_rows):
    frame = batches(spark, files=2, rows=10)
    parts = payloads.build_payloads(frame, part_rows).orderBy(
        "DATA_C_FILENAME", "Notification_Code", "part_no"
    )
    rows = parts.collect()
    assert max(r["n_rows"] for r in rows) <= part_rows
    files = {}
    for r in rows:
        files.setdefault(r["DATA_C_FILENAME"], [payloads.HEADER]).append(r["payload"])
    sent = outcomes(
        dispatch.dispatch_batches(
            frame, lambda n, p, t: (200, "".join(p)), token, tasks=2, wait=no_wait
        )
    )
    assert {k: "\n".join(v) + "\n" for k, v in files.items()} == {k: v[3] for k, v in sent.items()}


def test_payload_of_a_named_batch(spark):
    frame = spark.createDataFrame(
        [(1, "5", "N"), (2, "6", "N")], "APPL_ID bigint, IMEI string, Notification_Code string"
    )
    named = batching.name_batches(
        batching.add_trigger_ids(batching.assign_batches(frame, 1), "run"),
        "20240102030405",
        dt.date(2024, 1, 2),
        "CD",
    )
    files = {r["DATA_C_FILENAME"] for r in payloads.build_payloads(named).collect()}
    assert files == {f"/2024/01/02/CD/DCNOTIF_20240102030405_{k}_REQ.csv" for k in (0, 1)}
