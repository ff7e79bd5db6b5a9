"""Quoted CSV read in byte ranges, against Python's own reader of whole files."""

import csv
import random

import pytest

from sendgate.sources import readers
from sendgate.sources.records import read_records

HEADER = "LOAN_OVERVIEW_APPL_ID,LOAN_OVERVIEW_IMEI,Notification_Code,OTHER"


@pytest.fixture
def small_ranges(spark):
    """Files are read in ranges of a few hundred bytes, each by a task of its own."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "300"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_file(path, seed, records=200, end="\n"):
    draw = random.Random(seed)
    texts = ["", "plain", "two\nlines", 'a "quoted" word', "\n\n", ",", "x" * 700, 'ends with "\n', "é\n" * 30]
    rows = [[str(i), str(100 + i), draw.choice(["N1", "N,2", 'N"3']), draw.choice(texts)] for i in range(records)]
    with open(path, "w", newline="") as file:
        file.write(HEADER + end)
        writer = csv.writer(file, lineterminator=end)
        for row in rows:
            writer.writerow(row)
            if draw.random() < 0.05:
                file.write(end)
    return rows


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\r\n")])
def test_records_are_those_of_the_whole_file(spark, tmp_path, small_ranges, seed, end):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [row for i in range(2) for row in odd_file(folder / f"{i}.csv", seed + 10 * i, 200 if i else 3, end)]
    found = read_records(spark, str(folder))
    assert found.rdd.getNumPartitions() > 20
    got = found.collect()
    assert [r.record for r in got if r.first] == [HEADER] * 2
    parsed = [next(csv.reader([r.record + "\n"])) if "\n" not in r.record
              else next(csv.reader(r.record.splitlines(keepends=True))) for r in got if not r.first]
    assert sorted(parsed) == sorted(rows)


def test_due_with_line_ends_in_many_tasks(spark, tmp_path, small_ranges):
    path = str(tmp_path / "due.csv")
    rows = odd_file(path, 3)
    frame = readers.read_due(spark, path, multi_line=True)
    assert frame.rdd.getNumPartitions() > 20
    got = {(r.APPL_ID, r.IMEI, r.Notification_Code) for r in frame.collect()}
    assert got == {(int(a), b, c) for a, b, c, _ in rows}


def test_values_too_many_or_too_few(spark, tmp_path, small_ranges):
    path = tmp_path / "due.csv"
    odd_file(path, 4)
    with open(path, "a") as file:
        file.write('900,1,N1,x,more\n901,2\n902,3,N1,"two\nlines",more\n903,4,N1,"fine\n"\n')
    kept = readers.read_due(spark, str(path), multi_line=True, drop_bad=True).collect()
    assert {r.APPL_ID for r in kept} == {*range(200), 903}
    with pytest.raises(Exception, match="not as many values"):
        readers.read_due(spark, str(path), multi_line=True).collect()


def test_quotes_that_never_close_and_empty_files(spark, tmp_path):
    path = tmp_path / "due.csv"
    path.write_text(HEADER + '\n1,1,N1,"open\n2,2,N1,x\n')
    assert [r.record for r in read_records(spark, str(path)).collect() if not r.first] == ['1,1,N1,"open\n2,2,N1,x']
    path.write_text(HEADER + "\n")
    assert readers.read_due(spark, str(path), multi_line=True).collect() == []
