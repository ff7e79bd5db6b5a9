"""Replay of a table's log: what is live in each version, and which files are opened."""

import json
import operator

import pytest

from sendgate.fixtures import LoggedLoans, Roles
from sendgate.sources import table_log as L
from sendgate.sources.readers import read_overdue_as_of

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "id bigint, v double, day date, `odd name` string"


@pytest.fixture(scope="module")
def loans(spark):
    return LoggedLoans(Roles(spark, SF_DIR))


def commit(root, version, *actions):
    log = root / L.LOG_FOLDER
    log.mkdir(parents=True, exist_ok=True)
    (log / f"{version:020d}.json").write_text("\n".join(map(json.dumps, actions)) + "\n")


def head(spark, schema, partitions=(), **protocol):
    text = spark.createDataFrame([], schema).schema.json()
    meta = {"schemaString": text, "partitionColumns": list(partitions)}
    return {"protocol": {"minReaderVersion": 1, **protocol}}, {"metaData": meta}


def add(path, values=None, stats=None):
    held = {"path": path, "partitionValues": values or {}}
    return {"add": held | ({"stats": json.dumps(stats)} if stats else {})}


def put(spark, path, rows, schema):
    """One data file at the place the log tells."""
    import pyarrow.parquet as pq

    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(spark.createDataFrame(rows, schema).toArrow(), path)


@pytest.mark.parametrize("version", [1, 2, 3, None])
def test_conditions_open_only_files_that_can_match(spark, loans, version):
    """The list after pruning is exactly the live files that hold a matching bucket and a maximum above."""
    snapshot = L.read_snapshot(spark, loans.root, version)
    live = snapshot.files.collect()
    conditions = [("BUCKET", ">", 0), ("INSTALLMENT_OVERDUE", ">", 0)]
    left = {row.file for row in L.live_files(snapshot, conditions).collect()}
    holds = set()
    for row in live:
        rows = spark.read.parquet(row.file)
        if int(row["values"]["BUCKET"]) > 0 and rows.where("INSTALLMENT_OVERDUE > 0").count():
            holds.add(row.file)
    assert left == holds and 0 < len(left) < len(live)
    opened = read_overdue_as_of(spark, loans.root, version)
    assert {f.split("/")[-1] for f in opened.inputFiles()} == {f.split("/")[-1] for f in left}


def test_filters_reach_the_scan(spark, loans):
    plan = read_overdue_as_of(spark, loans.root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(BUCKET" in plan and "GreaterThan(INSTALLMENT_OVERDUE,0" in plan
    assert "Join" not in plan and "Exchange" not in plan


def test_versions(spark, loans):
    due = {v: read_overdue_as_of(spark, loans.root, v).count() for v in (1, 2, 3)}
    assert due[1] < due[2] < due[3] == read_overdue_as_of(spark, loans.root).count()
    with pytest.raises(ValueError):  # its commits are gone, only the checkpoint of 1 is left
        L.read_snapshot(spark, loans.root, 0)
    with pytest.raises(ValueError):
        L.read_snapshot(spark, loans.root, 4)


@pytest.mark.parametrize("op", ["=", "<", "<=", ">", ">="])
def test_every_operator_against_the_rows(spark, loans, op):
    from sendgate.session import keep

    test = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]
    everything = [r.INSTALLMENT_OVERDUE for r in L.read_logged_table(spark, loans.root).collect()]
    for value in (min(everything), 0.0, 3.0, max(everything), max(everything) + 1, min(everything) - 1):
        found = L.read_logged_table(spark, loans.root, where=[("INSTALLMENT_OVERDUE", op, value)])
        assert found.count() == sum(test(x, value) for x in everything)


def test_values_that_folders_do_not_tell(spark, tmp_path):
    """Files anywhere, odd names, null partitions: rows take the values that the log has."""
    root = tmp_path / "odd [table] a+b"
    rows = "id bigint, key string"
    put(spark, root / "plus+and blank" / "x%y.parquet", [(1, "a")], rows)
    put(spark, root / "{x}" / "*.parquet", [(2, "b")], rows)
    put(spark, root / "{x}" / "other.parquet", [(9, "z")], rows)
    put(spark, root / "day=2024-01-09" / "c.parquet", [(3, None)], rows)
    put(spark, tmp_path / "elsewhere" / "d.parquet", [(4, "d")], rows)
    schema = "id bigint, key string, day date"
    commit(
        root, 0, *head(spark, schema, ["day"]),
        add("plus+and%20blank/x%25y.parquet", {"day": "2024-01-01"}),
        add("%7Bx%7D/*.parquet", {"day": ""}),
        add("day=2024-01-09/c.parquet", {"day": "2024-01-03"}),  # the log decides, not the folder
        add((tmp_path / "elsewhere" / "d.parquet").as_uri(), {"day": "2024-01-04"}),
    )
    found = L.read_logged_table(spark, str(root))
    assert sorted((r.id, r.key, str(r.day)) for r in found.collect()) == [
        (1, "a", "2024-01-01"), (2, "b", "None"), (3, None, "2024-01-03"), (4, "d", "2024-01-04"),
    ]
    import datetime as dt

    later = L.read_logged_table(spark, str(root), where=[("day", ">=", dt.date(2024, 1, 3))])
    assert sorted(r.id for r in later.collect()) == [3, 4]


def test_statistics_that_are_missing_or_tell_of_nulls(spark, tmp_path):
    for name, rows in {"a": [(1, 5.0)], "b": [(2, None)], "c": [(3, 7.0)], "d": []}.items():
        put(spark, tmp_path / f"{name}.parquet", rows, "id bigint, v double")
    bounds = {"minValues": {"v": 5.0}, "maxValues": {"v": 5.0}}
    commit(
        tmp_path, 0, *head(spark, "id bigint, v double, new string"),
        add("a.parquet", stats={"numRecords": 1, **bounds, "nullCount": {"v": 0}}),
        add("b.parquet", stats={"numRecords": 1, "nullCount": {"v": 1}}),
        add("c.parquet"),
        add("d.parquet", stats={"numRecords": 0, "nullCount": {"v": 0}}),
    )
    snapshot = L.read_snapshot(spark, str(tmp_path))

    def names(*where):
        return sorted(r.file[-9] for r in L.live_files(snapshot, where).collect())

    assert names() == ["a", "b", "c", "d"]
    assert names(("v", ">", 4.0)) == ["a", "c"] and names(("v", ">", 5.0)) == ["c"]
    found = L.read_logged_table(spark, str(tmp_path), where=[("v", ">=", 5.0)])
    assert sorted((r.id, r.new) for r in found.collect()) == [(1, None), (3, None)]
    none = L.read_logged_table(spark, str(tmp_path), where=[("id", "<", 0)])
    assert none.count() == 0 and none.columns == ["id", "v", "new"]
    with pytest.raises(ValueError):
        L.read_logged_table(spark, str(tmp_path), where=[("nope", "<", 0)])


def test_removed_added_again_and_removed_all(spark, tmp_path):
    put(spark, tmp_path / "a.parquet", [(1,)], "id bigint")
    commit(tmp_path, 0, *head(spark, "id bigint"), add("a.parquet"))
    commit(tmp_path, 1, {"remove": {"path": "a.parquet"}}, {"commitInfo": {"operation": "DELETE"}})
    commit(tmp_path, 2, add("a.parquet"))
    found = [L.read_logged_table(spark, str(tmp_path), v).count() for v in (0, 1, 2)]
    assert found == [1, 0, 1]


def test_logs_that_cannot_be_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        L.read_snapshot(spark, str(tmp_path))
    commit(tmp_path, 0, *head(spark, "id bigint"), add("a.parquet"))
    commit(tmp_path, 2, add("b.parquet"))
    with pytest.raises(ValueError, match="no commits"):
        L.read_snapshot(spark, str(tmp_path))
    for i, protocol in enumerate(
        [{"minReaderVersion": 2}, {"minReaderVersion": 3, "readerFeatures": ["deletionVectors"]}]
    ):
        root = tmp_path / str(i)
        commit(root, 0, *head(spark, "id bigint", **protocol))
        with pytest.raises(ValueError, match="reader version"):
            L.read_snapshot(spark, str(root))
    broken = tmp_path / "broken"
    commit(broken, 0, *head(spark, "id bigint"), add("a.parquet"))
    log = broken / L.LOG_FOLDER / f"{0:020d}.json"
    log.write_text(log.read_text()[:-20])
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        L.read_snapshot(spark, str(broken))


def test_half_a_checkpoint_is_not_used(spark, tmp_path):
    put(spark, tmp_path / "a.parquet", [(1,)], "id bigint")
    commit(tmp_path, 0, *head(spark, "id bigint"), add("a.parquet"))
    commit(tmp_path, 1, {"commitInfo": {}})
    (tmp_path / L.LOG_FOLDER / f"{1:020d}.checkpoint.{1:010d}.{2:010d}.parquet").write_bytes(b"half")
    found = L.log_files(spark, str(tmp_path))
    assert found.version == 1 and not found.checkpoint and len(found.commits) == 2
    assert L.read_logged_table(spark, str(tmp_path)).count() == 1
