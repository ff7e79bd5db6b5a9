"""Every registered query against its SQL counterpart."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from sendgate.oracles import ORACLES
from sendgate.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    got = frame.collect()
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = result.fetchall()
    assert len(got) == len(expected) > 0
    assert rows_of(frame.columns, got) == rows_of(columns, expected)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


FUNNEL = {
    "0.001": (311, 41, 16, 161, 971),
    "0.01": (3122, 1808, 877, 1481, 7712),
    "0.1": (31579, 38545, 16928, 14801, 48147),
}


@pytest.mark.parametrize("scale", sorted(FUNNEL))
def test_known_funnel(spark, scale):
    frame = entry_point.queries()["funnel_counts"](spark, f"/root/testdata/sf{scale}")
    got = tuple(row["count"] for row in frame.orderBy("FILTER_STATUS").collect())
    assert got == FUNNEL[scale]


@pytest.mark.parametrize("scale, total", [("0.001", 1547), ("0.01", 15501), ("0.1", 154951)])
def test_known_fanout_total(spark, scale, total):
    frame = entry_point.queries()["funnel_fanout"](spark, f"/root/testdata/sf{scale}")
    assert frame.agg({"count": "sum"}).first()[0] == total


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["FILTER_STATUS", "count"]
    assert frame.count() == 5
