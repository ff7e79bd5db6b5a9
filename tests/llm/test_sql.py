"""Queries of the corpus operators against their SQL counterparts."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from sendgate.llm.queries import ORACLES, QUERIES
from tests.test_queries import rows_of

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "labels", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = result.fetchall()
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, expected)
    assert expected


def test_registered():
    assert QUERIES.keys() <= entry_point.queries().keys()
    for number in range(1, 14):
        assert any(name.startswith(f"op{number}_") for name in QUERIES), number
