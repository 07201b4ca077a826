"""Queries that SQL can express against their statements, value by value."""

import duckdb
import pytest

from loanscope.llm.oracles import oracles
from loanscope.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_statements_belong_to_queries():
    assert set(oracles()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_statement(spark, database, name):
    table = queries()[name](spark, SF)
    cursor = database.execute(oracles()[name])
    wanted = [d[0] for d in cursor.description]
    assert sorted(table.columns) == sorted(wanted)
    found = [tuple(r) for r in table.select(*wanted).collect()]
    assert sorted(found, key=repr) == sorted(cursor.fetchall(), key=repr)
