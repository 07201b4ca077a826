"""Every registered query against its SQL statement, value by value."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract
from loanscope.testbed.registry import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "orders", "customer"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else float(f"{float(value):.11g}")
    if isinstance(value, datetime.date):
        return value.isoformat()[:10]
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return (
        [columns[i] for i in order],
        sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr),
    )


def test_every_query_has_a_statement():
    assert set(queries()) == set(oracles())
    assert set(queries()) <= set(contract.queries()) and set(oracles()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_statement(spark, database, name):
    table = contract.queries()[name](spark, SF)
    found = canonical(table.columns, [tuple(r) for r in table.collect()])
    cursor = database.execute(contract.oracle_sql()[name])
    wanted = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]


def test_entry(spark):
    assert contract.entry(spark).count() == 83
