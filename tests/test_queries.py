"""Every named query against the same rows from a second engine."""

import duckdb
import pytest

import __spark_entry__ as contract
from busgrid.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows
    )


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    found = canonical(df.columns, df.collect())
    check = duck.sql(contract.oracle_sql()[name])
    assert found == canonical(check.columns, check.fetchall())
    assert found[1]
