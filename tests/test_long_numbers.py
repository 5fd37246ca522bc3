"""Numbers longer than the texts that they are padded to."""

import duckdb
import pytest

from busgrid.catalog import QUERIES
from busgrid.check_sql import CHECKS
from busgrid.sources.tables import SalesTimetable

TABLES = {
    "nation": "select 1 n_nationkey, 'here' n_name",
    "supplier": "select cast(k as bigint) s_suppkey, 's'||k s_name, 1 s_nationkey from (values (0), (1), (2), (3), (4)) t(k)",
    "customer": "select cast(k as bigint) c_custkey, 'c'||k c_name"
    " from (values (7), (123456), (1234561), (1234562), (1234569)) t(k)",
    "orders": "select cast(k as bigint) o_orderkey, cast(c as bigint) o_custkey,"
    " cast('1996-05-01' as timestamp) o_orderdate, '1-URGENT' o_orderpriority"
    " from (values (1, 7), (2, 123456), (3, 1234561), (5, 1234562), (6, 1234569)) t(k, c)",
    "part": "select cast(k as bigint) p_partkey, 'b' p_brand, 't' p_type, 'p'||k p_name"
    " from (values (4), (6), (7), (8)) t(k)",
    "lineitem": "select cast(o as bigint) l_orderkey, cast(p as bigint) l_partkey, cast(1 as bigint) l_suppkey,"
    " n l_linenumber, cast(9 as double) l_quantity, cast(1 as double) l_extendedprice, 'O' l_linestatus,"
    " cast('1996-06-01' as timestamp) l_shipdate"
    " from (values (1), (2), (3), (5), (6)) t(o), (values (4, 1), (6, 2), (7, 3), (8, 4)) s(p, n)",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = str(tmp_path_factory.mktemp("long"))
    for name, text in TABLES.items():
        duckdb.sql(text).write_parquet(f"{at}/{name}.parquet")
    return at


def test_a_line_is_one_customer(spark, folder):
    seen = SalesTimetable(spark, folder).lines.select("line_number", "line_name")
    assert sorted(map(tuple, seen.collect())) == [("000007", "c7"), ("123456", "c123456")]


@pytest.mark.parametrize("name", ["calendar_parity", "timetable_wide", "incremental_tables"])
def test_query_over_long_numbers(spark, folder, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, folder)
    check = duck.sql(CHECKS[name]).select(*[duckdb.ColumnExpression(c) for c in found.columns])
    rows = [sorted(tuple(map(str, r)) for r in x) for x in (found.collect(), check.fetchall())]
    assert rows[0] == rows[1] and rows[0]
