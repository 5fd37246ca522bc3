"""The wide timetable: one exchange for join, numbers and order."""

from itertools import pairwise

import pytest

from busgrid.catalog import QUERIES
from busgrid.plans import wide

KEYS = "feed_id int, line_number string, line_discriminator int, trip_number bigint"
CALLS = f"{KEYS}, line_no int, tariff_number int, km int, arrival string, departure string, stop_key string"
SERVICE = (
    "service_id string, uses_calendar boolean, mask int, on_working_days boolean, on_holidays boolean,"
    " period_from date, period_to date, runs array<date>, runs_not array<date>"
)


@pytest.fixture(scope="module")
def tables(spark):
    trips = [(f, "10", 1, n, f"l{f}", "s") for f in (1, 2) for n in (7, 8)]
    trips += [(1, "9", 1, 7, "l3", "none"), (1, "10", 1, 8, "l1", "s"), (1, None, 1, 7, "l1", "s")]
    calls = [(f, "10", 1, n, 10 * f + i, i, 20 - i if i % 3 else None, "", f"080{i}", f"k{i % 4}") for f in (1, 2) for n in (7, 8, 9) for i in range(8)]
    calls += [(1, "9", 1, 7, 1, 1, 3, "0700", "", "k1"), (1, None, 1, 7, 1, 1, 3, "0700", "", "k1"), (1, "9", 1, 7, 2, 2, 4, "0800", "", None)]
    stops = spark.createDataFrame([(f"k{i}", i, "a", "b", f"c{i}") for i in range(3)], "stop_key string, stop_number int, municipality string, district string, place string")
    lines = spark.sql(
        "select 1 feed_id, '10' line_number, 1 line_discriminator, 'l1' line_key, 'x' line_name, date'2020-01-01' valid_from, date'2020-12-31' valid_to, 'c' carrier_key, true is_accepted"
        " union all select 2, '10', 1, 'l2', 'y', date'2020-01-01', date'2020-10-31', 'c', true"
        " union all select 1, '9', 1, 'l3', 'z', date'2020-01-01', date'2020-12-31', 'c', true"
    )
    carriers = spark.sql("select 'c' carrier_key, 'name' carrier_name")
    services = spark.sql("select 's', true, 3, true, false, date'2020-01-01', date'2020-12-31', array(date'2020-02-02'), cast(array() as array<date>)").toDF(*[c.split()[0] for c in SERVICE.split(", ")])
    return {
        "calls": spark.createDataFrame(calls, CALLS),
        "lines": lines,
        "trips": spark.createDataFrame(trips, f"{KEYS}, line_key string, service_id string"),
        "services": services,
        "stops": stops,
        "carriers": carriers,
    }


def order(row):
    later = lambda v: (v is None, v)
    return row.line_number, row.trip_number, later(row.km), later(row.time)


@pytest.mark.parametrize("ordered", [True, False])
def test_dealt_rows_are_those_of_separate_joins(tables, ordered):
    dealt = wide.timetable(**tables, ordered=ordered)
    joined = wide.timetable(**tables, ordered=ordered, hot_rows=1)
    rows = dealt.collect()
    assert sorted(map(str, rows)) == sorted(map(str, joined.collect())) and len(rows) > 30
    if ordered:
        assert all(order(a) <= order(b) for a, b in pairwise(rows))


def test_rows_of_a_large_table_come_in_order(spark, sf_dir):
    rows = QUERIES["timetable_wide"](spark, sf_dir).select("line_number", "trip_number", "km", "time").collect()
    assert len(rows) > 1000
    assert all(order(a) <= order(b) for a, b in pairwise(rows))


def test_calls_go_through_one_exchange_to_the_table(tables):
    plan = wide.timetable(**tables)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("REPARTITION_BY_NUM")]
    assert above.count("Exchange") == 1 and "Join" not in above
