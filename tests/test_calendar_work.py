"""The work of the calendars: what is read, shuffled and dealt to tasks."""

import hashlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from busgrid import catalog
from busgrid.catalog import QUERIES
from busgrid.functions.days import days_of_weeks, runs_of_weeks, weekdays_of
from busgrid.operators import calendars
from busgrid.plans import gtfs

SIGNED_TYPES = (
    "signature string, weekday_mask int, on_working_days boolean, on_holidays boolean, "
    f"loaded_from date, loaded_to date, n_codes int, codes {calendars.CODES_TYPE}"
)


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def optimised(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def by_signature(spark):
    year = (date(2021, 1, 1), date(2021, 12, 31))
    codes = [[], [("6", None, None)], [("2", date(2021, 1, 2), None)]]
    rows = [(str(i), 31, True, True, *year, len(c), c) for i, c in enumerate(codes)]
    return calendars.services_of_signatures(spark.createDataFrame(rows, SIGNED_TYPES))


@pytest.mark.parametrize("name", ["service_days", "calendar", "calendar_services"])
def test_lines_are_worked_out_once(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    # Trips, their fixed codes and their dated codes read the orders; the history reads its lines.
    assert plan.count("o_orderdate") > 0
    assert sum("FileScan" in line and "o_orderdate" in line for line in plan.splitlines()) == 3


def test_calendar_leaves_out_days_that_it_does_not_show(by_signature):
    shown = gtfs.calendar(calendars.services(by_signature))
    assert shown.count() == 2
    grouped = [x for x in optimised(shown).splitlines() if "Aggregate [service_id" in x]
    assert grouped and not any("runs" in x for x in grouped)


def test_signatures_are_dealt_to_all_parts_of_a_shuffle(spark, by_signature):
    assert "REPARTITION_BY_NUM" in plan_of(by_signature)


def test_runs_of_weeks_go_on_over_new_year(spark):
    row = spark.sql("select date'2016-01-04' a, date'2020-12-31' b, 127 m, 1 p")
    runs = runs_of_weeks(F.col("a"), F.col("b"), weekdays_of(F.col("m")), F.col("p"))
    # 2020 is the only year of 53 weeks, and its last one is not over.
    assert row.select(F.size(runs)).first()[0] == 7


def test_weeks_end_with_the_period_near_a_week_53(spark):
    starts = [date(y, 11, 20) + timedelta(i) for y in (1998, 2004, 2009, 2015, 2020) for i in range(50)]
    rows = [(s, s + timedelta(n), p) for s in starts for n in (0, 8, 43, 800) for p in (0, 1)]
    frame = spark.createDataFrame(rows, "a date, b date, p int")
    days = days_of_weeks(F.col("a"), F.col("b"), F.lit(127), F.col("p"))
    for r in frame.withColumn("days", days).collect():
        span = [r.a + timedelta(i) for i in range((r.b - r.a).days + 1)]
        assert sorted(r.days) == [d for d in span if d.isocalendar()[1] % 2 == r.p]


def test_days_of_services_keep_unknown_days(spark):
    services = spark.sql(
        "select * from values"
        " ('a', false, cast(null as int), cast(null as date), cast(null as date),"
        "  array(date'2021-05-01', cast(null as date)), array()),"
        " ('b', false, null, null, null, array(), array()),"
        " ('c', true, 3, date'2021-05-03', date'2021-05-11', array(date'2021-05-08'), array(date'2021-05-04'))"
        " as t(service_id, uses_calendar, mask, period_from, period_to, runs, runs_not)"
    ).withColumn("runs_not", F.col("runs_not").cast("array<date>"))
    found = {(r.service_id, r.day and r.day.day) for r in calendars.service_days(services).collect()}
    assert found == {("a", 1), ("a", None), ("c", 3), ("c", 8), ("c", 10), ("c", 11)}


@pytest.mark.parametrize("order", ["int(signature)", "-int(signature)"])
def test_the_least_signature_tells_days_without_a_date(spark, order):
    year = (date(2021, 1, 1), date(2021, 12, 31))
    day, unknown = ("3", date(2021, 5, 1), None), ("3", None, None)
    rows = [("1", 31, False, False, *year, 2, [unknown, day]), ("2", 31, False, False, *year, 1, [day])]
    signed = spark.createDataFrame(rows, SIGNED_TYPES)
    found = calendars.services_of_signatures(signed).orderBy(F.expr(order)).coalesce(1)
    assert [r.runs for r in calendars.services(found).collect()] == [[None, date(2021, 5, 1)]]


def test_weeks_of_long_periods_meet_every_week_53(spark):
    spans = [(0, 1820), (0, 1824), (0, 1825), (0, 1826), (0, 1827), (0, 1830), (0, 4400)]
    starts = [date(2004, 12, 20) + timedelta(i) for i in range(0, 30, 3)]
    rows = [(s, s + timedelta(n), p) for s in starts for _, n in spans for p in (0, 1)]
    frame = spark.createDataFrame(rows, "a date, b date, p int")
    days = days_of_weeks(F.col("a"), F.col("b"), F.lit(21), F.col("p"))
    for r in frame.withColumn("days", days).collect():
        span = [r.a + timedelta(i) for i in range((r.b - r.a).days + 1)]
        expected = [d for d in span if d.isocalendar()[1] % 2 == r.p and d.weekday() in (0, 2, 4)]
        assert sorted(r.days) == expected


def test_weeks_of_a_whole_line_are_worked_out_once(spark):
    year = (date(2021, 1, 1), date(2021, 12, 31))
    codes = [(kind, date(2021, 1, d), None) for kind in ("5", "6") for d in (2, 3, 4)]
    signed = spark.createDataFrame([("1", 31, False, False, *year, 2, codes)], SIGNED_TYPES)
    dated = calendars.days_of_codes(calendars.with_national_holidays(calendars.service_period(signed)))
    added = dated.first().added
    assert len(added) == len(set(added)) == 261


def test_holidays_are_those_of_the_chosen_codes(spark, sf_dir):
    plan = optimised(QUERIES["calendar_parity"](spark, sf_dir))
    # The codes are chosen before their holidays are made.
    assert plan.index("make_date") < plan.index(" IN (5,6,7,8)")


def test_a_set_of_days_counts_unknown_days_once(spark):
    rows = spark.sql("select 1 trip_number, array(19000, null, 3, 19000, null, -5) n")
    found = catalog._day_sets(rows, "n").first()
    digest = hashlib.md5(b"-5,3,19000").hexdigest()
    assert tuple(found) == (1, 4, "1969-12-27", "2022-01-08", digest)
