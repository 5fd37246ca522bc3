"""Service calendars against a model written with Python sets."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from busgrid.functions import holidays as hol
from busgrid.functions.days import days_of_weeks
from busgrid.operators import calendars

FIXED = [(1, 1), (5, 1), (5, 8), (7, 5), (7, 6), (9, 28), (10, 28), (12, 24), (12, 25), (12, 26)]
# Easter Sundays from published tables.
EASTER = {
    2015: (4, 5), 2016: (3, 27), 2017: (4, 16), 2018: (4, 1), 2019: (4, 21), 2020: (4, 12),
    2021: (4, 4), 2022: (4, 17), 2023: (4, 9), 2024: (3, 31), 2025: (4, 20),
}


def holidays(start, end):
    days = set()
    for year in range(start.year, end.year + 1):
        days |= {date(year, m, d) for m, d in FIXED}
        sunday = date(year, *EASTER[year])
        days |= {sunday - timedelta(2), sunday + timedelta(1)}
    return {d for d in days if start <= d <= end}


def span(start, end):
    return {start + timedelta(i) for i in range((end - start).days + 1)}


def model(mask, working, on_holidays, line, codes):
    """(weekly?, mask, period, runs, runs_not) of one trip; mask is a set of weekdays."""
    mask = set(mask)
    if working:
        mask |= {0, 1, 2, 3, 4}
    if on_holidays:
        mask |= {6}
    if not mask:
        mask = set(range(7))
    start, end = line
    weekly, runs, off = True, set(), set()
    if len(codes) == 1 and codes[0][0] == "1":
        _, start, end = codes[0]
        end = end or start
    else:
        for kind, a, b in codes:
            if kind in "135678":
                weekly = False
            if kind in "56":
                a, b = line
            if kind in "23" or (kind == "1" and b is None):
                runs.add(a)
                continue
            if kind == "4" and b is None:
                off.add(a)
                continue
            if kind not in "145678":
                continue
            days = {d for d in span(a, b) if d.weekday() in mask}
            holiday = holidays(a, b)
            if kind in "5678":
                odd = 1 if kind in "57" else 0
                days = {d for d in days if d.isocalendar()[1] % 2 == odd}
                holiday = {d for d in holiday if d.isocalendar()[1] % 2 == odd}
            weekday_holidays = {d for d in holiday if d.weekday() < 5}
            no_sunday = {d for d in holiday if d.weekday() < 6}
            if kind == "4":
                off |= days | (no_sunday if on_holidays else set())
            elif kind == "1":
                if working and on_holidays:
                    runs |= days | {d for d in holiday if d.weekday() == 5}
                elif working:
                    runs |= days - weekday_holidays
                else:
                    runs |= days | (no_sunday if on_holidays else set())
            else:
                runs |= days - (weekday_holidays if working else set())
                runs |= no_sunday if on_holidays else set()
    if weekly:
        holiday = holidays(start, end)
        if working:
            off |= {d for d in holiday if d.weekday() < 5} - runs
        if on_holidays:
            runs |= {d for d in holiday if d.weekday() < 6} - off
    runs -= off
    return weekly, mask, (start, end), runs, off if weekly else set()


def random_trips(n, seed):
    rng = random.Random(seed)
    day = lambda: date(2016, 1, 1) + timedelta(rng.randrange(3000))
    for i in range(n):
        mask = {d for d in range(7) if rng.random() < 0.3}
        start = date(2018, 1, 1) + timedelta(rng.randrange(900))
        line = (start, start + timedelta(rng.randrange(-5, 500)))
        codes = []
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            kind = rng.choice("123456789")
            a = day()
            b = a + timedelta(rng.randrange(-3, 200)) if kind in "78" or rng.random() < 0.5 else None
            codes.append((kind, a, b))
        if codes and rng.random() < 0.2:
            codes.append(codes[0])
        yield i, mask, rng.random() < 0.4, rng.random() < 0.4, line, codes


@pytest.fixture(scope="module")
def cases():
    return list(random_trips(500, 11))


def inputs(spark, cases):
    trips = spark.createDataFrame(
        [
            ("f", "1", 1, i, sum(1 << d for d in mask), x, p, line[0], line[1])
            for i, mask, x, p, line, _ in cases
        ],
        "feed_id string, line_number string, line_discriminator int, trip_number int, "
        "weekday_mask int, on_working_days boolean, on_holidays boolean, "
        "loaded_from date, loaded_to date",
    )
    codes = spark.createDataFrame(
        [("f", "1", i, *c) for i, *_, codes in cases for c in codes],
        "feed_id string, line_number string, trip_number int, code_type string, "
        "code_from date, code_to date",
    )
    return trips, codes


def test_services_equal_the_model(spark, cases):
    trips, services = calendars.trip_services(*inputs(spark, cases))
    result = trips.select("trip_number", "service_id").join(services, "service_id")
    rows = {r.trip_number: r for r in result.collect()}
    assert len(rows) == len(cases)
    ids = {}
    for i, mask, x, p, line, codes in cases:
        weekly, days, period, runs, off = model(mask, x, p, line, codes)
        r = rows[i]
        assert r.uses_calendar == weekly, (i, codes)
        assert r.runs == sorted(runs), (i, codes)
        assert r.runs_not == sorted(off), (i, codes)
        if weekly:
            assert r.mask == sum(1 << d for d in days)
            assert (r.period_from, r.period_to) == period
            content = (tuple(sorted(days)), period, x, p, tuple(sorted(runs)), tuple(sorted(off)))
        else:
            content = tuple(sorted(runs))
        ids.setdefault(r.service_id, set()).add((weekly, content))
    # One service key per content and the other way round.
    assert all(len(contents) == 1 for contents in ids.values())
    assert len({c for s in ids.values() for c in s}) == len(ids)
    assert services.count() == len(ids)


def test_service_days_are_the_days_of_operation(spark, cases):
    trips, services = calendars.trip_services(*inputs(spark, cases[:150]))
    ids = {r.service_id: r.trip_number for r in trips.select("service_id", "trip_number").collect()}
    days = {}
    for r in calendars.service_days(services).collect():
        assert r.day not in days.setdefault(r.service_id, set())
        days[r.service_id].add(r.day)
    for service, i in ids.items():
        _, mask, x, p, line, codes = cases[i]
        weekly, mask, (a, b), runs, off = model(mask, x, p, line, codes)
        regular = {d for d in span(a, b) if d.weekday() in mask} if weekly else set()
        assert days.get(service, set()) == (regular - off) | runs


def test_holidays(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "year int")
    found = {r.day for r in hol.holiday_table(years).collect()}
    assert found == holidays(date(2015, 1, 1), date(2025, 12, 31))
    extra = {r.day for r in hol.holiday_table(years, [hol.FREEDOM_DAY]).collect()}
    assert extra - found == {date(y, 11, 17) for y in EASTER}


def test_easter_over_centuries(spark):
    def easter(y):  # Butcher's rule, an independent formula
        a, b, c = y % 19, y // 100, y % 100
        d, e = divmod(b, 4)
        g = (8 * b + 13) // 25
        h = (19 * a + b - d - g + 15) % 30
        i, k = divmod(c, 4)
        m = (a + 11 * h) // 319
        r = (2 * e + 2 * i - k - h + m + 32) % 7
        n = (h - m + r + 90) // 25
        return date(y, n, (h - m + r + n + 19) % 32)

    years = spark.range(1700, 2300).select(F.array(F.col("id").cast("int")).alias("y"))
    rows = years.select(F.inline(hol._easter_sundays(F.col("y")))).collect()
    assert [r.easter for r in rows] == [easter(r.y) for r in rows]


def test_days_of_weeks_of_a_parity(spark):
    rng = random.Random(7)
    rows = []
    for n in range(300):
        start = date(2014, 12, 20) + timedelta(rng.randrange(2200))
        end = start + timedelta(rng.choice([-1, 0, 3, 13, 40, 400, 1500]))
        rows.append((n, start, end, rng.choice([127, 31, 64, 5]), n % 2))
    frame = spark.createDataFrame(rows, "n int, a date, b date, mask int, parity int")
    days = days_of_weeks(*map(F.col, ("a", "b", "mask", "parity")))
    found = {r.n: r.days for r in frame.select("n", days.alias("days")).collect()}
    for n, start, end, mask, parity in rows:
        right = {
            d for d in span(start, end) if d.isocalendar()[1] % 2 == parity and mask >> d.weekday() & 1
        }
        assert len(found[n]) == len(right) and set(found[n]) == right
