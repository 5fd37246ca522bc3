"""Sets of days as arrays of DATE or of day numbers. Weekday masks keep Monday in bit 0 and Sunday in bit 6."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
WORKING_DAYS_MASK = 0b0011111
SUNDAY_MASK = 0b1000000
ALL_DAYS_MASK = 0b1111111
RUNS_TYPE = "array<struct<first:int,last:int>>"
# Of a period of fewer days, one week 53 at most ends inside.
ONE_WEEK_53 = 1826


def no_days() -> Column:
    return F.array().cast("array<date>")


def jdf_date(column: str | Column) -> Column:
    """DDMMYYYY text to DATE; empty or malformed text gives NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "ddMMyyyy"))


def no_numbers() -> Column:
    return F.array().cast("array<int>")


def numbers_of(days: str | Column) -> Column:
    """Days as numbers since 1970, for which Spark's set functions are several times as quick."""
    return F.transform(days, F.unix_date)


def days_of(numbers: str | Column) -> Column:
    return F.transform(numbers, F.date_from_unix_date)


def weekdays_of(mask: Column) -> Column:
    """The bits of a mask, 0 to 6."""
    return F.filter(F.array(*map(F.lit, range(7))), lambda i: F.getbit(mask, i) == 1)


def numbers_of_runs(runs: Column, step: int) -> Column:
    """From ``first`` to ``last`` of each run all numbers that are ``step`` apart; not in order.

    No test per day is needed, and each day is copied once, of however many codes the runs are.
    """
    return F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"], F.lit(step))))


def _runs(weekdays: Column, first: Callable[[Column], Column], last: Column) -> Column:
    each = F.transform(weekdays, lambda i: F.struct(first(i).alias("first"), last.alias("last")))
    return F.filter(each, lambda r: r["first"] <= r["last"])


def runs_of_weekdays(start: Column, end: Column, weekdays: Column) -> Column:
    """One weekly run of day numbers per weekday that comes from start to end."""
    number, last = F.unix_date(start), F.unix_date(end)
    ahead = -F.weekday(start)
    return _runs(weekdays, lambda i: number + F.pmod(ahead + i, F.lit(7)), last)


def masked_numbers(start: Column, end: Column, mask: Column) -> Column:
    """Numbers of the days from start to end whose weekday is in the mask; not in order."""
    return numbers_of_runs(runs_of_weekdays(start, end, weekdays_of(mask)), 7)


def week_parity(day: Column) -> Column:
    """1 in odd ISO weeks, 0 in even ones."""
    return F.weekofyear(day) % 2


def runs_of_weeks(start: Column, end: Column, weekdays: Column, parity: Column) -> Column:
    """Runs of day numbers, two weeks apart, of the weekdays in odd (1) or even (0) ISO weeks.

    Week 1 follows week 52, so odd weeks are two weeks apart from year to year, but for
    years of 53 weeks: one run per weekday and stretch of years between those. Most periods
    are one stretch, which their two ends tell.
    """
    first, last = F.unix_date(start), F.unix_date(end)
    monday, last_monday = first - F.weekday(start), last - F.weekday(end)
    # Weeks 53 come five years apart at least, so there is one in between or none.
    same = week_parity(start) == week_parity(end)
    steady = (last - first < ONE_WEEK_53) & (((last_monday - monday) % 14 == 0) == same)

    def stretch(begin: Column, ahead: Column, later: Column) -> Column:
        """From ``begin`` on, whose next week of the parity is ``ahead`` days away."""
        to = F.coalesce(F.array_min(later) - 1, last)
        return F.struct(begin.alias("begin"), ahead.alias("ahead"), to.alias("to"))

    new_years = F.transform(
        F.sequence(F.year(start), F.year(end)), lambda y: F.make_date(y, F.lit(1), F.lit(1))
    )
    # The Mondays after a week 53, which new year is then in.
    breaks = F.filter(
        F.transform(
            F.filter(new_years, lambda d: F.weekofyear(d) == 53),
            lambda d: F.unix_date(F.next_day(d, "Monday")),
        ),
        lambda m: (m > first) & (m <= last),
    )
    to_parity = F.when(week_parity(start) == parity, 0).otherwise(7)
    to_odd = F.when(parity == 1, 0).otherwise(7)

    def stretches(breaks: Column) -> Column:
        of_start = stretch(first, to_parity - F.weekday(start), breaks)
        of_breaks = F.transform(
            breaks, lambda m: stretch(m, to_odd, F.filter(breaks, lambda other: other > m))
        )
        return F.concat(F.array(of_start), of_breaks)

    def runs(part: Column) -> Column:
        begin, ahead = part["begin"], part["ahead"]
        return _runs(weekdays, lambda i: begin + F.pmod(ahead + i, F.lit(14)), part["to"])

    # Arrays of one element, so that what is in them is worked out once.
    one = F.transform(
        F.array(monday + to_parity),
        lambda m: _runs(weekdays, lambda i: first + F.pmod(m - first + i, F.lit(14)), last),
    )
    parts = F.flatten(F.transform(F.array(breaks), stretches))
    inside = F.when(steady, F.flatten(one)).otherwise(F.flatten(F.transform(parts, runs)))
    inside = F.when((start <= end) & parity.isNotNull(), inside)
    return F.coalesce(inside, F.array().cast(RUNS_TYPE))


def days_of_weeks(start: Column, end: Column, mask: Column, parity: Column) -> Column:
    """Days from start to end in odd (1) or even (0) ISO weeks whose weekday is in the mask;

    not in order.
    """
    return days_of(numbers_of_runs(runs_of_weeks(start, end, weekdays_of(mask), parity), 14))


def iso(day: str | Column) -> Column:
    """YYYY-MM-DD."""
    return (F.col(day) if isinstance(day, str) else day).cast("string")


def compact(day: str | Column) -> Column:
    """YYYYMMDD."""
    return F.replace(iso(day), F.lit("-"), F.lit(""))


def joined_days(days: str | Column) -> Column:
    return F.array_join(F.transform(days, iso), ",")


def day_numbers(days: str | Column) -> Column:
    """Days as text of numbers since 1970: the quick text form, for keys and digests."""
    return F.array_join(F.transform(days, F.unix_date), ",")


def joined_numbers(numbers: str | Column) -> Column:
    """The text of ``day_numbers``, of days that are numbers already."""
    n = F.col(numbers) if isinstance(numbers, str) else numbers
    return F.array_join(n.cast("array<string>"), ",")
