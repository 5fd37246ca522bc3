"""National holidays as column expressions: no table to join, nothing to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.functions.days import no_days, week_parity

Extra = Sequence[tuple[int, int]]

# Holidays with a fixed (month, day).
FIXED_HOLIDAYS = (
    (1, 1),
    (5, 1),
    (5, 8),
    (7, 5),
    (7, 6),
    (9, 28),
    (10, 28),
    (12, 24),
    (12, 25),
    (12, 26),
)
# Holidays as days counted from Easter Sunday.
EASTER_OFFSETS = (-2, 1)
# The 17 November holiday is not part of the table above; pass this as ``extra`` to add it.
FREEDOM_DAY = (11, 17)


def _easter_sundays(years: Column) -> Column:
    """Gregorian Easter of each year: the first Sunday after the paschal full moon (Gauss).

    Written as steps over small structs, so that no sub-expression is repeated.
    """

    def lunar(y: Column) -> Column:
        century = F.struct(y.alias("y"), F.floor(y / 100).alias("c"))
        c = century["c"]
        shift = (15 + c - F.floor(c / 4) - F.floor((8 * c + 13) / 25)) % 30
        return F.struct(y.alias("y"), ((19 * (y % 19) + shift) % 30).alias("moon"))

    def sunday(s: Column) -> Column:
        late = (s["moon"] == 29) | ((s["moon"] == 28) & (s["y"] % 19 > 10))
        days = s["moon"] - F.when(late, 1).otherwise(0)
        full_moon = F.date_add(F.make_date(s["y"], F.lit(3), F.lit(21)), days.cast("int"))
        return F.struct(s["y"].alias("y"), F.next_day(full_moon, "Sunday").alias("easter"))

    return F.transform(F.transform(years, lunar), sunday)


def holidays_of_years(years: Column, extra: Extra = ()) -> Column:
    """All holidays of an array of years, as one array."""

    def of_year(s: Column) -> Column:
        fixed = [F.make_date(s["y"], F.lit(m), F.lit(d)) for m, d in (*FIXED_HOLIDAYS, *extra)]
        moving = [F.date_add(s["easter"], offset) for offset in EASTER_OFFSETS]
        return F.array(*fixed, *moving)

    return F.flatten(F.transform(_easter_sundays(years), of_year))


def holidays_between(start: Column, end: Column, extra: Extra = ()) -> Column:
    """All holidays from start to end, both included."""
    years = F.sequence(F.year(start), F.year(end))
    inside = F.filter(holidays_of_years(years, extra), lambda d: d.between(start, end))
    return F.when(start <= end, inside).otherwise(no_days())


def except_sunday(
    holidays: Column, start: Column, end: Column, parity: int | None = None
) -> Column:
    """Of the given holidays those from start to end that fall on Monday to Saturday,

    in all weeks or in the odd (1) or even (0) ones.
    """

    def keep(day: Column) -> Column:
        inside = day.between(start, end) & (F.weekday(day) < 6)
        return inside if parity is None else inside & (week_parity(day) == parity)

    return F.filter(holidays, keep)


def monday_to_friday(holidays: Column, start: Column, end: Column) -> Column:
    return F.filter(holidays, lambda d: d.between(start, end) & (F.weekday(d) < 5))


def on_saturday(holidays: Column, start: Column, end: Column) -> Column:
    return F.filter(holidays, lambda d: d.between(start, end) & (F.weekday(d) == 5))


def holiday_table(years: DataFrame, extra: Extra = ()) -> DataFrame:
    """One row per holiday of the distinct years in ``years(year)``."""
    each = years.select(F.col("year").cast("int").alias("year")).distinct()
    days = holidays_of_years(F.array("year"), extra)
    return each.select(F.explode(F.array_distinct(days)).alias("day"))
