"""Service calendars: weekday codes, dated codes and holidays become sets of days.

What decides about the days of a trip, its flags, period and distinct dated codes, is its
signature. Timetables have few of them, so days are worked out once per signature, as a
projection over one row each; trips carry the key only. The distinct codes of a trip are
an array: a code is a type and two days, and staging rejects spans of more than a century.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.functions.days import (
    ALL_DAYS_MASK,
    SUNDAY_MASK,
    WEEKDAYS,
    WORKING_DAYS_MASK,
    days_of,
    joined_numbers,
    masked_numbers,
    no_days,
    no_numbers,
    numbers_of,
    numbers_of_runs,
    runs_of_weekdays,
    runs_of_weeks,
    week_parity,
    weekdays_of,
)
from busgrid.functions.holidays import (
    Extra,
    except_sunday,
    holidays_of_years,
    monday_to_friday,
)
from busgrid.functions.keys import content_key
from busgrid.session import shuffle_partitions

TRIP_OF_FEED = ["feed_id", "line_number", "trip_number"]

# Types of dated codes.
RUNS_IN = "1"
ALSO_RUNS = "2"
RUNS_ONLY = "3"
DOES_NOT_RUN = "4"
ODD_WEEKS = "5"
EVEN_WEEKS = "6"
ODD_WEEKS_IN = "7"
EVEN_WEEKS_IN = "8"
KNOWN_TYPES = (
    RUNS_IN,
    ALSO_RUNS,
    RUNS_ONLY,
    DOES_NOT_RUN,
    ODD_WEEKS,
    EVEN_WEEKS,
    ODD_WEEKS_IN,
    EVEN_WEEKS_IN,
)
# Types after which the weekly calendar does not count and only the listed days do.
LISTED_DAYS_ONLY = (RUNS_IN, RUNS_ONLY, ODD_WEEKS, EVEN_WEEKS, ODD_WEEKS_IN, EVEN_WEEKS_IN)

CODES_TYPE = "array<struct<code_type:string,code_from:date,code_to:date>>"
SPANS_TYPE = "array<struct<code_type:string,code_from:date,code_to:date,parity:int>>"
# What tells signatures apart.
SIGNED = [
    "weekday_mask",
    "on_working_days",
    "on_holidays",
    "loaded_from",
    "loaded_to",
    "n_codes",
    "codes",
]


def weekly_mask(mask: Column, working: Column, holidays: Column) -> Column:
    """Working days add Monday to Friday, holidays add Sunday; nothing at all means every day."""
    widened = mask.bitwiseOR(F.when(working, WORKING_DAYS_MASK).otherwise(0)).bitwiseOR(
        F.when(holidays, SUNDAY_MASK).otherwise(0)
    )
    return F.when(widened == 0, ALL_DAYS_MASK).otherwise(widened)


def code_is_valid(code_type: Column, code_from: Column, code_to: Column) -> Column:
    """Dated codes need a start, and the two dated week-parity types an end as well."""
    return (
        ~code_type.isin(*KNOWN_TYPES)
        | code_type.isin(ODD_WEEKS, EVEN_WEEKS)
        | (
            code_from.isNotNull()
            & (~code_type.isin(ODD_WEEKS_IN, EVEN_WEEKS_IN) | code_to.isNotNull())
        )
    )


def spanned(code: Column) -> Column:
    """A code with the days it spans and the week parity it asks for.

    The undated week-parity types span the line's validity.
    """
    code_type = code["code_type"]
    whole_line = code_type.isin(ODD_WEEKS, EVEN_WEEKS)
    parity = F.when(code_type.isin(ODD_WEEKS, ODD_WEEKS_IN), 1).when(
        code_type.isin(EVEN_WEEKS, EVEN_WEEKS_IN), 0
    )
    return F.struct(
        code_type.alias("code_type"),
        F.when(whole_line, F.col("loaded_from")).otherwise(code["code_from"]).alias("code_from"),
        F.when(whole_line, F.col("loaded_to")).otherwise(code["code_to"]).alias("code_to"),
        parity.alias("parity"),
    )


def codes_by_trip(codes: DataFrame) -> DataFrame:
    """Number of dated codes of a trip, and its distinct known ones as a sorted array."""
    code = F.struct("code_type", "code_from", "code_to")
    known = F.when(F.col("code_type").isin(*KNOWN_TYPES), code)
    return codes.groupBy(*TRIP_OF_FEED).agg(
        F.count("*").cast("int").alias("n_codes"),
        F.sort_array(F.collect_set(known)).alias("codes"),
    )


def with_codes(trips: DataFrame, codes: DataFrame) -> DataFrame:
    """Trips with their dated codes; none is an empty array."""
    return trips.join(codes_by_trip(codes), TRIP_OF_FEED, "left").withColumns(
        {
            "n_codes": F.coalesce("n_codes", F.lit(0)),
            "codes": F.coalesce("codes", F.array().cast(CODES_TYPE)),
        }
    )


def service_period(trips: DataFrame) -> DataFrame:
    """Weekly mask, period and whether the weekly calendar counts, from the codes of each trip.

    A single code of the first type replaces the line's period by its own. The other
    codes get the days they span.
    """
    first_code = F.get("codes", F.lit(0))
    single = (F.col("n_codes") == 1) & (first_code["code_type"] == RUNS_IN)
    listed = F.exists("codes", lambda c: c["code_type"].isin(*LISTED_DAYS_ONLY))
    only = F.col("single_code")
    spans = F.transform("codes", spanned)
    return (
        trips.withColumn("single_code", F.when(single, first_code))
        .withColumns(
            {
                "mask": weekly_mask(
                    F.col("weekday_mask"), F.col("on_working_days"), F.col("on_holidays")
                ),
                "period_from": F.coalesce(only["code_from"], "loaded_from"),
                "period_to": F.coalesce(only["code_to"], only["code_from"], "loaded_to"),
                "uses_calendar": only.isNotNull() | ~listed,
                "codes": F.when(only.isNotNull(), F.array().cast(SPANS_TYPE)).otherwise(spans),
            }
        )
        .drop("single_code")
    )


def with_national_holidays(trips: DataFrame, extra: Extra = ()) -> DataFrame:
    """Adds the holidays of the years that the period and the ranges of the codes of a trip touch.

    They are made once per trip, for trips that ask for them; all rules then filter
    this short array. Days that a code names one by one ask for no holidays, nor does
    the period of a trip whose weekly calendar does not count.
    """

    def years(start: Column, end: Column) -> Column:
        return F.sequence(F.year(start), F.year(end))

    ranges = F.filter("codes", lambda c: c["code_from"] <= c["code_to"])
    of_codes = F.flatten(F.transform(ranges, lambda c: years(c["code_from"], c["code_to"])))
    period = F.col("uses_calendar") & (F.col("period_from") <= F.col("period_to"))
    of_period = F.when(period, years(F.col("period_from"), F.col("period_to"))).otherwise(
        F.array().cast("array<int>")
    )
    asked = F.col("on_working_days") | F.col("on_holidays")
    holidays = holidays_of_years(F.array_distinct(F.concat(of_period, of_codes)), extra)
    return trips.withColumn("holidays", F.when(asked, holidays).otherwise(no_days()))


def _ranges(code_type: str) -> Column:
    """Codes of a type that name a range of days, which needs both ends."""
    return F.filter(
        "codes",
        lambda c: (c["code_type"] == code_type)
        & c["code_from"].isNotNull()
        & c["code_to"].isNotNull(),
    )


def _weeks() -> Column:
    """Codes of odd or even weeks, those that span the line's validity once each."""
    dated = F.filter(
        "codes", lambda c: c["parity"].isNotNull() & ~c["code_type"].isin(ODD_WEEKS, EVEN_WEEKS)
    )
    whole = [F.filter("codes", lambda c: c["code_type"] == kind) for kind in (ODD_WEEKS, EVEN_WEEKS)]
    return F.concat(dated, *[F.slice(codes, 1, 1) for codes in whole])


def _single_days(*types: str) -> Column:
    """The days of codes that name one day: ranges are of two types only."""
    ranged = lambda c: c["code_type"].isin(RUNS_IN, DOES_NOT_RUN) & c["code_to"].isNotNull()
    single = F.filter("codes", lambda c: c["code_type"].isin(*types) & ~ranged(c))
    return F.transform(single, lambda c: F.unix_date(c["code_from"]))


def _days_in(codes: str) -> Column:
    """Days of ranges that are of the mask."""
    weekdays = F.col("weekdays")
    runs = F.transform(codes, lambda c: runs_of_weekdays(c["code_from"], c["code_to"], weekdays))
    return numbers_of_runs(F.flatten(runs), 7)


def _days_of_weeks_in(codes: str) -> Column:
    """Days of ranges of odd or even weeks that are of the mask."""
    weekdays = F.col("weekdays")
    runs = F.transform(
        codes, lambda c: runs_of_weeks(c["code_from"], c["code_to"], weekdays, c["parity"])
    )
    return numbers_of_runs(F.flatten(runs), 14)


def _met_by(codes: str, day: Column) -> Column:
    """Whether a day is in the range, and in weeks of the parity, of any of the codes."""
    return F.exists(
        codes,
        lambda c: day.between(c["code_from"], c["code_to"])
        & (c["parity"].isNull() | (week_parity(day) == c["parity"])),
    )


def days_of_codes(trips: DataFrame) -> DataFrame:
    """Adds ``added`` and ``excluded``: numbers of the days that the dated codes of each trip name.

    A day may come more than once. Working-day trips leave holidays out, holiday trips gain
    them. Trips that are both gain only Saturdays from a range and leave holidays out of
    alternating weeks only. Codes of one kind are worked out together: a day of theirs that
    is a holiday is one whichever of them names it.
    """
    working, on_holidays = F.col("on_working_days"), F.col("on_holidays")
    weekday_holidays = numbers_of(F.filter("holidays", lambda d: F.weekday(d) < 5))

    def without_holidays(codes: str, days: str, asked: Column) -> Column:
        left = F.array_except(days, weekday_holidays)
        return F.when(asked & (F.size(codes) > 0), left).otherwise(F.col(days))

    def holidays_met(met: Callable[[Column], Column]) -> Column:
        return numbers_of(F.filter("holidays", lambda d: (F.weekday(d) < 6) & met(d)))

    gained = F.when(
        on_holidays & (F.size("ranges") + F.size("weeks") > 0),
        holidays_met(
            lambda d: (_met_by("ranges", d) & (~working | (F.weekday(d) == 5)))
            | _met_by("weeks", d)
        ),
    ).otherwise(no_numbers())
    also_excluded = F.when(
        on_holidays & (F.size("breaks") > 0), holidays_met(lambda d: _met_by("breaks", d))
    ).otherwise(no_numbers())
    parts = {
        "weekdays": weekdays_of(F.col("mask")),
        "ranges": _ranges(RUNS_IN),
        "breaks": _ranges(DOES_NOT_RUN),
        "weeks": _weeks(),
    }
    days = {"in_ranges": _days_in("ranges"), "in_weeks": _days_of_weeks_in("weeks")}
    added = F.concat(
        without_holidays("ranges", "in_ranges", working & ~on_holidays),
        without_holidays("weeks", "in_weeks", working),
        _single_days(RUNS_IN, ALSO_RUNS, RUNS_ONLY),
        gained,
    )
    excluded = F.concat(_days_in("breaks"), _single_days(DOES_NOT_RUN), also_excluded)
    return (
        trips.withColumns(parts)
        .withColumns(days)
        .withColumns({"added": added, "excluded": excluded})
        .drop(*parts, *days)
    )


def with_holidays(trips: DataFrame) -> DataFrame:
    """Where the weekly calendar counts: working-day trips skip holidays, holiday trips gain them."""
    holidays, start, end = F.col("holidays"), F.col("period_from"), F.col("period_to")
    skipped = F.array_except(numbers_of(monday_to_friday(holidays, start, end)), F.col("added"))
    gained = F.array_except(numbers_of(except_sunday(holidays, start, end)), F.col("excluded"))
    on = F.col("uses_calendar")
    return trips.withColumn(
        "excluded",
        F.when(on & F.col("on_working_days"), F.array_union("excluded", skipped)).otherwise(
            F.col("excluded")
        ),
    ).withColumn(
        "added",
        F.when(on & F.col("on_holidays"), F.array_union("added", gained)).otherwise(
            F.col("added")
        ),
    )


def service_content(trips: DataFrame) -> DataFrame:
    """Final day sets and the service key, which is made of everything that tells services apart."""
    days = trips.withColumns(
        {
            "runs": F.sort_array(F.array_except("added", "excluded")),
            "runs_not": F.when(
                F.col("uses_calendar"), F.sort_array(F.array_distinct("excluded"))
            ).otherwise(no_numbers()),
        }
    ).drop("added", "excluded")
    weekly = content_key(
        F.lit("weekly"),
        "mask",
        "period_from",
        "period_to",
        F.col("on_working_days").cast("int"),
        F.col("on_holidays").cast("int"),
        joined_numbers("runs"),
        joined_numbers("runs_not"),
    )
    listed = content_key(F.lit("listed"), joined_numbers("runs"))
    return days.withColumn(
        "service_id", F.when(F.col("uses_calendar"), weekly).otherwise(listed)
    ).withColumns({c: days_of(c) for c in ("runs", "runs_not")})


def signed(trips: DataFrame, codes: DataFrame) -> DataFrame:
    """Trips with their dated codes and signature.

    ``trips`` carry the flags of ``fixed_code_flags`` and the validity of their line. No
    rows are exchanged but for the join with the codes.
    """
    rows = with_codes(trips, codes).withColumn("n_codes", F.least("n_codes", F.lit(2)))
    # More than one code is all that the rules ask about the number.
    return rows.withColumn("signature", F.md5(F.to_json(F.struct(*SIGNED))))


def services_of_signatures(signed_trips: DataFrame, extra: Extra = ()) -> DataFrame:
    """One row per signature: its service with mask, period, ``runs`` and ``runs_not``.

    The columns of services that only list days are empty but for those days. Rows of
    signatures are short and take long, so they are dealt to as many tasks as shuffles have
    parts: by their bytes alone they would be a few tasks.
    """
    once = signed_trips.select("signature", *SIGNED).dropDuplicates(["signature"])
    # By another hash: rows that lie by signature already would stay in those few tasks.
    parts = shuffle_partitions(signed_trips.sparkSession)
    once = once.repartition(parts, F.xxhash64("signature"))
    dated = days_of_codes(with_national_holidays(service_period(once), extra))
    content = service_content(with_holidays(dated.drop("n_codes", "codes")).drop("holidays"))
    own = {
        c: F.when(F.col("uses_calendar"), F.col(c))
        for c in ("mask", "period_from", "period_to", "on_working_days", "on_holidays")
    }
    return content.withColumns(own).select("signature", *SERVICE_COLUMNS)


def with_service_id(signed_trips: DataFrame, by_signature: DataFrame) -> DataFrame:
    """Trips with the key of their service, without what it is made of."""
    keys = by_signature.select("signature", "service_id")
    return signed_trips.join(keys, "signature").drop("n_codes", "codes", "signature")


def trip_services(
    trips: DataFrame, codes: DataFrame, extra: Extra = ()
) -> tuple[DataFrame, DataFrame]:
    """Trips with ``service_id``, and the services."""
    rows = signed(trips, codes)
    by_signature = services_of_signatures(rows, extra)
    return with_service_id(rows, by_signature), services(by_signature)


SERVICE_COLUMNS = [
    "service_id",
    "uses_calendar",
    "mask",
    "period_from",
    "period_to",
    "on_working_days",
    "on_holidays",
    "runs",
    "runs_not",
]


def services(by_signature: DataFrame) -> DataFrame:
    """Distinct services; different signatures may come to the same days."""
    return first_content(by_signature.select("signature", *SERVICE_COLUMNS))


def first_content(content: DataFrame) -> DataFrame:
    """One row per service, whose key tells all of its content but for days without a date.

    Of those the least signature decides. Columns that nobody asks for are not shuffled, nor are
    services of a kind that nobody asks for.
    """
    kind, days = ["service_id", "uses_calendar"], ["runs", "runs_not"]
    others = [c for c in content.columns if c not in [*kind, *days, "signature"]]
    return content.groupBy(*kind).agg(
        *[F.first(c).alias(c) for c in others],
        *[F.min_by(c, "signature").alias(c) for c in days],
    )


def weekday_flags() -> dict[str, Column]:
    """monday to sunday as 0 and 1."""
    return {
        day: F.getbit("mask", F.lit(bit)).cast("int") for bit, day in enumerate(WEEKDAYS)
    }


def service_days(services: DataFrame) -> DataFrame:
    """One row per service and day on which it runs."""
    regular = masked_numbers(F.col("period_from"), F.col("period_to"), F.col("mask"))
    runs, runs_not = numbers_of("runs"), numbers_of("runs_not")
    days = F.when(
        F.col("uses_calendar"), F.array_union(F.array_except(regular, runs_not), runs)
    ).otherwise(F.array_distinct(runs))
    # An outer explode works the days out once: for a plain one, Spark first filters by their number.
    return (
        services.select("service_id", days.alias("days"))
        .select("service_id", F.posexplode_outer("days").alias("place", "number"))
        .filter("place is not null")
        .select("service_id", F.date_from_unix_date("number").alias("day"))
    )
