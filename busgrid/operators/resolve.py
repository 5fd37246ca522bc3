"""Resolves natural keys between the staged tables; unmatched rows become rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.functions.keys import company_number, line_key, trip_key
from busgrid.functions.times import has_time, is_served
from busgrid.operators import identity

LINE = ["feed_id", "line_number", "line_discriminator"]
TRIP = [*LINE, "trip_number"]
CARRIER_OF_FEED = ["feed_id", "company", "carrier_discriminator"]

# The fixed codes that stand for a weekday, Monday to Sunday, and
# those for working days and for Sundays and holidays.
WEEKDAY_CODES = ("1", "2", "3", "4", "5", "6", "7")
WORKING_DAY_CODE = "X"
HOLIDAY_CODE = "+"
CODE_SLOTS = 9


def with_company(rows: DataFrame) -> DataFrame:
    return rows.withColumn("company", company_number("ico"))


def lines(staged: DataFrame, staged_carriers: DataFrame) -> DataFrame:
    """Lines with the carrier found by company number and discriminator of the same feed."""
    return (
        with_company(staged)
        .join(identity.carriers_of_feed(staged_carriers), CARRIER_OF_FEED, "left")
        .drop("company")
        .withColumn("line_key", line_key())
    )


def trip_carriers(
    trips: DataFrame, lines: DataFrame, alternatives: DataFrame, staged_carriers: DataFrame
) -> DataFrame:
    """The carrier of each trip: its alternative carrier if it has one, else the line's.

    Alternatives are given per line and trip number; the last row of a feed wins.
    """
    alternative = (
        with_company(alternatives)
        .join(identity.carriers_of_feed(staged_carriers), CARRIER_OF_FEED)
        .groupBy("feed_id", "line_number", "trip_number")
        .agg(F.max_by("carrier_key", "line_no").alias("alternative_key"))
    )
    return (
        trips.join(lines.select(*LINE, F.col("carrier_key").alias("line_carrier_key")), LINE)
        .join(alternative, ["feed_id", "line_number", "trip_number"], "left")
        .withColumn("carrier_key", F.coalesce("alternative_key", "line_carrier_key"))
        .drop("alternative_key", "line_carrier_key")
    )


def code_dictionary(fixed_codes: DataFrame) -> DataFrame:
    """One map per feed from fixed code number to meaning; the last row of a code wins.

    A map holds the distinct code numbers of one feed, which the format writes in
    two characters.
    """
    return (
        fixed_codes.groupBy("feed_id", "code_id")
        .agg(F.max_by("meaning", "line_no").alias("meaning"))
        .groupBy("feed_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("code_id", "meaning"))).alias("meanings"))
    )


def fixed_code_flags(
    trips: DataFrame, fixed_codes: DataFrame, slots: int = CODE_SLOTS
) -> DataFrame:
    """Weekday mask as written, working-day and holiday flag, and the codes without a meaning."""
    used = F.filter(F.slice("code_ids", 1, slots), lambda code: code != "")
    meaning = F.transform(
        F.col("used_codes"), lambda code: F.element_at(F.col("meanings"), code)
    )

    def has(code: str) -> Column:
        return F.coalesce(F.array_contains("code_meanings", code), F.lit(False))

    mask = F.lit(0)
    for bit, code in enumerate(WEEKDAY_CODES):
        mask = mask + F.when(has(code), 1 << bit).otherwise(0)
    no_meanings = F.create_map().cast("map<string,string>")
    return (
        trips.join(code_dictionary(fixed_codes), "feed_id", "left")
        .withColumn("meanings", F.coalesce("meanings", no_meanings))
        .withColumn("used_codes", used)
        .withColumn("code_meanings", meaning)
        .withColumns(
            {
                "weekday_mask": mask,
                "on_working_days": has(WORKING_DAY_CODE),
                "on_holidays": has(HOLIDAY_CODE),
                "unknown_codes": F.filter(
                    "used_codes", lambda code: ~F.map_contains_key(F.col("meanings"), code)
                ),
            }
        )
        .drop("meanings", "used_codes", "code_meanings")
    )


def served_calls(staged_calls: DataFrame) -> DataFrame:
    """Calls at which the trip stops; format 1.10 also leaves out calls without any time."""
    served = is_served(F.col("arrival"), F.col("departure"))
    if "drops_untimed" in staged_calls.columns:
        timed = has_time(F.col("arrival"), F.col("departure"))
        served = served & (~F.col("drops_untimed") | timed)
    return staged_calls.filter(served)


def stop_calls(
    staged_calls: DataFrame,
    staged_stops: DataFrame,
    by_number: bool = False,
    more: DataFrame | None = None,
) -> DataFrame:
    """Served calls with their stop key; ``stop_key`` is NULL where the feed has no such stop.

    Whether the trip exists is a second question, see ``attached_calls``. ``more`` has one row
    per stop key, which the stops of feeds are joined with, so that calls are joined once.
    """
    of_feed = identity.stops_of_feed(staged_stops, by_number, more)
    return served_calls(staged_calls).join(of_feed, ["feed_id", "stop_number"], "left")


def attached_trips(trips: DataFrame, lines: DataFrame) -> DataFrame:
    """Trips of accepted line versions with the line's key, validity and state."""
    accepted = lines.filter("is_accepted").select(
        *LINE, "line_key", "loaded_from", "loaded_to", "is_current"
    )
    return trips.join(accepted, LINE).withColumn("trip_key", trip_key())


def attached_calls(calls: DataFrame, trips: DataFrame) -> DataFrame:
    """Calls whose trip was attached and whose stop is known."""
    return calls.filter("stop_key is not null").join(trips.select(*TRIP), TRIP, "left_semi")


# What becomes of a trip: its line was not accepted, it was rejected, or it is one of the trips.
KNOWN, LOST, ATTACHED = 0, 1, 2


def trip_states(flagged: DataFrame, lines: DataFrame, unknown_codes: Column) -> DataFrame:
    """The state of each trip of ``flagged``, which has a row per trip."""
    accepted = lines.groupBy(*LINE).agg(F.max(F.col("is_accepted").cast("int")).alias("accepted"))
    state = (
        F.when(F.coalesce(unknown_codes, F.lit(True)) | F.col("accepted").isNull(), LOST)
        .when(F.col("accepted") == 1, ATTACHED)
        .otherwise(KNOWN)
    )
    return flagged.join(accepted, LINE, "left").select(*TRIP, state.alias("trip_state"))


def with_trip_state(calls: DataFrame, states: DataFrame) -> DataFrame:
    """Calls with the state of their trip, NULL where there is none."""
    return calls.join(states, TRIP, "left")


def of_keys(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the given keys, of which a part may be NULL."""
    named = keys.select(*[F.col(c).alias(f"key_{c}") for c in by])
    same = [rows[c].eqNullSafe(named[f"key_{c}"]) for c in by]
    return rows.join(named, reduce(lambda a, b: a & b, same), "left_semi").select(
        *by, *[c for c in rows.columns if c not in by]
    )


def rejected(rows: DataFrame, table: str, reason: str, condition: Column) -> DataFrame:
    """Rows that fail a condition, in the common shape of the rejects table."""
    content = F.to_json(F.struct(*[c for c in rows.columns if c != "feed_id"]))
    return rows.filter(condition).select(
        F.col("feed_id").cast("string").alias("feed_id"),
        F.lit(table).alias("table"),
        F.lit(reason).alias("reason"),
        content.alias("content"),
    )

