"""The seven GTFS tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.functions.days import WEEKDAYS, compact
from busgrid.operators import calendars, sequences, stoptimes

# Fixed values of the output.
TIMEZONE = "Europe/Prague"
LANGUAGE = "cs"
ROUTE_TYPES = {"E": 0, "M": 1, "L": 6, "P": 4}
BUS = 3


def agency(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        F.col("carrier_key").alias("agency_id"),
        F.concat("carrier_name", F.lit(", "), "seat").alias("agency_name"),
        F.concat(F.lit("http://"), "www").alias("agency_url"),
        F.lit(TIMEZONE).alias("agency_timezone"),
        F.lit(LANGUAGE).alias("agency_lang"),
        F.col("phone_seat").alias("agency_phone"),
        F.col("email").alias("agency_email"),
    )


def calendar(services: DataFrame) -> DataFrame:
    """Services with a weekly calendar."""
    return services.filter("uses_calendar").select(
        "service_id",
        *[c.alias(day) for day, c in calendars.weekday_flags().items()],
        compact("period_from").alias("start_date"),
        compact("period_to").alias("end_date"),
    )


def calendar_dates(services: DataFrame) -> DataFrame:
    """One row per service and exceptional day: 1 runs, 2 does not run."""

    def exceptions(days: str, exception_type: int) -> Column:
        return F.transform(
            days,
            lambda d: F.struct(
                d.alias("day"),
                F.lit(exception_type).alias("exception_type"),
            ),
        )

    both = F.concat(exceptions("runs", 1), exceptions("runs_not", 2))
    # The text of a day is made after that, by whoever asks for it.
    return services.select("service_id", F.inline(both)).select(
        "service_id", compact("day").alias("date"), "exception_type"
    )


def route_type(vehicle: Column) -> Column:
    kind = F.lit(BUS)
    for letter, number in ROUTE_TYPES.items():
        kind = F.when(vehicle == letter, number).otherwise(kind)
    return kind


def routes(lines: DataFrame) -> DataFrame:
    return lines.filter("is_current").select(
        F.col("line_key").alias("route_id"),
        F.col("carrier_key").alias("agency_id"),
        F.col("line_number").alias("route_short_name"),
        F.col("line_name").alias("route_long_name"),
        route_type(F.col("vehicle")).alias("route_type"),
    )


def stop_times(
    calls: DataFrame,
    trips: DataFrame,
    hot_rows: int | None = sequences.HOT_ROWS,
    counted: DataFrame | None = None,
    clock: stoptimes.Clock = stoptimes.gtfs_time,
) -> DataFrame:
    return stoptimes.stop_times(calls, trips, hot_rows, counted, clock).select(
        F.col("trip_key").alias("trip_id"),
        "arrival_time",
        "departure_time",
        F.col("stop_key").alias("stop_id"),
        "stop_sequence",
    )


def stop_name() -> Column:
    return F.concat("municipality", F.lit(","), "district", F.lit(","), "place")


def stops(
    stops: DataFrame, locations: DataFrame | None = None, by_number: bool = False
) -> DataFrame:
    """Stops with coordinates, found by stop number or by the composed name, else 0."""
    named = stops.withColumn("stop_name", stop_name())
    if locations is None:
        located = named.withColumns({"x": F.lit(0.0), "y": F.lit(0.0)})
    else:
        key = "stop_number" if by_number else "stop_name"
        located = named.join(locations.select(key, "x", "y"), key, "left")
    return located.select(
        F.col("stop_key").alias("stop_id"),
        "stop_name",
        F.coalesce("x", F.lit(0.0)).alias("stop_lat"),
        F.coalesce("y", F.lit(0.0)).alias("stop_lon"),
    )


def trips(trips: DataFrame) -> DataFrame:
    return trips.filter("is_current").select(
        F.col("line_key").alias("route_id"),
        "service_id",
        F.col("trip_key").alias("trip_id"),
    )


COLUMNS = {
    "agency": [
        "agency_id",
        "agency_name",
        "agency_url",
        "agency_timezone",
        "agency_lang",
        "agency_phone",
        "agency_email",
    ],
    "calendar": ["service_id", *WEEKDAYS, "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "trips": ["route_id", "service_id", "trip_id"],
}
