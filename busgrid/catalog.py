"""Named queries over the sales tables in timetable shape."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from busgrid.functions import holidays as hol
from busgrid.functions.days import (
    compact,
    day_numbers,
    days_of,
    iso,
    joined_days,
    joined_numbers,
)
from busgrid.functions.keys import line_key, trip_key
from busgrid.functions.times import gtfs_time_by_minute, has_time
from busgrid.operators import calendars, history, identity, resolve, stoptimes
from busgrid.plans import gtfs, integrity, wide
from busgrid.plans.convert import Options
from busgrid.plans.kept import KeptTables
from busgrid.session import work_folder, written
from busgrid.sources import feeds
from busgrid.sources.locations import read_locations
from busgrid.sources.records import records_of_lines
from busgrid.sources.staging import Staged
from busgrid.sources.tables import SalesTimetable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[SalesTimetable], DataFrame]) -> Callable[[SalesTimetable], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(SalesTimetable(spark, folder))
    return build


def _text(day: str) -> Column:
    return iso(day).alias(day)


def _int(flag: str) -> Column:
    return F.col(flag).cast("int").alias(flag)


def _long(number: str) -> Column:
    return F.col(number).cast("long").alias(number)


# --- parts shared by several queries


def _lines(t: SalesTimetable, keep_history: bool = True) -> DataFrame:
    versions = history.line_history if keep_history else history.without_history
    return versions(resolve.lines(t.lines, t.carriers))


def _versions(t: SalesTimetable) -> DataFrame:
    """Line versions where no carrier is needed: one join less."""
    kept = [*resolve.LINE, "feed_seq", "valid_from", "valid_to"]
    # The history reads its rows three times.
    lines = written(t.lines.select(*kept), "lines")
    return history.line_history(lines).withColumn("line_key", line_key())


def _flagged_trips(t: SalesTimetable) -> DataFrame:
    return resolve.fixed_code_flags(t.trips, t.fixed_codes)


def _trips_of_all_lines(t: SalesTimetable) -> DataFrame:
    lines = history.without_history(t.lines).withColumn("line_key", line_key())
    return resolve.attached_trips(_flagged_trips(t), lines)


def _attached(t: SalesTimetable) -> DataFrame:
    return resolve.attached_trips(t.trips, _versions(t))


def _signed(t: SalesTimetable) -> DataFrame:
    return calendars.signed(
        resolve.attached_trips(_flagged_trips(t), _versions(t)), t.time_codes
    )


def _services(t: SalesTimetable) -> DataFrame:
    return calendars.services(calendars.services_of_signatures(_signed(t)))


def _calls(t: SalesTimetable) -> DataFrame:
    return resolve.stop_calls(t.calls, t.stops)


# --- raw rows and layouts


@query
def version_layout(t: SalesTimetable) -> DataFrame:
    """Lines and trips read by the layout of their feed's version."""
    accepted, _ = feeds.with_layout(t.raw_rows)
    staged = Staged(accepted)
    lines = staged.lines.select(
        "feed_id",
        F.lit("lines").alias("table"),
        "line_number",
        F.col("line_name").alias("label"),
        F.coalesce("vehicle", F.lit("")).alias("vehicle"),
        iso("valid_from").alias("valid_from"),
        iso("valid_to").alias("valid_to"),
        "line_discriminator",
    )
    trips = staged.trips.select(
        "feed_id",
        F.lit("trips").alias("table"),
        "line_number",
        F.concat(
            F.col("trip_number").cast("string"),
            F.lit(":"),
            F.array_join(F.filter("code_ids", lambda c: c != ""), "/"),
        ).alias("label"),
        F.lit("").alias("vehicle"),
        F.lit("").alias("valid_from"),
        F.lit("").alias("valid_to"),
        "line_discriminator",
    )
    return lines.unionByName(trips)


@query
def arity_guard(t: SalesTimetable) -> DataFrame:
    """Rows per feed, table and reason; accepted ones have an empty reason."""
    accepted, rejects = feeds.with_layout(t.raw_rows)
    told = accepted.select("feed_id", "table", F.lit("").alias("reason"))
    return (
        told.unionByName(rejects.select("feed_id", "table", "reason"))
        .groupBy("feed_id", "table", "reason")
        .agg(F.count("*").alias("n_rows"))
    )


@query
def record_fields(t: SalesTimetable) -> DataFrame:
    """Fields of the records of files given as lines, with line ends of both kinds."""
    texts = records_of_lines(t.record_lines).select(
        F.lit("parts").alias("feed_id"),
        F.lit("stops").alias("table"),
        F.shiftright("pos", 1).alias("line_no"),  # two lines a record
        "text",
        "problem",
    )
    fields = feeds.without_record_end(F.col("fields"))
    rows = feeds.parsed(texts).withColumn("f", fields)
    return rows.select(
        _long("line_no"),
        F.size("f").alias("n_fields"),
        *[F.get("f", F.lit(i)).alias(f"field_{i}") for i in range(4)],
        F.coalesce("problem", F.lit("")).alias("problem"),
    )


@query
def call_layout(t: SalesTimetable) -> DataFrame:
    """Calls read by the layout of their feed's version, without those that cannot be read."""
    accepted, _ = feeds.with_layout(t.raw_calls)
    return Staged(accepted).calls.select(
        "feed_id",
        "line_number",
        "line_discriminator",
        _long("trip_number"),
        "tariff_number",
        _long("stop_number"),
        "km",
        "arrival",
        "departure",
        _int("drops_untimed"),
    )


@query
def rejects(t: SalesTimetable) -> DataFrame:
    """Call rows that are not taken, by feed and reason."""
    accepted, of_layout = feeds.with_layout(t.raw_calls)
    found = reduce(DataFrame.unionByName, Staged(accepted).rejects(), of_layout)
    return found.groupBy("feed_id", "table", "reason").agg(F.count("*").alias("n_rows"))


@query
def stop_posts(t: SalesTimetable) -> DataFrame:
    """Posts of stops, which the newer two versions have, without those that cannot be read."""
    accepted, _ = feeds.with_layout(t.raw_posts)
    return Staged(accepted).stop_posts.select(
        "feed_id", _long("stop_number"), "post_number", "post_name", "direction", "stand"
    )


@query
def fixed_code_dictionary(t: SalesTimetable) -> DataFrame:
    """Meaning of each code number of a feed; the last row of a number counts."""
    return resolve.code_dictionary(t.fixed_codes).select(
        "feed_id", F.explode("meanings").alias("code_id", "meaning")
    )


# --- calls and their times


@query
def stop_calls(t: SalesTimetable) -> DataFrame:
    calls = resolve.attached_calls(_calls(t), _attached(t))
    return calls.select(
        trip_key().alias("trip_id"),
        F.col("stop_key").alias("stop_id"),
        "tariff_number",
        "km",
        "arrival",
        "departure",
    )


@query
def trip_first_departure(t: SalesTimetable) -> DataFrame:
    timed = resolve.served_calls(t.calls).filter(has_time(F.col("arrival"), F.col("departure")))
    return stoptimes.first_departures(timed).select("feed_id", "trip_number", "first_departure")


@query
def stop_times(t: SalesTimetable) -> DataFrame:
    return gtfs.stop_times(_calls(t), _attached(t), counted=t.items_per_trip)


@query
def stop_times_by_minute(t: SalesTimetable) -> DataFrame:
    """Stop times where any time before the first departure is of the next day."""
    clock = gtfs_time_by_minute
    return gtfs.stop_times(_calls(t), _attached(t), counted=t.items_per_trip, clock=clock)


# --- carriers, stops, lines, trips


@query
def carriers(t: SalesTimetable) -> DataFrame:
    return identity.carriers(t.carriers).select(
        F.col("carrier_key").alias("carrier_id"),
        "ico",
        "carrier_name",
        "seat",
        "www",
        F.col("feed_seq").cast("int").alias("first_feed"),
    )


@query
def agency(t: SalesTimetable) -> DataFrame:
    return gtfs.agency(identity.carriers(t.carriers))


def _stop_rows(stops: DataFrame) -> DataFrame:
    return stops.select(
        F.col("stop_key").alias("stop_id"),
        _long("stop_number"),
        "municipality",
        "district",
        "place",
        F.col("feed_seq").cast("int").alias("first_feed"),
    )


@query
def stops(t: SalesTimetable) -> DataFrame:
    return _stop_rows(identity.stops(t.stops))


@query
def stops_by_id(t: SalesTimetable) -> DataFrame:
    return _stop_rows(identity.stops(t.stops, by_number=True))


@query
def stop_locations(t: SalesTimetable) -> DataFrame:
    """Locations written as a file and read from it."""
    folder = work_folder(t.spark, "locations")
    rows = t.locations_by_name.select("stop_name", "x", "y")
    rows.write.option("escape", '"').csv(folder)
    return read_locations(t.spark, folder)


@query
def gtfs_stops(t: SalesTimetable) -> DataFrame:
    return gtfs.stops(identity.stops(t.stops))


@query
def stops_geo_by_id(t: SalesTimetable) -> DataFrame:
    stops = identity.stops(t.stops, by_number=True)
    return gtfs.stops(stops, t.locations_by_number, by_number=True)


@query
def stops_geo_by_name(t: SalesTimetable) -> DataFrame:
    return gtfs.stops(identity.stops(t.stops), t.locations_by_name)


@query
def lines(t: SalesTimetable) -> DataFrame:
    return _lines(t, keep_history=False).select(
        F.col("line_key").alias("line_id"),
        F.col("carrier_key").alias("carrier_id"),
        "line_number",
        "line_name",
        "vehicle",
        _text("valid_from"),
        _text("valid_to"),
        _int("is_current"),
    )


@query
def line_history(t: SalesTimetable) -> DataFrame:
    return _history_rows(history.line_history(t.lines))


def _history_rows(lines: DataFrame) -> DataFrame:
    return lines.select(
        _int("feed_id"),
        _int("feed_seq"),
        "line_number",
        _text("valid_from"),
        _text("loaded_to"),
        _text("valid_to"),
        _int("is_accepted"),
        _int("is_current"),
    )


@query
def incremental_load(t: SalesTimetable) -> DataFrame:
    """Feeds that arrive later, added to the kept state of the earlier ones."""
    earlier = history.line_history(t.lines.filter("feed_seq < 4"))
    arriving = t.lines.filter("feed_seq >= 4")
    return _history_rows(history.extend_history(earlier, arriving))


@query
def incremental_tables(t: SalesTimetable) -> DataFrame:
    """Kept tables after a first load and two more, by key, reference, feed and state."""
    kept = KeptTables(t.spark, work_folder(t.spark, "kept"), Options(keep_history=True))
    for load, staged in enumerate(t.loads(2, 4)):
        kept.add(staged, t.no_rejects, staged.feed_order, load)

    def rows(name: str, key: Column, parent: Column, state: Column, until: Column) -> DataFrame:
        return kept.read(name).select(
            F.lit(name).alias("table"),
            key.alias("key"),
            parent.alias("parent"),
            F.col("feed_seq").cast("int").alias("feed_seq"),
            state.cast("int").alias("is_current"),
            until.alias("until"),
        )

    none, always, current = F.lit(""), F.lit(1), F.col("is_current")
    call = F.concat(trip_key(), F.lit(":"), F.col("tariff_number").cast("string"))
    return reduce(
        DataFrame.unionByName,
        [
            rows("carriers", F.col("carrier_key"), none, always, none),
            rows("stops", F.col("stop_key"), none, always, none),
            rows("lines", F.col("line_key"), F.col("carrier_key"), current, iso("valid_to")),
            rows("trips", F.col("trip_key"), F.col("line_key"), current, iso("loaded_to")),
            rows("calls", call, F.col("stop_key"), always, none),
        ],
    )


@query
def routes(t: SalesTimetable) -> DataFrame:
    return gtfs.routes(_lines(t))


@query
def trips(t: SalesTimetable) -> DataFrame:
    return _attached(t).select(
        F.col("trip_key").alias("trip_id"),
        F.col("line_key").alias("route_id"),
        _text("loaded_from"),
        _text("loaded_to"),
        _int("is_current"),
    )


@query
def trip_carrier(t: SalesTimetable) -> DataFrame:
    lines = _lines(t, keep_history=False)
    with_carrier = resolve.trip_carriers(t.trips, lines, t.alternative_carriers, t.carriers)
    return with_carrier.select(
        trip_key().alias("trip_id"), F.col("carrier_key").alias("carrier_id")
    )


@query
def gtfs_trips(t: SalesTimetable) -> DataFrame:
    trips = _signed(t)
    return gtfs.trips(
        calendars.with_service_id(trips, calendars.services_of_signatures(trips))
    )


# --- calendars


@query
def holidays(t: SalesTimetable) -> DataFrame:
    years = t.orders.select(F.col("feed_id").alias("year"))
    return hol.holiday_table(years).select(_text("day"))


@query
def holidays_with_freedom_day(t: SalesTimetable) -> DataFrame:
    years = t.orders.select(F.col("feed_id").alias("year"))
    return hol.holiday_table(years, (hol.FREEDOM_DAY,)).select(_text("day"))


@query
def holidays_class(t: SalesTimetable) -> DataFrame:
    start, end = F.col("valid_from"), F.col("valid_to")
    periods = (
        t.lines.groupBy("valid_from", "valid_to")
        .agg(F.count("*").alias("n_lines"))
        .withColumn("days", hol.holidays_between(start, end))
    )
    days = F.col("days")

    def listed(days: Column) -> Column:
        return joined_days(F.sort_array(F.array_distinct(days)))

    return periods.select(
        _text("valid_from"),
        _text("valid_to"),
        "n_lines",
        listed(hol.except_sunday(days, start, end)).alias("except_sunday"),
        listed(hol.except_sunday(days, start, end, 1)).alias("odd_weeks"),
        listed(hol.except_sunday(days, start, end, 0)).alias("even_weeks"),
        listed(hol.monday_to_friday(days, start, end)).alias("monday_to_friday"),
        listed(hol.on_saturday(days, start, end)).alias("on_saturday"),
    )


@query
def fixed_code_mask(t: SalesTimetable) -> DataFrame:
    mask = calendars.weekly_mask(
        F.col("weekday_mask"), F.col("on_working_days"), F.col("on_holidays")
    )
    return (
        _flagged_trips(t)
        .withColumn("mask", mask)
        .select(
            "trip_number",
            *[c.alias(day) for day, c in calendars.weekday_flags().items()],
            _int("on_working_days"),
            _int("on_holidays"),
        )
    )


@query
def time_codes(t: SalesTimetable) -> DataFrame:
    one = lambda c: F.concat(
        c["code_type"],
        F.lit(":"),
        compact(c["code_from"]),
        F.lit(":"),
        F.coalesce(compact(c["code_to"]), F.lit("")),
    )
    return calendars.codes_by_trip(t.time_codes).select(
        "trip_number",
        "n_codes",
        F.array_join(F.sort_array(F.transform("codes", one)), ",").alias("codes"),
    )


def _coded(t: SalesTimetable) -> DataFrame:
    return calendars.service_period(
        calendars.with_codes(_trips_of_all_lines(t), t.time_codes)
    )


def _periods(t: SalesTimetable) -> DataFrame:
    return calendars.with_national_holidays(_coded(t))


@query
def service_period(t: SalesTimetable) -> DataFrame:
    return _periods(t).select(
        "trip_number", _text("period_from"), _text("period_to"), _int("uses_calendar")
    )


def _day_sets(rows: DataFrame, numbers: str) -> DataFrame:
    """Sets of days, given as numbers, told by their size, ends and a digest of all their days.

    An unknown day is one more of the set. Without those, numbers are sorted as such.
    """
    known = rows.withColumn("known", F.array_compact(numbers))
    unknown = (F.size(numbers) > F.size("known")).cast("int")
    return known.withColumn("days", F.sort_array(F.array_distinct("known"))).select(
        "trip_number",
        (F.size("days") + unknown).cast("long").alias("n_days"),
        iso(F.date_from_unix_date(F.array_min("days"))).alias("first_day"),
        iso(F.date_from_unix_date(F.array_max("days"))).alias("last_day"),
        F.md5(joined_numbers("days")).alias("days_digest"),
    )


def _days_of_types(t: SalesTimetable, column: str, *types: str) -> DataFrame:
    """What the codes of the given types contribute to each trip."""
    codes = F.filter("codes", lambda c: c["code_type"].isin(*types))
    # Holidays of the years of these codes are all that they ask for, not those of the period.
    chosen = _coded(t).withColumns({"codes": codes, "uses_calendar": F.lit(False)})
    dated = calendars.days_of_codes(calendars.with_national_holidays(chosen))
    return _day_sets(dated, column)


@query
def calendar_ranges(t: SalesTimetable) -> DataFrame:
    return _days_of_types(t, "added", calendars.RUNS_IN)


@query
def calendar_also(t: SalesTimetable) -> DataFrame:
    return _days_of_types(t, "added", calendars.ALSO_RUNS, calendars.RUNS_ONLY)


@query
def calendar_not(t: SalesTimetable) -> DataFrame:
    return _days_of_types(t, "excluded", calendars.DOES_NOT_RUN)


@query
def calendar_parity(t: SalesTimetable) -> DataFrame:
    return _days_of_types(
        t,
        "added",
        calendars.ODD_WEEKS,
        calendars.EVEN_WEEKS,
        calendars.ODD_WEEKS_IN,
        calendars.EVEN_WEEKS_IN,
    )


@query
def calendar_holidays(t: SalesTimetable) -> DataFrame:
    """Days that the holidays move, per trip with a weekly calendar."""
    named = calendars.days_of_codes(_periods(t)).filter("uses_calendar")
    before = named.withColumns({"named": F.col("added"), "left_out": F.col("excluded")})
    after = calendars.with_holidays(before)

    def listed(numbers: Column) -> Column:
        return joined_days(days_of(F.sort_array(numbers)))

    return after.select(
        "trip_number",
        listed(F.array_except("excluded", "left_out")).alias("skipped"),
        listed(F.array_except("added", "named")).alias("gained"),
    )


@query
def calendar_services(t: SalesTimetable) -> DataFrame:
    return _services(t).select(
        "service_id",
        _int("uses_calendar"),
        "mask",
        _text("period_from"),
        _text("period_to"),
        _int("on_working_days"),
        _int("on_holidays"),
        F.md5(day_numbers("runs")).alias("runs_digest"),
        F.md5(day_numbers("runs_not")).alias("runs_not_digest"),
    )


@query
def findings(t: SalesTimetable) -> DataFrame:
    """Keys that GTFS tables lack or repeat, where only some carriers and stops are given."""
    trips = written(_signed(t), "signed")
    services = written(calendars.services_of_signatures(trips), "services")
    given = calendars.services(services)
    stops = t.stops.filter("stop_number % 4 <> 0")
    tables = {
        "agency": gtfs.agency(identity.carriers(t.carriers.filter("www <> ''"))),
        "routes": gtfs.routes(_lines(t)),
        "stops": gtfs.stops(identity.stops(stops)),
        "trips": gtfs.trips(calendars.with_service_id(trips, services)),
        "stop_times": gtfs.stop_times(_calls(t), _attached(t), counted=t.items_per_trip),
        "calendar": gtfs.calendar(given),
        "calendar_dates": gtfs.calendar_dates(given),
    }
    return integrity.findings(tables)


@query
def calendar(t: SalesTimetable) -> DataFrame:
    return gtfs.calendar(_services(t))


@query
def calendar_dates(t: SalesTimetable) -> DataFrame:
    return gtfs.calendar_dates(_services(t))


@query
def service_days(t: SalesTimetable) -> DataFrame:
    return (
        calendars.service_days(_services(t))
        .groupBy("service_id")
        .agg(
            F.count("*").alias("n_days"),
            iso(F.min("day")).alias("first_day"),
            iso(F.max("day")).alias("last_day"),
        )
    )


# --- the wide timetable


@query
def terminus_flags(t: SalesTimetable) -> DataFrame:
    starts = _versions(t).filter("is_accepted").select(*resolve.LINE, "valid_from")
    calls = _calls(t).filter("stop_key is not null").join(starts, resolve.LINE)
    return wide.terminus_flags(calls, counted=t.items_per_trip).select("trip_number", "tariff_number", "terminus")


@query
def timetable_wide(t: SalesTimetable) -> DataFrame:
    # The history reads its lines three times; its rows are needed by trips, calls and the table.
    kept = [*resolve.LINE, "feed_seq", "valid_from", "valid_to", "line_name", "carrier_key"]
    lines = written(resolve.lines(t.lines, t.carriers).select(*kept), "lines")
    versions = history.line_history(lines).withColumn("line_key", line_key())
    all_lines = written(versions.filter("is_accepted"), "accepted-lines")
    given_stops = written(t.stops, "stops")
    given_trips = written(t.trips_of(all_lines), "trips")
    flagged = resolve.fixed_code_flags(given_trips, t.fixed_codes)
    trips = calendars.signed(
        resolve.attached_trips(flagged, all_lines), t.time_codes_of(given_trips)
    )
    # The signature serves as key of the service: no table of services is made.
    services = calendars.services_of_signatures(trips).drop("service_id")
    shown_stops = wide.stop_columns(identity.stops(given_stops))
    calls = t.calls_of(given_trips)
    table = wide.timetable(
        resolve.stop_calls(calls, given_stops, more=shown_stops),
        all_lines,
        trips.withColumnRenamed("signature", "service_id"),
        services.withColumnRenamed("signature", "service_id"),
        None,
        identity.carriers(t.carriers),
        counted=t.items_per_trip,
    )
    days = ("valid_from", "valid_to", "period_from", "period_to")
    return table.withColumns({d: iso(d) for d in days})

