"""From feeds to GTFS: read, resolve, work out services, write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busgrid import sinks
from busgrid.functions.holidays import Extra
from busgrid.operators import calendars, history, identity, resolve
from busgrid.plans import gtfs, wide
from busgrid.session import work_folder
from busgrid.sources import feeds
from busgrid.sources.locations import read_locations
from busgrid.sources.staging import Staged


@dataclass(frozen=True)
class Options:
    """What a conversion may be told.

    keep_history: feeds are versions of each other and only current lines are exported.
    by_number: stops are the same when their number is, not when their names are.
    locations: path of a coordinates file, by stop number or by composed stop name.
    code_slots: how many of the ten fixed-code fields of a trip count.
    extra_holidays: (month, day) pairs added to the holidays.
    """

    keep_history: bool = False
    by_number: bool = False
    locations: str | None = None
    code_slots: int = resolve.CODE_SLOTS
    extra_holidays: Extra = ()


# The tables that are kept between loads.
TABLES = (
    "feeds",
    "carriers",
    "stops",
    "stop_posts",
    "lines",
    "trips",
    "services",
    "calls",
    "rejects",
)


@dataclass(frozen=True)
class Timetable:
    """Resolved tables of all feeds, and what could not be resolved."""

    feeds: DataFrame
    carriers: DataFrame
    stops: DataFrame
    stop_posts: DataFrame
    lines: DataFrame
    trips: DataFrame
    services: DataFrame
    located_calls: DataFrame
    #: Calls with a known stop and an attached trip.
    calls: DataFrame
    rejects: DataFrame
    staged_calls: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def gtfs(self, locations: DataFrame | None = None, by_number: bool = False) -> dict:
        return {
            "agency": gtfs.agency(self.carriers),
            "calendar": gtfs.calendar(self.services),
            "calendar_dates": gtfs.calendar_dates(self.services),
            "routes": gtfs.routes(self.lines),
            "stop_times": gtfs.stop_times(
                self.located_calls, self.trips, counted=self.staged_calls
            ),
            "stops": gtfs.stops(self.stops, locations, by_number),
            "trips": gtfs.trips(self.trips),
        }

    def wide(self, ordered: bool = True) -> DataFrame:
        return wide.timetable(
            self.located_calls,
            self.lines,
            self.trips,
            self.services,
            self.stops,
            self.carriers,
            ordered=ordered,
            counted=self.staged_calls,
        )


def _kept(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def timetable(
    staged: Staged,
    layout_rejects: DataFrame,
    feed_order: DataFrame,
    work: str,
    options: Options = Options(),
    kept_lines: DataFrame | None = None,
) -> Timetable:
    """Resolves the staged tables. Trips and their services are written to ``work`` once.

    ``kept_lines`` are the lines of earlier loads, which the lines of this one follow.
    """
    line_rows = _kept(
        resolve.lines(identity.last_rows(staged.lines, resolve.LINE), staged.carriers),
        f"{work}/line-rows",
    )
    no_carrier = F.col("carrier_key").isNull()
    with_versions = history.line_history if options.keep_history else history.without_history
    arriving = line_rows.filter(~no_carrier)
    if kept_lines is None:
        lines = with_versions(arriving)
    elif options.keep_history:
        lines = history.extend_history(kept_lines, arriving)
    else:
        lines = kept_lines.unionByName(with_versions(arriving))
    if options.keep_history:
        lines = _kept(lines, f"{work}/lines")

    trip_rows = identity.last_rows(staged.trips, resolve.TRIP)
    flagged = _kept(
        resolve.fixed_code_flags(trip_rows, staged.fixed_codes, options.code_slots),
        f"{work}/flagged",
    )
    trip_columns = trip_rows.columns
    unknown = F.size("unknown_codes") > 0
    with_carrier = resolve.trip_carriers(
        flagged.filter(~unknown).drop("unknown_codes", "code_ids"),
        lines,
        staged.trip_carriers,
        staged.carriers,
    )
    attached = resolve.attached_trips(with_carrier, lines)
    kept_codes = staged.time_codes
    signed = _kept(calendars.signed(attached, kept_codes), f"{work}/signed")
    by_signature = _kept(
        calendars.services_of_signatures(signed, options.extra_holidays), f"{work}/services"
    )
    trips = _kept(calendars.with_service_id(signed, by_signature), f"{work}/trips")

    states = resolve.trip_states(flagged, lines, unknown)
    located = resolve.stop_calls(staged.calls, staged.stops, options.by_number)
    # Calls meet their trips once; each kind of them is then a filter.
    told = _kept(resolve.with_trip_state(located, states), f"{work}/calls")
    calls = told.select(*located.columns)
    no_stop = F.col("stop_key").isNull()
    no_line = flagged.join(lines.select(*resolve.LINE), resolve.LINE, "left_anti").select(
        *resolve.LINE, *[c for c in trip_columns if c not in resolve.LINE]
    )
    no_alternative = resolve.with_company(staged.trip_carriers).join(
        identity.carriers_of_feed(staged.carriers), resolve.CARRIER_OF_FEED, "left_anti"
    )
    # Calls and codes of trips that were rejected are told apart from those of unknown ones.
    of_call = [*resolve.TRIP, *[c for c in staged.calls.columns if c not in resolve.TRIP]]
    no_trip = told.filter("trip_state is null").select(*of_call)
    of_lost = told.filter(F.col("trip_state") == resolve.LOST).select(*of_call)
    trip_of_feed = calendars.TRIP_OF_FEED
    # Keys first: most codes have a trip, and there are fewer keys than codes.
    keys_of_none = (
        kept_codes.select(*trip_of_feed)
        .distinct()
        .join(flagged.select(*trip_of_feed), trip_of_feed, "left_anti")
    )
    codes_of_none = resolve.of_keys(kept_codes, keys_of_none, trip_of_feed)
    everything = F.lit(True)
    rejects = [
        layout_rejects,
        *staged.rejects(),
        resolve.rejected(line_rows, "lines", "unknown carrier", no_carrier),
        resolve.rejected(flagged, "trips", "unknown fixed code", unknown),
        resolve.rejected(no_line, "trips", "unknown line", everything),
        resolve.rejected(no_alternative, "trip_carriers", "unknown carrier", everything),
        resolve.rejected(calls, "calls", "unknown stop", no_stop),
        resolve.rejected(no_trip, "calls", "unknown trip", everything),
        resolve.rejected(of_lost, "calls", "rejected trip", everything),
        resolve.rejected(codes_of_none, "time_codes", "unknown trip", everything),
        resolve.rejected(
            identity.earlier_rows(staged.lines, resolve.LINE), "lines", "repeated key", everything
        ),
        resolve.rejected(
            identity.earlier_rows(staged.trips, resolve.TRIP), "trips", "repeated key", everything
        ),
    ]
    return Timetable(
        feeds=feed_order,
        carriers=identity.carriers(staged.carriers),
        stops=identity.stops(staged.stops, options.by_number),
        stop_posts=staged.stop_posts,
        lines=lines,
        trips=trips,
        services=calendars.services(by_signature),
        located_calls=calls,
        calls=told.filter(~no_stop & (F.col("trip_state") == resolve.ATTACHED)).select(
            *resolve.TRIP, *[c for c in located.columns if c not in resolve.TRIP]
        ),
        rejects=reduce(DataFrame.unionByName, rejects),
        staged_calls=staged.calls,
    )


def resolve_feeds(
    spark: SparkSession,
    rows: DataFrame,
    options: Options = Options(),
    feed_order: DataFrame | None = None,
    work: str | None = None,
) -> Timetable:
    """Resolved tables from landed raw rows."""
    work = work or work_folder(spark, "convert")
    if feed_order is None:
        feed_order = feeds.path_order(rows, f"{work}/feeds")
    accepted, rejects = feeds.with_layout(rows, feed_order)
    return timetable(Staged(accepted), rejects, feed_order, work, options)


def append_feeds(
    spark: SparkSession,
    kept: Mapping[str, DataFrame],
    rows: DataFrame,
    options: Options = Options(),
    work: str | None = None,
) -> dict[str, DataFrame]:
    """The tables after more feeds were landed, equal to a load of all feeds in this order.

    ``kept`` are the tables of earlier loads as ``sinks.keep_tables`` wrote them. New feeds
    are numbered after those; feeds that are known already are left out. Kept carriers and
    stops stay the first ones; lines that the new feeds touch are worked out again, and
    only the currency of their trips changes.
    """
    work = work or work_folder(spark, "append")
    new_rows = rows.join(kept["feeds"].select("feed_id"), "feed_id", "left_anti")
    order = feeds.path_order(new_rows, f"{work}/feeds", kept["feeds"])
    accepted, rejects = feeds.with_layout(new_rows, order)
    new = timetable(Staged(accepted), rejects, order, work, options, kept["lines"]).tables()

    def first(name: str, key: str) -> DataFrame:
        unseen = new[name].join(kept[name].select(key), key, "left_anti")
        return kept[name].unionByName(unseen)

    state = new["lines"].select("line_key", "is_current")
    trips = kept["trips"].drop("is_current").join(state, "line_key")
    return {
        "feeds": new["feeds"],
        "carriers": first("carriers", "carrier_key"),
        "stops": first("stops", "stop_key"),
        "lines": new["lines"],
        "trips": trips.unionByName(new["trips"]),
        "services": first("services", "service_id"),
        **{
            name: kept[name].unionByName(new[name])
            for name in ("stop_posts", "calls", "rejects")
        },
    }


def convert(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    options: Options = Options(),
    feed_order: DataFrame | None = None,
    tables_dir: str | None = None,
) -> Timetable:
    """Reads all feeds below ``in_dir`` and writes the seven GTFS tables below ``out_dir``.

    With ``tables_dir`` the resolved tables are kept as well.
    """
    work = work_folder(spark, "convert")
    rows = feeds.land(feeds.read_rows(spark, in_dir), f"{work}/rows")
    result = resolve_feeds(spark, rows, options, feed_order, work)
    locations = options.locations and read_locations(
        spark, options.locations, options.by_number
    )
    sinks.write_gtfs(result.gtfs(locations or None, options.by_number), out_dir)
    if tables_dir is not None:
        sinks.keep_tables(result.tables(), tables_dir)
    return result
