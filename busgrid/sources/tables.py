"""Staged tables in timetable shape, derived from the generic sales tables.

Orders play trips, their items the calls, customers the lines, suppliers the
carriers and parts the stops; the year of an order is the feed it comes from.
The arrival order of feeds is not the order of years.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from busgrid.operators.resolve import LINE
from busgrid.session import work_folder

#: What rows of a trip have of it besides its number.
OF_TRIP = ["feed_id", "feed_seq", "line_number", "line_discriminator"]


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _code_ids() -> Column:
    """The numbers of the fixed codes of a comma list."""
    return F.transform(
        F.filter(F.split("codes", ","), lambda c: c != ""), lambda c: F.concat(F.lit("k"), c)
    )


class SalesTimetable:
    """Lazily built staged tables over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def orders(self) -> DataFrame:
        """Feed, line, trip number and the fixed codes as comma list."""
        feed = F.year("o_orderdate")
        codes = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "X")
            .when(F.col("o_orderpriority") == "2-HIGH", "6,+")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "1,3,5")
            .otherwise("X,+")
        )
        return self.table("orders").select(
            feed.alias("feed_id"),
            (feed * 3 % 7).alias("feed_seq"),
            _padded(F.col("o_custkey"), 6).alias("line_number"),
            F.lit(1).alias("line_discriminator"),
            F.col("o_orderkey").alias("trip_number"),
            codes.alias("codes"),
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Trips with the numbers of their fixed codes, as the trip rows of a feed have them."""
        return self.orders.select(
            "feed_id",
            "feed_seq",
            "line_number",
            "line_discriminator",
            "trip_number",
            _code_ids().alias("code_ids"),
        )

    @cached_property
    def fixed_codes(self) -> DataFrame:
        """The dictionary of each feed: every code number its trips use.

        Each number is given twice, first with another meaning; the last row counts.
        """
        # Each list of codes is taken apart once a feed.
        lists = self.orders.select("feed_id", "codes").distinct()
        used = lists.select("feed_id", F.explode(_code_ids()).alias("code_id")).distinct()
        given = F.array(
            F.struct(F.lit("7").alias("meaning"), F.lit(0).alias("line_no")),
            F.struct(F.substring("code_id", 2, 1).alias("meaning"), F.lit(1).alias("line_no")),
        )
        return used.select("feed_id", "code_id", F.inline(given))

    @cached_property
    def feeds(self) -> DataFrame:
        return self.orders.select("feed_id", "feed_seq").distinct()

    @cached_property
    def suppliers(self) -> Column:
        return self.table("supplier").agg(F.count("*")).scalar()

    @cached_property
    def lines(self) -> DataFrame:
        number = F.col("line_number").cast("int")
        late = F.col("feed_id") == 1997
        first, second = late & (number % 10 == 0), late & (number % 10 == 1)
        year = F.when(first | second, 2001).otherwise(F.col("feed_id"))
        last_day = (
            F.when(first, F.lit("2001-12-31").cast("date"))
            .when(second, F.lit("2001-06-30").cast("date"))
            .otherwise(F.make_date("feed_id", F.lit(12), F.lit(31)))
        )
        seen = self.orders.select("feed_id", "feed_seq", "line_number").distinct()
        # By number: longer customer numbers are cut when padded, and many would be the same line.
        customer = self.table("customer").select(
            F.col("c_custkey").alias("number"), F.col("c_name").alias("line_name")
        )
        return seen.withColumn("number", number).join(customer, "number").select(
            "feed_id",
            "feed_seq",
            F.lit(1).alias("line_no"),
            "line_number",
            F.lit(1).alias("line_discriminator"),
            F.make_date(year, F.lit(1), F.lit(1)).alias("valid_from"),
            last_day.alias("valid_to"),
            _padded(number % self.suppliers, 8).alias("ico"),
            F.lit(1).alias("carrier_discriminator"),
            "line_name",
            F.substring(F.lit("AELMPT"), number % 6 + 1, F.lit(1)).alias("vehicle"),
        )

    @cached_property
    def carriers(self) -> DataFrame:
        number = F.col("s_suppkey")
        seats = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seat")
        )
        renamed = (number % 10 == 0) & (F.col("feed_id") >= 1999)
        web = F.concat(F.lit("www.c"), number.cast("string"), F.lit(".example"))
        own = (F.col("line_number").cast("int") % self.suppliers).alias("s_suppkey")
        alternative = (F.col("trip_number") % self.suppliers).alias("s_suppkey")
        feed = ["feed_id", "feed_seq"]
        # Each feed lists the carriers that its lines and trips name.
        used = (
            self.orders.select(*feed, own)
            .unionByName(self.orders.filter("trip_number % 9 = 0").select(*feed, alternative))
            .distinct()
        )
        known = self.table("supplier").join(seats, "s_nationkey")
        return used.join(known, "s_suppkey").select(
            "feed_id",
            "feed_seq",
            number.alias("line_no"),
            _padded(number, 8).alias("ico"),
            F.when(renamed, F.concat("s_name", F.lit(" a.s.")))
            .otherwise(F.col("s_name"))
            .alias("carrier_name"),
            "seat",
            F.lit(1).alias("discriminator"),
            F.when(number % 3 == 0, "").otherwise(web).alias("www"),
            F.lit("").alias("phone_seat"),
            F.lit("").alias("email"),
        )

    @cached_property
    def stops(self) -> DataFrame:
        # Each feed lists the stops that its trips call at.
        items = self.table("lineitem").select(
            F.col("l_orderkey").alias("trip_number"), F.col("l_partkey").alias("p_partkey")
        )
        trips = self.orders.select("trip_number", "feed_id", "feed_seq")
        return self._stops_from(items.join(trips, "trip_number").drop("trip_number"))

    def _stops_from(self, used: DataFrame) -> DataFrame:
        return used.distinct().join(self.table("part"), "p_partkey").select(
            "feed_id",
            "feed_seq",
            F.col("p_partkey").alias("line_no"),
            F.col("p_partkey").alias("stop_number"),
            F.col("p_brand").alias("municipality"),
            F.col("p_type").alias("district"),
            F.col("p_name").alias("place"),
        )

    @cached_property
    def alternative_carriers(self) -> DataFrame:
        """Every ninth trip names a carrier of its own."""
        return self.orders.filter("trip_number % 9 = 0").select(
            "feed_id",
            "line_number",
            "trip_number",
            _padded(F.col("trip_number") % self.suppliers, 8).alias("ico"),
            F.lit(1).alias("carrier_discriminator"),
            F.lit(1).alias("line_no"),
        )

    def _of_trips(self, rows: DataFrame, trips: DataFrame | None = None) -> DataFrame:
        trip = (trips or self.orders).select(
            "feed_id", "feed_seq", "line_number", "line_discriminator", "trip_number"
        )
        return rows.join(trip, "trip_number")

    def trips_of(self, lines: DataFrame) -> DataFrame:
        """The trips of some lines."""
        return self.trips.join(lines.select(*LINE), LINE, "left_semi")

    @cached_property
    def time_codes(self) -> DataFrame:
        return self._of_trips(self._code_rows)

    def time_codes_of(self, trips: DataFrame) -> DataFrame:
        return self._of_trips(self._code_rows, trips)

    @cached_property
    def _code_rows(self) -> DataFrame:
        return self._codes_from(self.table("lineitem"))

    def _codes_from(self, items: DataFrame, *more: str) -> DataFrame:
        """Dated codes of all eight types: every item of a trip that has codes."""
        kind = F.col("l_partkey") % 8
        start = F.col("l_shipdate").cast("date")
        ranged = kind.isin(6, 7) | (kind.isin(0, 3) & (F.col("l_suppkey") % 5 != 0))
        # Every fourth trip has no dated code.
        return items.filter("l_orderkey % 4 <> 0").select(
            F.col("l_orderkey").alias("trip_number"),
            (kind + 1).cast("string").alias("code_type"),
            start.alias("code_from"),
            F.when(ranged, F.date_add(start, F.col("l_quantity").cast("int"))).alias("code_to"),
            *more,
        )

    @cached_property
    def calls(self) -> DataFrame:
        return self._of_trips(self._call_rows)

    def calls_of(self, trips: DataFrame) -> DataFrame:
        """The calls of some trips: those of others go no farther than the join with them."""
        return self._of_trips(self._call_rows, trips)

    @cached_property
    def _call_rows(self) -> DataFrame:
        return self._calls_from(self._placed_items)

    @cached_property
    def _placed_items(self) -> DataFrame:
        """Items with their place in their order and the number of its items."""
        items = Window.partitionBy("l_orderkey")
        place = items.orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"
        )
        return self.table("lineitem").withColumns(
            {
                "tariff_number": F.row_number().over(place),
                "n": F.count("*").over(items).cast("int"),
            }
        )

    def _calls_from(self, placed: DataFrame, *more: str) -> DataFrame:
        """Calls with markers, empty times, missing km and both directions of travel."""
        quantity, last = F.col("l_quantity"), F.col("ord") == F.col("n")
        trip = F.col("l_orderkey")
        hours = F.expr("cast(t div 60 as int)")
        clock = F.substring((10000 + hours * 100 + F.col("t") % 60).cast("string"), 2, 4)
        marker = F.when(quantity == 1, "<").when(quantity == 2, "|")
        no_arrival = (
            (quantity == 3) | ((F.col("l_linestatus") == "F") & ~last) | (F.col("ord") == 1)
        )
        return (
            placed.withColumn(
                "ord",
                F.when(trip % 2 == 1, F.col("tariff_number")).otherwise(
                    F.col("n") + 1 - F.col("tariff_number")
                ),
            )
            .withColumn("t", ((trip * 37 + 11 * F.col("ord")) % 1440).cast("int"))
            .select(
                trip.alias("trip_number"),
                "tariff_number",
                F.col("tariff_number").alias("line_no"),
                F.col("l_partkey").alias("stop_number"),
                F.when(trip % 13 != 0, 2 * F.col("ord")).alias("km"),
                marker.when(no_arrival, "").otherwise(clock).alias("arrival"),
                marker.when((quantity == 3) | last, "").otherwise(clock).alias("departure"),
                *more,
            )
        )

    @cached_property
    def raw_rows(self) -> DataFrame:
        """Line and trip records as text fields, with the record end, and version records.

        Feeds use the versions 1.8 to 1.12 in turn, the last of which is unknown; lines
        of every seventh customer lack a field.
        """
        version = F.concat(F.lit("1."), (8 + F.col("feed_id") % 5).cast("string"))
        newer, newest = version.isin("1.10", "1.11"), version == "1.11"
        day = lambda d: F.date_format(d, "ddMMyyyy")

        def blank(n: int) -> list[Column]:
            return [F.lit("")] * n

        name, ico, kind = F.col("line_name"), F.col("ico"), F.col("vehicle")
        head = [F.col("line_number"), name, ico, F.lit("B")]
        valid = [day("valid_from"), day("valid_to")]
        old_line = F.array(*head, *blank(4), *valid)
        new_line = F.array(*head, kind, *blank(7), *valid, F.lit("1"), F.lit("1"))
        newest_line = F.array(*head, kind, *blank(8), *valid, F.lit("1"), F.lit("1"))
        line = F.when(newest, newest_line).when(newer, new_line).otherwise(old_line)
        short = F.col("line_number").cast("int") % 7 == 0
        lines = self.lines.select(
            "feed_id",
            F.lit("lines").alias("table"),
            F.when(short, F.slice(line, F.lit(1), F.size(line) - 1)).otherwise(line).alias("f"),
        )
        codes = F.concat("code_ids", F.array_repeat(F.lit(""), 10 - F.size("code_ids")))
        key = F.array("line_number", F.col("trip_number").cast("string"))
        tail = F.when(newer, F.array(F.lit(""), F.lit("1"))).otherwise(
            F.array().cast("array<string>")
        )
        trips = self.trips.select(
            "feed_id", F.lit("trips").alias("table"), F.concat(key, codes, tail).alias("f")
        )
        versions = self.feeds.select(
            "feed_id", F.lit("version").alias("table"), F.array(version, F.lit("")).alias("f")
        )
        # The record end belongs to the last field.
        last = F.concat(F.element_at("f", -1), F.lit(";"))
        fields = F.concat(F.slice("f", F.lit(1), F.size("f") - 1), F.array(last))
        return (
            lines.unionByName(trips)
            .unionByName(versions)
            .select(
                F.col("feed_id").cast("string").alias("feed_id"),
                "table",
                F.lit(1).cast("long").alias("line_no"),
                fields.alias("fields"),
                F.lit(None).cast("string").alias("problem"),
            )
        )

    @cached_property
    def raw_calls(self) -> DataFrame:
        """Call records as text fields in the layouts of ``raw_rows``, with version records.

        The km of some calls and the arrival of others cannot be read.
        """
        version = F.concat(F.lit("1."), (8 + F.col("feed_id") % 5).cast("string"))
        trip, tariff = F.col("trip_number"), F.col("tariff_number")
        km = F.when((trip % 17 == 0) & (tariff == 1), "x").otherwise(
            F.coalesce(F.col("km").cast("string"), F.lit(""))
        )
        arrival = F.when((trip % 19 == 0) & (tariff == 2), "8:10").otherwise(F.col("arrival"))
        text = lambda name: F.col(name).cast("string")
        head = [F.col("line_number"), text("trip_number"), text("tariff_number"), text("stop_number")]
        blank = F.lit("")
        times = [km, arrival, F.col("departure")]
        old = F.array(*head, *[blank] * 3, *times)
        newer = F.array(*head, *[blank] * 4, *times, F.lit("1"))
        newest = F.array(*head, *[blank] * 5, *times, blank, blank, F.lit("1"))
        f = F.when(version == "1.11", newest).when(version == "1.10", newer).otherwise(old)
        last = F.concat(F.element_at("f", -1), F.lit(";"))
        calls = self.calls.withColumn("f", f).select(
            F.col("feed_id").cast("string").alias("feed_id"),
            F.lit("calls").alias("table"),
            F.col("line_no").cast("long").alias("line_no"),
            F.concat(F.slice("f", F.lit(1), F.size("f") - 1), F.array(last)).alias("fields"),
            F.lit(None).cast("string").alias("problem"),
        )
        return calls.unionByName(self.raw_rows.filter("table = 'version'"))

    @cached_property
    def stop_posts(self) -> DataFrame:
        """Posts of the stops with an even number, up to three each; some have no name of their own."""
        number = F.col("stop_number")
        posts = F.sequence(F.lit(1).cast("bigint"), number % 3 + 1)
        each = self.stops.filter(number % 2 == 0).withColumn("post", F.explode(posts))
        return each.select(
            "feed_id",
            "feed_seq",
            (4 * F.col("line_no") + F.col("post")).alias("line_no"),
            "stop_number",
            F.col("post").cast("int").alias("post_number"),
            F.when(F.col("post") < 3, F.concat(F.lit("post "), F.col("post").cast("string")))
            .otherwise("")
            .alias("post_name"),
            F.substring("place", 1, 12).alias("direction"),
        )

    @cached_property
    def raw_posts(self) -> DataFrame:
        """Post records as text fields in the layouts of ``raw_rows``, with version records.

        The number of some posts cannot be read.
        """
        unreadable = (F.col("stop_number") % 11 == 0) & (F.col("post_number") == 1)
        number = F.when(unreadable, "x").otherwise(F.col("post_number").cast("string"))
        blank = F.lit("")
        head = [F.col("stop_number").cast("string"), number, "post_name", "direction"]
        posts = self.stop_posts.select(
            F.col("feed_id").cast("string").alias("feed_id"),
            F.lit("stop_posts").alias("table"),
            F.col("line_no").cast("long").alias("line_no"),
            F.array(*head, blank, blank, F.lit(";")).alias("fields"),
            F.lit(None).cast("string").alias("problem"),
        )
        return posts.unionByName(self.raw_rows.filter("table = 'version'"))

    @cached_property
    def record_lines(self) -> DataFrame:
        """Lines of files of stops, with quotes, commas and line breaks in fields.

        A file holds the parts of one size; a hundred parts are a block of it. Records of odd
        parts end with LF alone, those of even ones with CR LF, as the format says.
        """
        quoted = lambda c: F.concat(
            F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')
        )
        name = F.concat(F.lit('"'), F.col("p_name"), F.lit('", '), F.col("p_brand"))
        place = F.concat(F.col("p_type"), F.lit("\r\n,"), F.col("p_name"))
        fields = [F.col("p_partkey").cast("string"), name, F.lit(""), place]
        number = F.col("p_partkey").cast("long")
        end = F.when(number % 2 == 0, ";\r").otherwise(";")
        record = F.concat(F.concat_ws(",", *map(quoted, fields)), end)
        lines = self.table("part").select(
            F.concat(F.lit("parts/"), F.col("p_size").cast("string")).alias("file"),
            F.floor(number / 100).alias("block"),
            number.alias("number"),
            F.posexplode(F.split(record, "\n")).alias("line", "text"),
        )
        return lines.select("file", "block", (2 * F.col("number") + F.col("line")).alias("pos"), "text")

    def loads(self, *until: int) -> list[FeedsOf]:
        """The staged tables in loads: feeds before the first number, before the second, and so on."""
        edges = [0, *until, 1 << 30]
        return [FeedsOf(self, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    @cached_property
    def items_by_feed(self) -> DataFrame:
        """Placed items with their trips, written by feed number: a load reads those of its feeds only."""
        used = ["l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_shipdate"]
        items = self._placed_items.select(
            F.col("l_orderkey").alias("trip_number"), "l_orderkey", *used, "tariff_number", "n"
        )
        rows = self._of_trips(items).drop("trip_number")
        folder = work_folder(self.spark, "items")
        rows.write.partitionBy("feed_seq").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    @cached_property
    def no_rejects(self) -> DataFrame:
        columns = "feed_id string, table string, reason string, content string"
        return self.spark.createDataFrame([], columns)

    @cached_property
    def items_per_trip(self) -> DataFrame:
        """The rows that calls and dated codes are made of, by trip number only."""
        return self.table("lineitem").select(F.col("l_orderkey").alias("trip_number"))

    @cached_property
    def locations_by_number(self) -> DataFrame:
        number = F.col("p_partkey")
        # Every fourth stop has no location.
        return self.table("part").filter("p_partkey % 4 <> 0").select(
            number.alias("stop_number"),
            (F.lit(49.0) + (number % 1000).cast("double") / 1000).alias("x"),
            (F.lit(13.0) + (number % 700).cast("double") / 100).alias("y"),
        )

    @cached_property
    def locations_by_name(self) -> DataFrame:
        """One row per composed stop name."""
        name = F.concat("p_brand", F.lit(","), "p_type", F.lit(","), "p_name")
        named = self.table("part").select(F.col("p_partkey").alias("stop_number"), name.alias("n"))
        return (
            self.locations_by_number.join(named, "stop_number")
            .groupBy(F.col("n").alias("stop_name"))
            .agg(F.min("x").alias("x"), F.min("y").alias("y"))
        )


class FeedsOf:
    """The staged tables of some feeds, as ``sources.staging.Staged`` gives them."""

    #: Tables that are read from files without any work between rows.
    written = ("calls", "time_codes")

    def __init__(self, timetable: SalesTimetable, first: int, end: int):
        self.timetable, self.first, self.end = timetable, first, end
        self.feeds = timetable.feeds.filter(F.col("feed_seq").between(first, end - 1))

    def _of(self, rows: DataFrame) -> DataFrame:
        if "feed_seq" in rows.columns:  # settled before any join, where the rows are read
            return rows.filter(F.col("feed_seq").between(self.first, self.end - 1))
        return rows.join(self.feeds.select("feed_id"), "feed_id", "left_semi")

    @property
    def _items(self) -> DataFrame:
        return self._of(self.timetable.items_by_feed)

    @property
    def feed_order(self) -> DataFrame:
        return self.feeds.select(F.col("feed_id").cast("string").alias("feed_id"), "feed_seq")

    @property
    def lines(self) -> DataFrame:
        return self._of(self.timetable.lines)

    @property
    def carriers(self) -> DataFrame:
        return self._of(self.timetable.carriers)

    @property
    def stops(self) -> DataFrame:
        used = self._items.select("feed_id", "feed_seq", F.col("l_partkey").alias("p_partkey"))
        return self.timetable._stops_from(used)

    @property
    def stop_posts(self) -> DataFrame:
        return self._of(self.timetable.stop_posts)

    @property
    def trips(self) -> DataFrame:
        return self._of(self.timetable.trips).withColumn("line_no", F.lit(1))

    @property
    def fixed_codes(self) -> DataFrame:
        return self._of(self.timetable.fixed_codes)

    @property
    def trip_carriers(self) -> DataFrame:
        return self._of(self.timetable.alternative_carriers)

    @property
    def time_codes(self) -> DataFrame:
        return self.timetable._codes_from(self._items, *OF_TRIP)

    @property
    def calls(self) -> DataFrame:
        return self.timetable._calls_from(self._items, *OF_TRIP)

    def rejects(self):
        return iter(())
