"""Identity of carriers and stops over all feeds: the first row read wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.functions.keys import carrier_key, company_number, stop_key

READING_ORDER = ("feed_seq", "line_no")


def first_rows(rows: DataFrame, key: str) -> DataFrame:
    """The first row per key in reading order.

    An aggregate and not a window: every task keeps one row per key before the
    shuffle, so a key that appears in a third of all rows costs one row per task.
    """
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*READING_ORDER))
    return rows.groupBy(key).agg(first.alias("first")).select(key, "first.*")


def last_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last row per key of a feed, for keys that start with the feed."""
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), "line_no")
    return rows.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.*")


def earlier_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that ``last_rows`` leaves out."""
    last = rows.groupBy(*keys).agg(F.max("line_no").alias("last_no"))
    return rows.join(last, keys).filter("line_no < last_no").drop("last_no")


def carriers(staged: DataFrame) -> DataFrame:
    """Carriers are the same when company number, name and seat are."""
    return first_rows(staged.withColumn("carrier_key", carrier_key()), "carrier_key")


def stops(staged: DataFrame, by_number: bool = False) -> DataFrame:
    return first_rows(staged.withColumn("stop_key", stop_key(by_number)), "stop_key")


def carriers_of_feed(staged: DataFrame) -> DataFrame:
    """(feed, company number, discriminator) to carrier; the last row of a feed wins."""
    return (
        staged.select(
            "feed_id",
            company_number("ico").alias("company"),
            F.col("discriminator").alias("carrier_discriminator"),
            carrier_key().alias("carrier_key"),
            "line_no",
        )
        .groupBy("feed_id", "company", "carrier_discriminator")
        .agg(F.max_by("carrier_key", "line_no").alias("carrier_key"))
    )


def stops_of_feed(
    staged: DataFrame, by_number: bool = False, more: DataFrame | None = None
) -> DataFrame:
    """(feed, stop number) to stop; the last row of a feed wins.

    ``more`` has one row per stop key, whose columns come along.
    """
    keyed = staged.select(
        "feed_id", "stop_number", stop_key(by_number).alias("stop_key"), "line_no"
    )
    if more is None:
        return keyed.groupBy("feed_id", "stop_number").agg(
            F.max_by("stop_key", "line_no").alias("stop_key")
        )
    # One exchange serves the last rows and the join with what is by feed and number.
    last = F.max_by(F.struct(*more.columns), "line_no").alias("last")
    with_more = keyed.join(more, "stop_key", "left")
    return with_more.groupBy("feed_id", "stop_number").agg(last).select(
        "feed_id", "stop_number", "last.*"
    )
