"""Surrogate keys made from content, so that no sequence and no lookup is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u001f"


def content_key(*parts: str | Column) -> Column:
    """md5 over the parts as text; a missing part counts as empty text."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(
        F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    )


def carrier_key() -> Column:
    return content_key("ico", "carrier_name", "seat")


def stop_key(by_number: bool) -> Column:
    """Stops are the same when their number is (``by_number``) or when their three names are."""
    if by_number:
        return content_key("stop_number")
    return content_key("municipality", "district", "place")


def line_key() -> Column:
    return content_key("feed_id", "line_number", "line_discriminator")


def trip_key() -> Column:
    return content_key("feed_id", "line_number", "line_discriminator", "trip_number")


def company_number(column: str | Column) -> Column:
    """Company numbers are compared as numbers: leading zeros do not count."""
    c = F.col(column) if isinstance(column, str) else column
    return F.ltrim(c, F.lit("0"))
