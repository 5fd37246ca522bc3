"""Version history of lines as feeds arrive one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from busgrid.operators.sequences import HOT_ROWS, hot_keys

BEFORE = (Window.unboundedPreceding, -1)


def without_history(lines: DataFrame) -> DataFrame:
    """Every line row is accepted and current."""
    return lines.withColumns(
        {
            "loaded_from": F.col("valid_from"),
            "loaded_to": F.col("valid_to"),
            "is_accepted": F.lit(True),
            "is_current": F.lit(True),
        }
    )


def extend_history(kept: DataFrame, arriving: DataFrame) -> DataFrame:
    """The history after more feeds have arrived; equal to a history over all feeds at once.

    Only lines that occur in the arriving feeds are worked out again, from the
    validity they were loaded with. Feeds may arrive out of order; ``feed_seq`` must be
    numbered the same way in both.
    """
    touched = arriving.select("line_number").distinct()
    as_loaded = (
        kept.join(touched, "line_number", "left_semi")
        .withColumns({"valid_from": F.col("loaded_from"), "valid_to": F.col("loaded_to")})
        .drop("loaded_from", "loaded_to", "is_accepted", "is_current")
    )
    untouched = kept.join(touched, "line_number", "left_anti")
    return untouched.unionByName(line_history(as_loaded.unionByName(arriving)))


def _carried(rows: DataFrame, value: str, earlier: bool) -> DataFrame:
    """``value`` of the neighbour row of the same line in feed order, as column ``near``.

    Rows are ordered inside blocks of feeds only. What crosses a block comes from one
    row per line and block: its last value for the block after it, or its first one
    for the block before it.
    """
    inside = Window.partitionBy("line_number", "block").orderBy("feed_seq")
    blocks = Window.partitionBy("line_number").orderBy("block")
    step, edge = (F.lag, F.max_by) if earlier else (F.lead, F.min_by)
    edges = (
        rows.groupBy("line_number", "block")
        .agg(edge(value, "feed_seq").alias("edge"))
        .select("line_number", "block", step("edge").over(blocks).alias("across"))
    )
    return (
        rows.withColumn("near", step(value).over(inside))
        .join(edges, ["line_number", "block"])
        .withColumn("near", F.coalesce("near", "across"))
        .drop("across")
    )


def _accepted_in_blocks(per_feed: DataFrame, hot_feeds: int) -> DataFrame:
    """Accepted versions when a line comes in very many feeds: no task sees all of them."""
    rows = per_feed.withColumn("block", F.floor(F.col("feed_seq") / hot_feeds)).withColumn(
        "version", F.struct("valid_from", "valid_to")
    )
    inside = Window.partitionBy("line_number", "block").orderBy("feed_seq")
    blocks = Window.partitionBy("line_number").orderBy("block")
    starts = (
        rows.groupBy("line_number", "block")
        .agg(F.max("valid_from").alias("start"))
        .select(
            "line_number",
            "block",
            F.max("start").over(blocks.rowsBetween(*BEFORE)).alias("latest_before"),
        )
    )
    latest = F.greatest(F.max("valid_from").over(inside.rowsBetween(*BEFORE)), "latest_before")
    candidates = (
        rows.join(starts, ["line_number", "block"])
        .withColumn("latest", latest)
        .filter("latest is null or valid_from >= latest")
        .drop("latest", "latest_before")
    )
    accepted = (
        _carried(candidates, "version", earlier=True)
        .filter("near is null or near <> version")
        .drop("near")
    )
    return _carried(accepted, "valid_from", earlier=False).select(
        "line_number", "feed_seq", F.col("near").alias("next_from")
    )


def _accepted(per_feed: DataFrame) -> DataFrame:
    in_order = Window.partitionBy("line_number").orderBy("feed_seq")
    candidates = (
        per_feed.withColumn("latest", F.max("valid_from").over(in_order.rowsBetween(*BEFORE)))
        .filter("latest is null or valid_from >= latest")
        .withColumn("before_from", F.lag("valid_from").over(in_order))
        .withColumn("before_to", F.lag("valid_to").over(in_order))
    )
    return candidates.filter(
        "before_from is null or valid_from <> before_from or valid_to <> before_to"
    ).select("line_number", "feed_seq", F.lead("valid_from").over(in_order).alias("next_from"))


def line_history(lines: DataFrame, hot_feeds: int | None = HOT_ROWS) -> DataFrame:
    """Marks accepted and current versions and ends a version where its successor starts.

    A version is accepted when no earlier feed has one of the same line that starts
    later, and when it differs from the version it would follow. ``loaded_from`` and
    ``loaded_to`` keep the validity as read, which the calendars use.

    The windows run over one slim row per line and feed (four columns), not over
    the line rows themselves; variants of a line inside one feed share its verdict.
    A count per line is run first; if a line has more than ``hot_feeds`` rows, feeds are
    taken in blocks of that size, for which ``feed_seq`` must be a number. None leaves
    that check out.
    """
    per_feed = lines.groupBy("line_number", "feed_seq").agg(
        F.max(F.struct("valid_from", "valid_to")).alias("v")
    ).select("line_number", "feed_seq", "v.valid_from", "v.valid_to")
    if hot_keys(lines, ["line_number"], hot_feeds) is None:
        accepted = _accepted(per_feed)
    else:
        accepted = _accepted_in_blocks(per_feed, hot_feeds)

    accepted_flag = F.coalesce("was_accepted", F.lit(False))
    return (
        lines.join(accepted.withColumn("was_accepted", F.lit(True)), ["line_number", "feed_seq"], "left")
        .withColumns(
            {
                "loaded_from": F.col("valid_from"),
                "loaded_to": F.col("valid_to"),
                "valid_to": F.coalesce("next_from", "valid_to"),
                "is_accepted": accepted_flag,
                "is_current": accepted_flag & F.col("next_from").isNull(),
            }
        )
        .drop("next_from", "was_accepted")
    )
