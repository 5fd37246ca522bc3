"""Row numbers inside a key, also where one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busgrid.session import written

# A key with more rows than this is not numbered by one window in one task.
HOT_ROWS = 1_000_000
# No key has more rows than its bucket.
COUNT_BUCKETS = 16_384


def hot_keys(
    rows: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None if there are none or no bound is given."""
    return counted_keys(rows, keys, hot_rows)[0]


def counted_keys(
    rows: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> tuple[DataFrame | None, int]:
    """Keys with more than ``hot_rows`` rows, or None as in ``hot_keys``, and the number of all rows.

    Runs one job that reads the key columns, counts per bucket of keys (with partial counts
    before the shuffle, so a task sends a row per bucket at most) and brings two numbers to
    the driver. Only where a bucket has more rows, a second job counts per key, so that plans
    for hot keys are only made where such keys exist. There is at most one hot key
    per ``hot_rows`` rows of input; joins with them are left to adaptive execution, which
    measures.

    Rows may lack some of the key columns; the keys are then wider, which only finds more.
    """
    if hot_rows is None:
        return None, 0
    keys = [k for k in keys if k in rows.columns]
    buckets = rows.groupBy(F.pmod(F.xxhash64(*keys), F.lit(COUNT_BUCKETS)).alias("bucket"))
    largest, total = buckets.agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    if largest is None or largest <= hot_rows:
        return None, total or 0
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    if sizes.agg(F.max("n")).first()[0] <= hot_rows:
        return None, total
    return sizes.filter(F.col("n") > hot_rows).select(*keys), total


def split(rows: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the usual keys and rows of the hot ones."""
    keys = hot.columns
    return (
        rows.join(hot, keys, "left_anti"),
        rows.join(hot, keys, "left_semi"),
    )


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` by one window."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered_by_levels(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: str, name: str
) -> DataFrame:
    """The same numbers for hot keys, with no task that sees a whole key.

    The order columns are taken one after the other. Rows are counted per distinct
    value (with partial sums before the shuffle), a running sum over these counts
    says how many rows lie before a value, and the sums of all levels add up to the
    rows before a group. ``last`` is a row position that makes the order total; it
    is cut into ranges of ``HOT_ROWS``, so the window that numbers the rows inside a
    group stays small even if all other columns are equal. Order columns must not
    be NULL. The rows and the counts are written once, as each level needs them.
    """
    block = f"{name}_block"
    levels = [*order, block]
    rows = written(rows.withColumn(block, F.floor(F.col(last) / HOT_ROWS)), "hot-rows")
    groups = written(rows.groupBy(*keys, *levels).agg(F.count("*").alias("n")), "hot-groups")

    before, prefix = groups.drop("n"), list(keys)
    for i, level in enumerate(levels):
        counts = groups.groupBy(*prefix, level).agg(F.sum("n").alias("n"))
        sums = _running_sums(counts, prefix, level, f"before_{i}")
        prefix = [*prefix, level]
        before = before.join(sums.select(*prefix, f"before_{i}"), prefix)
    parts = [f"before_{i}" for i in range(len(levels))]
    offset = sum((F.col(p) for p in parts), F.lit(0))
    within = F.row_number().over(Window.partitionBy(*prefix).orderBy(last))
    return (
        rows.join(before, prefix)
        .withColumn(name, (offset + within).cast("int"))
        .drop(block, *parts)
    )


def _running_sums(counts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The sum of ``n`` before each value of a key, in two steps.

    Values are cut into stretches of their order: numbers of 2^16, texts by their first
    four characters. Sums run inside a stretch and over stretches, so no task gets a row
    for each value of a key.
    """
    kind = dict(counts.dtypes)[value]
    stretch = F.substring(value, 1, 4) if kind == "string" else F.shiftright(F.col(value), 16)
    cut = counts.withColumn("stretch", stretch)

    def earlier(columns: list[str], by: str) -> Column:
        window = Window.partitionBy(*columns).orderBy(by)
        return F.coalesce(
            F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    whole = cut.groupBy(*keys, "stretch").agg(F.sum("n").alias("n"))
    whole = whole.select(*keys, "stretch", earlier(keys, "stretch").alias("of_stretches"))
    inside = cut.withColumn("inside", earlier([*keys, "stretch"], value))
    return inside.join(whole, [*keys, "stretch"]).withColumn(
        name, F.col("inside") + F.col("of_stretches")
    )
