"""Outputs: CSV folders in GTFS form, and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_csv(rows: DataFrame, folder: str) -> None:
    """UTF-8 with a header in each part, quotes only where needed, NULL as empty text."""
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("lineSep", "\n")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def write_gtfs(tables: Mapping[str, DataFrame], folder: str) -> None:
    """One folder ``<name>.txt`` of CSV parts per GTFS table."""
    for name, rows in tables.items():
        write_csv(rows, f"{folder.rstrip('/')}/{name}.txt")


def keep_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Resolved tables as parquet, for later loads and for analysis."""
    for name, rows in tables.items():
        columns = [c for c in partition_by if c in rows.columns]
        rows.write.mode(mode).partitionBy(*columns).parquet(f"{folder.rstrip('/')}/{name}")


def save_wide(rows: DataFrame, table: str, mode: str = "errorifexists") -> None:
    """The wide timetable as a named table."""
    rows.write.mode(mode).saveAsTable(table)
