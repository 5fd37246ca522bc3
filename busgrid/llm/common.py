"""Helpers shared by the operators: tables, shared folder, samples, texts in Arrow batches."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that several steps need are written once below the shared folder.
from busgrid.session import work_folder, written  # noqa: F401

BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of at most BATCH_BYTES, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lean(run):
    """Lets a worker that is done with a task hold little memory while it waits for the next."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name that means that column, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def packed(documents: DataFrame) -> Column:
    """All columns of a row as one, so that no name can clash with those of an operator."""
    return F.struct(*[F.col(quoted(name)) for name in documents.columns])


def unpacked(documents: DataFrame, row: str, **changed: Column) -> list[Column]:
    """The columns of ``documents`` from the packed row, with some of them replaced."""
    return [
        changed.get(name, F.col(row).getField(name)).alias(name) for name in documents.columns
    ]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def hash_sample(rows: DataFrame, key: str, most: int, by: str | None = None) -> DataFrame:
    """About ``most`` rows (of each value of ``by``), chosen by the hash of ``key``.

    All rows come if there are no more. The same rows come in every run, without a sort.
    """
    share = F.abs(F.xxhash64(F.lit("sample"), key).cast("double")) / F.lit(2.0**63)
    if by is None:
        n = rows.count()
        return rows if n <= most else rows.where(share < most / n)
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    return (
        rows.join(F.broadcast(counts), by)
        .where(share < F.lit(float(most)) / F.col("_n"))
        .drop("_n")
    )


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(
    data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts whole texts into runs of about ``limit`` bytes: first and last row, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        at = offsets[first : last + 1]
        yield first, last, data[at[0] : at[-1]], at - at[0]
        first = last
