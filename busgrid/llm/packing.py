"""Numbers as compressed bytes, and blocks of documents, for exchanges of packed rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from busgrid.llm.common import slabs, text_bytes

BLOCK_BYTES = 8 << 20
EXCHANGE = "kind int, bucket int, block long, keys binary, parts binary, docs binary"
LAST = np.iinfo(np.int64).max


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers below 2^32, byte bytes_ apart, which compress well."""
    bytes_ = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(bytes_.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    bytes_ = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(bytes_.T).view("<u4").reshape(-1).astype(np.int64)


def pack_sorted(values: np.ndarray, width: int) -> bytes:
    """Sorted unsigned numbers of ``width`` bytes as their differences."""
    gaps = np.diff(values, prepend=values.dtype.type(0)).astype("<u8")
    bytes_ = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.compress(bytes_.tobytes(), 1)


def unpack_sorted(data: bytes, width: int) -> np.ndarray:
    bytes_ = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    gaps = np.zeros((bytes_.shape[1], 8), np.uint8)
    gaps[:, :width] = bytes_.T
    return np.cumsum(gaps.view("<u8").reshape(-1), dtype=np.uint64)


def block_name(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> int:
    """The same number whenever these documents stand together in this order."""
    name = xxhash.xxh64(np.ascontiguousarray(data))
    name.update(np.ascontiguousarray(offsets))
    name.update(doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).tobytes())
    name.update(doc_ids.is_null().to_numpy(zero_copy_only=False).tobytes())
    return int(np.uint64(name.intdigest()).astype(np.int64))


def exchange_row(kind, bucket, block, keys=b"", parts=b"", docs=b""):
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind], pa.int32()),
            pa.array([bucket], pa.int32()),
            pa.array([block], pa.int64()),
            pa.array([keys], pa.binary()),
            pa.array([parts], pa.binary()),
            pa.array([docs], pa.binary()),
        ],
        ["kind", "bucket", "block", "keys", "parts", "docs"],
    )


def planes(values: np.ndarray, width: int) -> bytes:
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def from_planes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), np.uint8)
    raw[:, :width] = planes.T
    return raw.view("<u8").reshape(-1)


def row_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def ranges(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where the keys of each range start, for equal ranges of the order."""
    edges = [(b << bits) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys))


def text_rows(kind):
    def run(batches):
        for batch in batches:
            every = row_ids(batch)
            for first, last, data, offsets in slabs(*text_bytes(batch.column("text")), BLOCK_BYTES):
                ids = batch.column("doc_id").slice(first, last - first)
                yield exchange_row(
                    kind,
                    0,
                    block_name(ids, data, offsets),
                    zstandard.compress(np.ascontiguousarray(data), 3),
                    planes(np.diff(offsets).astype(np.uint64), 8),
                    planes(every[first:last].view(np.uint64), 8)
                    + ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                )

    return run


def with_answers(batches, text_kind):
    """Text rows with the answers of their block; rows come ordered by block and kind."""
    current, answers = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            (row,) = batch.slice(i, 1).to_pylist()
            if row["block"] != current:
                current, answers = row["block"], [{} for _ in range(text_kind)]
            if row["kind"] < text_kind:
                answers[row["kind"]][row["bucket"]] = row
            else:
                yield row, answers


def read_text_row(row):
    """Bytes, offsets, ids and which ids are null of a row of ``text_rows``."""
    data = np.frombuffer(zstandard.decompress(row["keys"]), np.uint8)
    sizes = from_planes(row["parts"], 8).astype(np.int64)
    n = len(row["docs"]) - len(sizes)
    null = np.frombuffer(row["docs"][n:], bool)
    return data, np.append(0, np.cumsum(sizes)), from_planes(row["docs"][:n], 8).view(np.int64), null


def by_range(rows: DataFrame, partitions: int) -> DataFrame:
    return rows.repartition(partitions, "bucket").sortWithinPartitions("bucket", "block")


def by_block(rows: DataFrame, partitions: int) -> DataFrame:
    return rows.repartition(partitions, "block").sortWithinPartitions("block", "kind")
