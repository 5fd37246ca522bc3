"""Byte-level BPE by a global shuffle of distinct words.

A block of documents sends each of its distinct pre-tokens once, packed with those of the
same hash bucket, to the task of the bucket. There every distinct piece of the corpus is
encoded once, and its ids go back to the blocks that have it. A block's documents travel
as numbers of pieces by position; where they meet the ids, texts are reassembled. Decoding
joins the table of tokens' bytes, which is as large as the vocabulary.

Both branches read the documents, which must come in the same order each time, as tables
do: a block has the hash of its content as its name, and a block without all its ids is an
error. A row of the exchange holds at most the pieces of one block, a bucket's task one
bucket's distinct pieces; a piece that is everywhere counts once for each block.

Null and empty texts have no ids. Repeated rows each get a row.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import lean, shuffle_partitions, slabs, table, text_bytes
from busgrid.llm.packing import block_name, pack, unpack
from busgrid.llm.pretokens import cuts, expand

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK_BYTES = 4 << 20

WORDS = "bucket int, block long, sizes binary, pieces binary"
IDS = "bucket int, block long, sizes binary, pieces binary"
SCHEMA = "doc_id long, ids array<int>"


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}
    )


@functools.cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in the order of their ids, and where each one starts."""
    by_id = {rank: token for token, rank in ranks(path).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    return (
        np.frombuffer(b"".join(tokens), np.uint8),
        np.append(0, np.cumsum([len(t) for t in tokens])),
    )


def _blocks(batches):
    """doc_ids, bytes and offsets of each block, its distinct pieces and their numbers."""
    for batch in batches:
        for first, last, data, offsets in slabs(*text_bytes(batch.column("text")), BLOCK_BYTES):
            doc_ids = batch.column("doc_id").slice(first, last - first)
            starts = cuts(data, offsets)
            hashes = rolling.piece_hashes(data, starts, np.append(starts[1:], len(data)))
            yield block_name(doc_ids, data, offsets), doc_ids, data, offsets, starts, hashes


def _distinct(hashes: np.ndarray):
    """First place of each distinct hash and the number of each piece, frequent ones first."""
    _, first, inverse, counts = np.unique(
        hashes, return_index=True, return_inverse=True, return_counts=True
    )
    order = np.lexsort((first, -counts))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[inverse] if len(order) else inverse


def _by_bucket(first: np.ndarray, hashes: np.ndarray, buckets: int):
    bucket = (hashes[first] % np.uint64(buckets)).astype(np.int64)
    return bucket, np.argsort(bucket, kind="stable")


def encode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each document."""
    partitions = shuffle_partitions(documents.sparkSession)
    buckets = 2 * partitions
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    @lean

    def send_words(batches):
        for name, _, data, _, starts, hashes in _blocks(batches):
            first, _ = _distinct(hashes)
            bucket, order = _by_bucket(first, hashes, buckets)
            sizes = (np.append(starts[1:], len(data)) - starts)[first]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                mine = order[edges[b] : edges[b + 1]]
                size = sizes[mine]
                at = np.repeat(starts[first[mine]] - np.cumsum(size) + size, size)
                pieces = data[at + np.arange(int(size.sum()))].tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b], pa.int32()),
                        "block": pa.array([name], pa.int64()),
                        "sizes": [pack(size)],
                        "pieces": [zstandard.compress(pieces, 3)],
                    }
                )

    @lean

    def send_positions(batches):
        for name, doc_ids, data, offsets, starts, hashes in _blocks(batches):
            first, number = _distinct(hashes)
            bucket, _ = _by_bucket(first, hashes, buckets)
            counts = np.diff(np.searchsorted(starts, offsets))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([doc_ids], ["doc_id"]))
            parts = [pack(counts), pack(bucket), pack(number), sink.getvalue().to_pybytes()]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([buckets], pa.int32()),  # after all ids
                    "block": pa.array([name], pa.int64()),
                    "sizes": [pack(np.array([len(p) for p in parts]))],
                    "pieces": [b"".join(parts)],
                }
            )

    @lean

    def encode_words(batches):
        """Rows come ordered by bucket; its pieces are encoded as they first appear."""
        coder, current, known, found = encoding(path), None, {}, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    current, known, found = row["bucket"], {}, []
                sizes = unpack(row["sizes"])
                pieces = zstandard.decompress(row["pieces"])
                ends = np.cumsum(sizes).tolist()
                ids = []
                for start, end in zip([0, *ends], ends, strict=False):
                    piece = pieces[start:end]
                    number = known.get(piece)
                    if number is None:
                        number = known[piece] = len(found)
                        found.append(coder.encode_ordinary(piece.decode()))
                    ids.append(found[number])
                flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([current], pa.int32()),
                        "block": pa.array([row["block"]], pa.int64()),
                        "sizes": [pack(np.fromiter(map(len, ids), np.int64, len(ids)))],
                        "pieces": [pack(flat)],
                    }
                )

    @lean

    def reassemble(batches):
        """Rows come ordered by block and bucket, positions last."""
        current, ids = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != current:
                    current, ids = row["block"], {}
                if row["bucket"] < buckets:
                    ids[row["bucket"]] = unpack(row["sizes"]), unpack(row["pieces"])
                else:
                    yield from _texts(row, ids)

    by_block = ["block", "bucket"]
    words = texts.mapInArrow(send_words, WORDS).repartition(partitions, "bucket")
    ids = words.sortWithinPartitions("bucket").mapInArrow(encode_words, IDS)
    positions = texts.mapInArrow(send_positions, IDS)
    together = ids.unionByName(positions).repartition(partitions, "block")
    return together.sortWithinPartitions(*by_block).mapInArrow(reassemble, SCHEMA)


def _texts(row, by_bucket):
    ends = np.cumsum(unpack(row["sizes"]))
    counts, bucket, number = (
        unpack(row["pieces"][a:b]) for a, b in zip([0, *ends[:2]], ends[:3], strict=True)
    )
    doc_ids = pa.ipc.open_stream(row["pieces"][ends[2] :]).read_all().column(0).combine_chunks()
    order = np.argsort(bucket, kind="stable")
    needed = np.unique(bucket).tolist()
    sizes = [by_bucket.get(b, ((), ()))[0] for b in needed]
    if sum(map(len, sizes)) != len(bucket):
        raise ValueError("a block lacks ids of its pieces: did the documents change their order?")
    size, place = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
    flat = np.zeros(0, np.int64)
    if needed:
        size[order] = np.concatenate(sizes)
        flat = np.concatenate([by_bucket[b][1] for b in needed])
        place[order] = np.cumsum(size[order]) - size[order]
    ends = np.append(0, np.cumsum(size[number]))
    at = np.repeat(place[number] - ends[:-1], size[number]) + np.arange(ends[-1])
    edges = ends[np.append(0, np.cumsum(counts))]
    for first in range(0, len(counts), 1000):
        part = edges[first : first + 1001]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": doc_ids.slice(first, len(part) - 1),
                "ids": pa.ListArray.from_arrays(
                    pa.array(part - part[0], pa.int32()),
                    pa.array(flat[at[part[0] : part[-1]]].astype(np.int32)),
                ),
            }
        )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _decoded(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and their offsets."""
    at, ids = _lists(column)
    data, ends = expand(ids[at[0] : at[-1]], *token_bytes(path))
    return data, ends[at - at[0]]


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row's ids; bytes that are no UTF-8 are replaced."""

    def texts(batches):
        for batch in batches:
            data, at = _decoded(batch.column("ids"), path)
            found = [
                data[a:b].tobytes().decode("utf-8", "replace")
                for a, b in zip(at[:-1], at[1:], strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text": pa.array(found, pa.string())}
            )

    return rows.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


def digests(rows: DataFrame, path: str) -> DataFrame:
    """Counts and digests of ids and of what they decode to."""

    @lean

    def digest(batches):
        for batch in batches:
            at, ids = _lists(batch.column("ids"))
            raw = memoryview(ids.astype("<u4").tobytes())
            data, edges = _decoded(batch.column("ids"), path)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(np.diff(at).astype(np.int64)),
                    "ids_sha256": [
                        hashlib.sha256(raw[4 * a : 4 * b]).hexdigest()
                        for a, b in zip(at[:-1], at[1:], strict=True)
                    ],
                    "decoded_sha256": [
                        hashlib.sha256(data[a:b].tobytes()).hexdigest()
                        for a, b in zip(edges[:-1], edges[1:], strict=True)
                    ],
                }
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(digest, schema)


def op5_bpe(spark, sf_dir):
    path = public_tokenizers.path(VOCABULARY)
    return digests(encode(table(spark, sf_dir, "documents"), path), path)
