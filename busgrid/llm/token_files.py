"""Token ids in ORC files: integer run lengths, row indexes, Bloom filters on document ids.

Documents are dealt by ranges of their id, so files hold ascending ids and their stripes
and row groups narrow ranges. ORC stores the ids as run-length encoded integers and keeps
the least and largest doc_id of each row group and a Bloom filter; readers take stripes in
parallel and skip those that a filter on doc_id rules out (``read`` with ids).

A text is cut by the vocabulary's pattern and each distinct piece goes through the
tokenizers library once while a worker remembers it; texts with characters from U+0280 on
go whole through the library, whose Unicode tables may be newer, and so do texts that hold
the string of a special token: the library takes it for the token, unless
``special_as_text`` makes it ordinary text.

Null and empty texts have the end id alone. A null id sorts first; rows with one id are
ordered by the hash of their text. An empty table gives no files and no rows.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import shuffle_partitions, slabs, table, text_bytes, work_folder
from busgrid.llm.pretokens import cuts, expand, plain

VOCABULARY, END = "byte_bpe_50k.json", 2
REMEMBERED = 800_000
ORC = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id long, n_tokens long, part int, before long, ids array<int>"


class Encoder:
    """Encodes texts with the library; remembers distinct pieces, by hash, within bounds."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        tokens = {} if special_as_text else self.library.get_added_tokens_decoder()
        self.special = [token.content.encode() for token in tokens.values()]
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.number = np.zeros(0, np.int64)  # of each of them
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes.sum()))
        return flat, np.append(0, np.cumsum(sizes))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the offsets of texts."""
        if len(self.known) > REMEMBERED:
            self.forget()
        starts = cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = rolling.piece_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            whole = data.tobytes()
            pieces = [
                whole[a:b].decode()
                for a, b in zip(starts[first[new]], ends[first[new]], strict=True)
            ]
            flat, edges = self.library_ids(pieces)
            numbers = np.arange(new.sum()) + len(self.offsets) - 1
            self.known = np.insert(self.known, at[new], distinct[new])
            self.number = np.insert(self.number, at[new], numbers)
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + edges[1:]])
            self.ids = np.concatenate([self.ids, flat])
        number = self.number[np.searchsorted(self.known, distinct)] if len(distinct) else distinct
        flat, edges = expand(number[inverse].astype(np.int64), self.ids, self.offsets)
        return flat, edges[np.searchsorted(starts, offsets)]

    def _with_special(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The texts that hold the string of a special token."""
        whole, found = data.tobytes(), []
        for token in self.special:
            at = whole.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(token) <= offsets[text + 1]:
                    found.append(text)
                at = whole.find(token, at + 1)
        return found

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text."""
        split = plain(data, offsets)
        split[self._with_special(data, offsets)] = False
        flat, at = self.encode(data, offsets)
        ids = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        for i in np.flatnonzero(~split):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            ids[i] = self.library_ids([text])[0]
        return ids


@functools.cache
def encoder_of(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path, special_as_text)


def write(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    end: int = END,
    special_as_text: bool = False,
) -> None:
    """Writes the ids of all documents in ascending order of doc_id."""
    spark = documents.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc()]
    texts = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
        )
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )

    def encode(batches):
        encoder, before = encoder_of(vocabulary, special_as_text), 0
        for batch in batches:
            for first, last, *part in slabs(*text_bytes(batch.column("text"))):
                rows = batch.slice(first, last - first)
                ids = encoder.encode_rows(*part)
                sizes = np.fromiter((len(i) + 1 for i in ids), np.int64, len(ids))
                at = np.append(0, np.cumsum(sizes))
                tail = np.array([end], np.int32)
                flat = np.concatenate([x for i in ids for x in (i, tail)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "n_tokens": pa.array(sizes),
                        "part": rows.column("part"),
                        "before": pa.array(before + at[:-1]),
                        "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)),
                    }
                )
                before += int(at[-1])

    texts.mapInArrow(encode, SCHEMA).write.options(**ORC).orc(path)


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of the files with their place: ``start`` counts all ids before a document.

    With ``doc_ids`` only stripes and row groups are read that may hold them.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    # One row for each written file.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit numbers."""

    def crc(batches):
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            sums = [
                zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "start": batch.column("start"),
                    "n_tokens": batch.column("n_tokens"),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    return rows.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark, sf_dir):
    path = work_folder(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return checksums(read(spark, path))
