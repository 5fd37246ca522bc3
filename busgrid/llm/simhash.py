"""SimHash near-dedup by anchor points of a covering code.

1. A document's fingerprint has a bit where more than half of its shingles' hashes have it.
   Equal fingerprints are one class; only distinct ones are compared.
2. The anchors are the codewords of ``BLOCKS`` Golay codes side by side, over 23 bits of the
   fingerprint each; the bits left over do not matter for the anchor. The code covers: each
   block of any fingerprint is within 3 bits of a codeword.
3. Two fingerprints that link have a number midway, and that has an anchor within the
   radius. One of the two is at most ``THRESHOLD // 2`` bits beyond the radius from it (near),
   the other at most the rest of the threshold (far), summed over blocks. So every
   fingerprint goes to all anchors within radius plus half the threshold, rounded up, and
   each anchor compares its near ones with all. This is exact: no link is missed.
4. Rows of an anchor come near ones first, so a task holds the near ones and reads the others
   past them. Near ones of an anchor with more than ``GROUP`` of them go to several tasks.
   Of the links of a batch a task returns a spanning forest, never all pairs.
5. Links make components; a component's id is its least document id.

About 61 rows leave each distinct fingerprint with two blocks, at 2^24 anchors; with three
119 at 2^36 (``blocks``), which pays when an anchor would hold very many.

Null and empty texts and texts of white space have fingerprint zero and link like any other;
with fewer than three words the whole sequence is the one shingle. A null id never names a
component; it is null only where no linked document has an id. Rows that share an id are
documents of their own; each gets a row. An empty table gives no rows. Other columns are not
read, whatever their names are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import golay
from busgrid.llm.common import lean, shuffle_partitions, table, text_bytes, written
from busgrid.llm.components import components
from busgrid.llm.wordruns import word_runs

SHINGLE, SEED, THRESHOLD = 3, 42, 3
BITS, BLOCKS = 64, 2
GROUP = 4096
#: Pairs that a task compares at once.
PAIRS = 1 << 21


def _hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hashes of all runs of n words, joined by blanks."""
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64
    )


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text as a signed number."""
    bits, shingles, words = np.zeros(BITS, np.int64), 0, []
    for run in word_runs(text.lower()):  # lower-cases A-Z only
        words += run
        if len(words) < SHINGLE:
            continue
        hashes = _hashes(words, SHINGLE)
        every = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += every.sum(axis=0, dtype=np.int64)
        shingles += len(hashes)
        words = words[len(words) - SHINGLE + 1 :]
    if not shingles and words:
        return int(_hashes(words, len(words)).view(np.int64)[0])
    return int(np.packbits(2 * bits > shingles, bitorder="little").view(np.int64)[0])


@lean
def _fingerprints(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        found = [
            fingerprint(data[a:b].tobytes())
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"]
        )


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fp of each document, written once."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(texts.mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")


def copies(fps: np.ndarray, most: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, anchor and bits beyond the radius, for all anchors at most ``most`` beyond it."""
    row = np.arange(len(fps))
    anchor, excess = np.zeros(len(fps), np.int64), np.zeros(len(fps), np.int64)
    for block in range(blocks):
        values = (fps.view(np.uint64) >> np.uint64(golay.LENGTH * block)).astype(np.int64)
        values &= golay.MASK
        parts = []
        for more in range(most + 1):
            of = np.flatnonzero(excess + more <= most)
            at, word = golay.anchors(values[row[of]], more)
            of = of[at]
            name = anchor[of] | word << (golay.MESSAGE_BITS * block)
            parts.append((row[of], name, excess[of] + more))
        row, anchor, excess = (np.concatenate(p) for p in zip(*parts, strict=True))
    return row, anchor, excess


def _replicate(most, near, blocks):
    @lean
    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            row, anchor, excess = copies(fps, most, blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(excess <= near), pa.array(fps[row])],
                ["anchor", "near", "fp"],
            )

    return run


@lean
def _count_near(batches):
    """How many rows of each anchor there are, batch by batch."""
    for batch in batches:
        anchor, n = np.unique(batch.column("anchor").to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], ["anchor", "n"])


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the least one that it hangs together with, instead of all links."""
    nodes, number = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = number[: len(u)], number[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            break
        least = np.minimum(x, y)
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        while (root != root[root]).any():
            root = root[root]
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _compare(threshold):
    @lean
    def run(batches):
        """Rows come ordered by anchor and part, near ones of the part first."""
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        key, held = None, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, part, fp = (batch.column(c).to_numpy() for c in ("anchor", "part", "fp"))
            mine = batch.column("mine").to_numpy(zero_copy_only=False)
            old = len(held) if key == (anchor[0], part[0]) else 0
            if old:  # near ones of a group that goes on
                anchor = np.append(np.repeat(anchor[:1], old), anchor)
                part = np.append(np.repeat(part[:1], old), part)
                fp, mine = np.append(held, fp), np.append(np.ones(old, bool), mine)
            change = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
            start = np.append(0, np.flatnonzero(change) + 1)
            size = np.diff(np.append(start, len(fp)))
            near = np.add.reduceat(mine.astype(np.int64), start)
            low, high = np.repeat(start, size), np.repeat(start + near, size)
            # Each row meets the near ones of its group that stand before it.
            meets = np.minimum(high, np.arange(len(fp))) - low
            meets[:old] = 0
            done = np.append(0, np.cumsum(meets))
            first = 0
            while first < len(fp):
                last = int(np.searchsorted(done, done[first] + PAIRS, side="right")) - 1
                last = min(len(fp), max(last, first + 1))
                n = meets[first:last]
                j = np.repeat(np.arange(first, last), n)
                i = np.arange(len(j)) - np.repeat(np.cumsum(n) - n - low[first:last], n)
                close = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= threshold
                if close.any():
                    u, v = spanning(fp[i[close]], fp[j[close]])
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)
                first = last
            key, held = (anchor[-1], part[-1]), fp[start[-1] : start[-1] + near[-1]]

    return run


def links(fps: DataFrame, threshold: int = THRESHOLD, blocks: int = BLOCKS) -> DataFrame:
    """u, v: links that connect all distinct fingerprints which differ in few bits."""
    partitions = shuffle_partitions(fps.sparkSession)
    near, far = threshold // 2, (threshold + 1) // 2
    schema = "anchor long, near boolean, fp long"
    close = fps.mapInArrow(_replicate(near, near, blocks), schema)
    full = written(
        close.mapInArrow(_count_near, "anchor long, n long")
        .groupBy("anchor")
        .agg(F.ceil(F.sum("n") / GROUP).alias("parts"))
        .where("parts > 1"),
        "full-anchors",
    )
    # The size of the written table settles whether it is broadcast.
    rows = fps.mapInArrow(_replicate(far, near, blocks), schema).join(full, "anchor", "left")
    home = F.pmod(F.xxhash64("fp"), F.col("parts"))
    place = F.explode(
        F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
            F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        )
    )
    mine = F.col("near") & (F.col("parts").isNull() | (home == F.col("part")))
    dealt = (
        rows.withColumn("part", place)
        .select("anchor", "part", mine.alias("mine"), "fp")
        .repartition(partitions, "anchor", "part")
        .sortWithinPartitions("anchor", "part", F.col("mine").desc())
    )
    return dealt.mapInArrow(_compare(threshold), "u long, v long")


def near_copies(
    documents: DataFrame, threshold: int = THRESHOLD, blocks: int = BLOCKS
) -> DataFrame:
    """doc_id, fp and component_id of each document."""
    docs = fingerprints(documents)
    least = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(least.select("fp"), threshold, blocks))
    named = written(
        least.join(roots, least["fp"] == roots["node"], "left").select(
            "fp", "least", F.coalesce("root", F.col("fp")).alias("root")
        ),
        "roots",
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(named.join(ids, "root").select("fp", "component_id"), "fp")


def op11_simhash(spark, sf_dir):
    return near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
