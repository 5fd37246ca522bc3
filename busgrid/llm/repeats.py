"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Every string of ``LENGTH`` bytes that also starts in a document with a smaller id is
removed from a document; strings never cross documents and are judged on the input.

The suffix arrays are sparse. Each window of LENGTH bytes has a mark, its KEY-byte piece
with the least hash, so equal windows have equal marks, and windows in a row that share
their mark form a segment. A block of documents is a batch: its array holds the suffixes
that start at marks, in the order of the mark's hash, each with a hash of its segment and
the least document that has it. Arrays are cut by ranges of the order; the task of a range
takes the batches in turn, keeps them as levels and merges levels of equal size, so that a
suffix is merged a logarithmic number of times. Merge-scanning a batch against the levels
tells which segments stand whole in a smaller document: all their windows go. Where
surroundings of a mark differ, as at the ends of a match, the windows themselves go
through a second family of levels in the same way.

Blocks read the documents three times, which must come in the same order each time, as
tables do; a block without all its answers is an error. Equal segments or windows of a block
travel once, so a passage that is everywhere counts once for each block.

Null text is empty. A null id counts as larger than all others. Documents with the same id
do not remove from each other. Repeated rows each get a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import lean, shuffle_partitions, slabs, table, text_bytes, written
from busgrid.llm.packing import (
    BLOCK_BYTES,
    EXCHANGE,
    LAST,
    block_name,
    by_block,
    by_range,
    exchange_row,
    from_planes,
    pack_sorted,
    planes,
    ranges,
    read_text_row,
    row_ids,
    text_rows,
    unpack_sorted,
    with_answers,
)

LENGTH, KEY = 50, 20
LONGEST = 32  # windows of a segment; two windows then cover it
SLAB_BYTES = 1 << 18  # arrays of this many numbers stay in a core's cache
KEY_BITS, PART_BYTES = 40, 4
U = np.uint64


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours."""
    size = 1
    while size * 2 <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (n - size)], values[n - size :])


def segments(data: np.ndarray, offsets: np.ndarray):
    """Mark hash, segment hash, text number, first and last window start of all segments."""
    found = []
    for first, _, part, at in slabs(data, offsets, SLAB_BYTES):
        if len(part) < LENGTH:
            continue
        levels = rolling.byte_levels(part, LENGTH)
        marks = _least(rolling.windows_at(levels, KEY), LENGTH - KEY + 1)
        inside = np.ones(len(marks) + 1, bool)  # windows that stay within a text
        inside[-1] = False
        ends = at[1:-1]
        late = np.maximum(ends[:, None] - np.arange(1, LENGTH), 0).ravel()
        inside[late[late < len(marks)]] = False
        short = np.flatnonzero(np.diff(at) < LENGTH)
        for i in short:
            inside[at[i] : at[i + 1]] = False
        # Texts are apart by windows that are not inside.
        change = np.ones(len(marks) + 1, bool)
        np.not_equal(marks[1:], marks[:-1], out=change[1:-1])
        before = np.append(False, inside[:-2])
        start = np.flatnonzero(inside[:-1] & (change[:-1] | ~before))
        stop = np.flatnonzero(inside[:-1] & (change[1:] | ~inside[1:]))
        if not len(start):
            continue
        long = stop - start >= LONGEST
        if long.any():  # texts that repeat themselves
            pieces = (stop - start) // LONGEST + 1
            number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.repeat(start, pieces) + number * LONGEST
            stop = np.minimum(np.repeat(stop, pieces), start + LONGEST - 1)
        whole = rolling.mix_pair(
            rolling.windows_at(levels, LENGTH, start), rolling.windows_at(levels, LENGTH, stop), 7
        )
        whole = rolling.mix(whole + (stop - start).astype(U))
        owner = np.searchsorted(at, start, side="right") - 1
        base = offsets[first]
        found.append((marks[start], whole, first + owner, base + start, base + stop))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(U), none.astype(U), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def sparse_array(marks, wholes, docs):
    """Distinct (key, part) in order with the least document, and each segment's entry.

    The key is a hash of the mark, as least hashes are not spread evenly; the part is the
    rest of what tells segments apart. KEY_BITS of the key and the first bits of the part
    make the tag by which arrays are sorted.
    """
    part = wholes & U((1 << 8 * PART_BYTES) - 1)
    tag = (rolling.mix(marks) >> U(64 - KEY_BITS) << U(64 - KEY_BITS)) | (wholes >> U(KEY_BITS))
    return distinct(tag, part, docs)


def distinct(tag, part, docs):
    """Distinct (tag, part) in the order of tags, least documents, and each row's entry."""
    order = np.argsort(tag, kind="stable")
    tag, part = tag[order], part[order]
    same = tag[1:] == tag[:-1]
    if (same & (part[1:] != part[:-1])).any():
        again = np.lexsort((part, tag))
        order, tag, part = order[again], tag[again], part[again]
        same = tag[1:] == tag[:-1]
    new = np.append(True, ~same | (part[1:] != part[:-1]))[: len(tag)]
    edge = np.flatnonzero(new)
    entry = np.empty(len(tag), np.int64)
    entry[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(docs[order], edge) if len(edge) else docs
    return tag[edge], part[edge], least, entry


def _send(name, buckets, tags, parts, docs):
    edges = ranges(tags, 64, buckets)
    for b in np.flatnonzero(np.diff(edges)):
        mine = slice(edges[b], edges[b + 1])
        low = docs[mine].min()
        yield exchange_row(
            0,
            b,
            name,
            pack_sorted(tags[mine], 8),
            planes(parts[mine], PART_BYTES) if parts is not None else b"",
            np.int64(low).tobytes() + planes((docs[mine] - low).astype(U), 8),
        )


def _receive(row):
    tags = unpack_sorted(row["keys"], 8)
    parts = from_planes(row["parts"], PART_BYTES) if row["parts"] else np.zeros(len(tags), U)
    low = np.frombuffer(row["docs"][:8], np.int64)[0]
    return tags, parts, from_planes(row["docs"][8:], 8).astype(np.int64) + low


class Levels:
    """Sorted arrays of (tag, part, least document); equal-sized neighbours are merged."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, tags, parts, docs) -> None:
        self.levels.append((tags, parts, docs))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self._merge()

    def _merge(self) -> None:
        """Two sorted runs; a stable sort merges such runs in linear time."""
        b, a = self.levels.pop(), self.levels.pop()
        self.levels.append(distinct(*(np.concatenate(x) for x in zip(a, b, strict=True)))[:3])

    def whole(self):
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0]


def _scan(level, key_bits):
    """Looks entries up in a level: the least document of each, and whether its key is asked.

    A key is asked if one of its parts is not found in the least document of the key; then
    the parts differ in places and only their windows can tell.
    """
    all_tags, all_parts, all_docs = level
    keys = all_tags >> U(64 - key_bits)
    new = np.append(True, keys[1:] != keys[:-1])
    edge, group = np.flatnonzero(new), np.cumsum(new) - 1
    later = all_docs > np.minimum.reduceat(all_docs, edge)[group]
    asked = np.maximum.reduceat(later, edge)[group]

    def look_up(tags, parts, docs):
        at = np.searchsorted(all_tags, tags)
        while True:  # equal tags of different parts stand side by side
            wrong = np.flatnonzero(all_parts[at] != parts)
            if not len(wrong):
                break
            at[wrong] += 1
        beaten = all_docs[at] < docs
        return beaten, asked[at] & ~beaten

    return look_up


def _merge_scan(key_bits):
    @lean
    def run(batches):
        """Rows come ordered by bucket; its batches form the levels, then are scanned."""
        current, seen, levels = None, [], Levels()

        def answers():
            if not seen:
                return
            look_up = _scan(levels.whole(), key_bits)
            for block, *entries in seen:
                beaten, asked = look_up(*entries)
                yield exchange_row(
                    0, current, block, np.packbits(beaten).tobytes(), np.packbits(asked).tobytes(),
                    len(beaten).to_bytes(8, "little"),
                )

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current:
                    yield from answers()
                    current, seen, levels = row["bucket"], [], Levels()
                entries = _receive(row)
                seen.append((row["block"], *entries))
                levels.add(*entries)
        yield from answers()

    return run


def _answers(rows: dict[int, dict], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Both flags of a block's entries, in order."""
    both = ([np.zeros(0, bool)], [np.zeros(0, bool)])
    for bucket in sorted(rows):
        count = int.from_bytes(rows[bucket]["docs"], "little")
        for flags, name in zip(both, ("keys", "parts"), strict=True):
            packed = np.frombuffer(rows[bucket][name], np.uint8)
            flags.append(np.unpackbits(packed, count=count).astype(bool))
    beaten, asked = (np.concatenate(flags) for flags in both)
    if len(beaten) != n:
        raise ValueError("a block lacks answers: did the documents change their order?")
    return beaten, asked


class Block:
    """A block as it came, its segments and what the first family said about them."""

    def __init__(self, row, answers):
        self.data, self.offsets, self.ids, self.null = read_text_row(row)
        marks, wholes, owner, self.start, self.stop = segments(self.data, self.offsets)
        docs = self.ids[owner]
        tags, _, least, entry = sparse_array(marks, wholes, docs)
        beaten, asked = _answers(answers, len(tags))
        self.gone = beaten[entry] | (docs > least[entry])
        open_ = asked[entry] & ~self.gone
        # The windows of open segments: places and documents.
        self.open_start, size = self.start[open_], (self.stop - self.start + 1)[open_]
        self.size = size
        self.place = _spread(self.open_start, size)
        self.doc = np.repeat(docs[open_], size)

    def windows(self):
        """Distinct hashes of the open windows with the least document, and each one's entry."""
        if not len(self.place):
            return np.zeros(0, U), None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = []
        room = self.size + LENGTH - 1
        ends = np.cumsum(room)
        for i in range(0, len(room), 4096):  # the bytes of some segments side by side
            part = slice(i, i + 4096)
            some = rolling.byte_windows(self.data[_spread(self.open_start[part], room[part])], LENGTH)
            hashes.append(some[_spread(ends[part] - room[part] - ends[i] + room[i], self.size[part])])
        tags, _, least, entry = distinct(
            np.concatenate(hashes), np.zeros(len(self.place), U), self.doc
        )
        return tags, None, least, entry


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start in a row."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of each document."""
    partitions = shuffle_partitions(documents.sparkSession)
    buckets = 2 * partitions
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    @lean

    def send_segments(batches):
        for batch in batches:
            every = row_ids(batch)
            for first, last, data, offsets in slabs(*text_bytes(batch.column("text")), BLOCK_BYTES):
                name = block_name(batch.column("doc_id").slice(first, last - first), data, offsets)
                marks, wholes, owner, _, _ = segments(data, offsets)
                entries = sparse_array(marks, wholes, every[first:last][owner])[:3]
                yield from _send(name, buckets, *entries)

    @lean

    def send_windows(batches):
        for row, answers in with_answers(batches, 1):
            yield from _send(row["block"], buckets, *Block(row, answers[0]).windows()[:3])

    @lean

    def cut(batches):
        for row, answers in with_answers(batches, 2):
            block = Block(row, answers[0])
            tags, _, least, entry = block.windows()
            beaten, _ = _answers(answers[1], len(tags))
            gone = block.place[beaten[entry] | (block.doc > least[entry])]
            yield from _kept(block, gone)

    def in_ranges(rows, key_bits):
        return by_range(rows, partitions).mapInArrow(_merge_scan(key_bits), EXCHANGE)

    of_segments = written(in_ranges(texts.mapInArrow(send_segments, EXCHANGE), KEY_BITS), "marks")
    open_ = by_block(
        of_segments.unionByName(texts.mapInArrow(text_rows(1), EXCHANGE)), partitions
    )
    of_windows = in_ranges(open_.mapInArrow(send_windows, EXCHANGE), 64)
    together = of_segments.unionByName(of_windows.withColumn("kind", F.lit(1)))
    together = by_block(
        together.unionByName(texts.mapInArrow(text_rows(2), EXCHANGE)), partitions
    )
    return together.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def _kept(block: Block, gone: np.ndarray):
    n = len(block.data)
    start = np.append(block.start[block.gone], gone)
    stop = np.append(block.stop[block.gone], gone) + LENGTH
    step = np.bincount(start, minlength=n + 1) - np.bincount(stop, minlength=n + 1)
    removed = np.cumsum(step[:-1]) > 0
    opens = removed.copy()
    opens[1:] &= ~removed[:-1]
    text_start = block.offsets[:-1][np.diff(block.offsets) > 0]
    opens[text_start] = removed[text_start]
    at = block.offsets
    cuts = np.append(0, np.cumsum(~removed))[at]
    count = lambda flags: np.diff(np.append(0, np.cumsum(flags))[at])
    kept = block.data[~removed].tobytes()
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(block.ids, mask=block.null),
            "n_bytes": pa.array(np.diff(at)),
            "n_removed": pa.array(count(removed)),
            "n_spans": pa.array(count(opens)),
            "kept": pa.array(
                [kept[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()
            ),
        }
    )


def op8_repeats(spark, sf_dir):
    kept = dedup(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP8_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (
  select doc_id, i, substr(h, 2 * i + 1, 100) as k
  from (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from d)),
f as (select k, min(doc_id) as m from w group by k),
g as (
  select doc_id, i, i > 50 + coalesce(lag(i) over (partition by doc_id order by i), -51) as opens
  from w join f using (k) where m < doc_id),
r as (
  select doc_id, min(i) as a, max(i) + 50 as b
  from (select *, sum(opens::int) over (partition by doc_id order by i) as run from g)
  group by doc_id, run),
k as (
  select doc_id, a, b,
    substr(h, 2 * lag(b, 1, 0) over o + 1, 2 * (a - lag(b, 1, 0) over o)) as kept
  from r join d using (doc_id) window o as (partition by doc_id order by a)),
s as (
  select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as stop,
    string_agg(kept, '' order by a) as kept
  from k group by doc_id)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * stop + 1), h))) as kept_sha256
from d left join s using (doc_id)
"""
