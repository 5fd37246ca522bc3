"""What each filter removes in each order, from sorted posting lists of failing documents.

Every document is measured once. Its part, id and failed filters then go to ranges of
(part, id), in order, so that a task reads runs of one part by ascending id. A run of at
most ``RUN`` documents is an id range; for it a task keeps a sorted list of the failing
documents per filter, and one per label. Unions of filters grow by merging one more list
into a smaller union, where each element of the shorter list gallops through the longer
one; documents with a label are looked up in a union the same way. Only sizes of unions
leave the task, one row per part and set of filters, and are summed.

All orders follow from these sizes: a step removes the difference of two unions, each of
the filters applied so far. So every order of the filters is exact, and the work per
document does not grow with the number of orders.

Null text is empty; null lang is the part of the empty string. A null id counts as larger
than all others and has no label. Rows that share an id are documents of their own, and
equal texts under one id are not copies of each other; several labels of an id count if
any says so. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm.common import lean, shuffle_partitions, table, text_bytes, written
from busgrid.llm.wordruns import word_runs

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
SETS = 1 << len(FILTERS)
#: Labels are flags above those of the filters.
GOOD, TOXIC = SETS, 2 * SETS
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
CAPITALS = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
#: Rows of one id range.
RUN = 1 << 16
SALTS = 16
LAST = np.iinfo(np.int64).max


def failures(text: bytes) -> int:
    """Flags of the filters that look at one text alone."""
    words, distinct = 0, set()
    for run in word_runs(text):
        words += len(run)
        distinct.update(run)
    chars = int((np.frombuffer(text, np.uint8) & 0xC0 != 0x80).sum())
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        words < MIN_WORDS,
        100 * len(distinct) < MIN_DISTINCT * words,
        100 * capitals > MAX_CAPITALS * chars,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(fail << i for i, fail in enumerate(fails))


@lean
def _measured(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        flags, digests = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            text = data[a:b].tobytes()
            flags.append(failures(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("part"),
                pa.array(flags, pa.int32()),
                pa.array(digests, pa.binary()),
            ],
            ["id", "part", "flags", "digest"],
        )


def measured(documents: DataFrame) -> DataFrame:
    """id, part, flags of the first four filters and content digest of each document, written."""
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        "text",
    )
    schema = "id long, part string, flags int, digest binary"
    return written(rows.mapInArrow(_measured, schema), "audit-measured")


def _with_copies(rows: DataFrame) -> DataFrame:
    """Adds the flag of later copies; copies of one text are dealt to several tasks."""
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = first.where("first < last").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    later = F.when(F.col("id") > F.col("first"), COPY).otherwise(0)
    return salted.join(first, ["digest", "salt"], "left").select(
        "id", "part", "digest", F.col("flags").bitwiseOR(later).alias("flags")
    )


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    has = lambda column, flag: F.max(F.when(F.col(column) == 1, flag).otherwise(0))
    marks = (
        labels.where("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((has("quality", GOOD) + has("toxic", TOXIC)).alias("marks"))
    )
    known = F.when(F.col("id") == LAST, 0).otherwise(F.coalesce("marks", F.lit(0)))
    return rows.join(marks, "id", "left").select(
        "part", "id", "digest", F.col("flags").bitwiseOR(known).alias("flags")
    )


def found(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where elements of the shorter sorted list stand in the longer one, and if they do."""
    at = np.searchsorted(long, short)
    there = at < len(long)
    there[there] = long[at[there]] == short[there]
    return there


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two sorted lists; the shorter gallops through the longer."""
    if len(a) > len(b):
        a, b = b, a
    new = a[~found(a, b)]
    return np.insert(b, np.searchsorted(b, new), new) if len(new) else b


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted lists share."""
    if len(a) > len(b):
        a, b = b, a
    return int(found(a, b).sum())


def union_sizes(flags: np.ndarray) -> np.ndarray:
    """For each set of filters how many documents of a range fail one of them.

    Columns: all, good, toxic documents. The empty set has the number of all documents.
    """
    lists = [np.flatnonzero(flags & (1 << f)) for f in range(len(FILTERS))]
    marked = [np.flatnonzero(flags & mark) for mark in (GOOD, TOXIC)]
    sizes = np.zeros((SETS, 3), np.int64)
    sizes[0, 0] = len(flags)
    unions = {0: np.zeros(0, np.int64)}
    for filters in range(1, SETS):
        top = filters.bit_length() - 1
        unions[filters] = merged(unions[filters ^ (1 << top)], lists[top])
        sizes[filters] = [len(unions[filters]), *(common(unions[filters], m) for m in marked)]
    return sizes


def _count_runs(batches):
    """Rows come ordered by part and id; sizes of a part's runs are summed before they leave."""
    current, waiting, held, sizes = None, [], 0, np.zeros((SETS, 3), np.int64)

    def counted():
        n = SETS
        return pa.RecordBatch.from_arrays(
            [pa.array([current] * n, pa.string()), pa.array(np.arange(n, dtype=np.int32))]
            + [pa.array(sizes[:, i]) for i in range(3)],
            ["part", "filters", "fail", "good", "toxic"],
        )

    for batch in batches:
        parts = batch.column("part")
        flags = batch.column("flags").to_numpy(zero_copy_only=False)
        starts = [0] if batch.num_rows else []
        if batch.num_rows > 1:
            changes = pa.compute.not_equal(parts.slice(1), parts.slice(0, batch.num_rows - 1))
            starts += (np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            name = parts[a].as_py()
            if name != current:
                if current is not None:
                    sizes += union_sizes(np.concatenate(waiting))
                    yield counted()
                current, waiting, held, sizes = name, [], 0, np.zeros((SETS, 3), np.int64)
            waiting.append(flags[a:b])
            held += b - a
            if held >= RUN:
                sizes += union_sizes(np.concatenate(waiting))
                waiting, held = [np.zeros(0, flags.dtype)], 0
    if current is not None:
        sizes += union_sizes(np.concatenate(waiting))
        yield counted()


def unions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filters (a set, as bits), fail, good, toxic: sizes of the unions of failing ids."""
    rows = _with_labels(_with_copies(measured(documents)), labels)
    # The digest only splits an id that very many rows share.
    ranges = rows.repartitionByRange(
        shuffle_partitions(documents.sparkSession), "part", "id", "digest"
    ).sortWithinPartitions("part", "id")
    sizes = ranges.select("part", "flags").mapInArrow(
        _count_runs, "part string, filters int, fail long, good long, toxic long"
    )
    return sizes.groupBy("part", "filters").agg(
        *[F.sum(c).alias(c) for c in ("fail", "good", "toxic")]
    )


def steps() -> list[tuple[str, int, str, int, int]]:
    """filter_order, step, filter, and the sets of filters before and after each step."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            after = before | 1 << FILTERS.index(name)
            out.append(("".join(order), i + 1, name, before, after))
            before = after
    return out


@lean
def _steps_of_parts(batches):
    plan = steps()
    order, step, name = (pa.array([s[i] for s in plan]) for i in range(3))
    before, after = (np.array([s[i] for s in plan]) for i in (3, 4))
    mine, everything = after ^ before, SETS - 1
    place = np.array([FILTERS.index(s[2]) for s in plan])
    for batch in batches:
        for row in batch.to_pylist():
            fail, good, toxic = np.zeros((3, SETS), np.int64)
            for filters, *sizes in (tuple(u.values()) for u in row["sizes"]):
                fail[filters], good[filters], toxic[filters] = sizes
            n, fail[0] = fail[0], 0  # the empty set came with the number of all documents
            removed = fail[after] - fail[before]
            columns = {
                "filter_order": order,
                "step": step.cast(pa.int32()),
                "filter": name,
                "kept": n - fail[after],
                "removed": removed,
                "redundant": fail[mine] - removed,
                "unique_fails": fail[everything] - fail[everything ^ mine],
                "good_lost": good[after] - good[before],
                "toxic_lost": toxic[after] - toxic[before],
                "shapley": np.bincount(place, removed)[place].astype(np.int64),
            }
            yield pa.RecordBatch.from_pydict({"part": [row["part"]] * len(plan), **columns})


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    per_part = (
        unions(documents, labels)
        .groupBy("part")
        # One entry for each set of filters.
        .agg(F.collect_list(F.struct("filters", "fail", "good", "toxic")).alias("sizes"))
    )
    counts = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    schema = "part string, filter_order string, step int, filter string, "
    return per_part.mapInArrow(_steps_of_parts, schema + ", ".join(f"{c} long" for c in counts))


def op13_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
l as (
  select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic
  from labels where doc_id is not null group by doc_id),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [len(words) < 200,
     100 * len(list_distinct(words)) < 50 * len(words),
     100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id, 9223372036854775807) >
       min(coalesce(doc_id, 9223372036854775807)) over (partition by text)] as fails
  from d left join l using (doc_id)),
c as (  -- documents by what they fail
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from f group by part, fails),
n(name, i) as (values ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
o as (
  select a.name || b.name || c.name || d.name || e.name as filter_order,
    [a.i, b.i, c.i, d.i, e.i] as places
  from n a join n b on b.i <> a.i join n c on c.i not in (a.i, b.i)
    join n d on d.i not in (a.i, b.i, c.i) join n e on e.i not in (a.i, b.i, c.i, d.i)),
s as (
  select filter_order, step, places[step]::int as mine, places[:step - 1] as earlier
  from o, (select unnest(range(1, 6))::int as step)),
r as (
  select c.part, filter_order, step, mine, sum(n) as all_rows,
    coalesce(sum(n) filter (fails[mine] and not gone), 0) as removed,
    coalesce(sum(n) filter (fails[mine] and gone), 0) as redundant,
    coalesce(sum(n) filter (fails[mine] or gone), 0) as out_so_far,
    coalesce(sum(n) filter (fails[mine] and len(list_filter(fails, lambda x: x)) = 1), 0) as unique_fails,
    coalesce(sum(good) filter (fails[mine] and not gone), 0) as good_lost,
    coalesce(sum(toxic) filter (fails[mine] and not gone), 0) as toxic_lost
  from (select c.*, s.*, len(list_filter(earlier, lambda i: fails[i])) > 0 as gone from c, s) c
  group by all)
select part, filter_order, step, substr('ABCDE', mine, 1) as filter,
  (all_rows - out_so_far)::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, mine))::bigint as shapley
from r
"""
