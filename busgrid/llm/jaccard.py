"""Exact Jaccard join of shingle sets and the components of its links.

1. Documents with equal sets are one class; only classes are compared.
2. Blocks of documents send their distinct shingles to ranges of the hash, packed, and get
   back how frequent each one is in the corpus. A set that has less than the threshold in
   shared shingles links with nothing; nearly all sets end here.
3. The others order their shingles rare first. Linked sets share one of the first
   ``n - ceil(t * n) + 1``, so sets are put into families that hang together by those.
4. A family is joined in one group of at most ``GROUP`` sets with inverted lists. Lists
   are in blocks by position; a block whose sets have too little left after that position
   is skipped with all later ones. A set that is like one already answered derives its
   overlaps from that one's, by the lists of the shingles in which they differ.
5. A larger family goes in groups with ``HUB`` common sets of the family each. Sets that
   hang together through them need no comparison; only sets left outside the family's
   largest component are compared with all, group by group.
6. Links found make components; a component's id is its least document id.

Null and empty texts and texts of white space have no shingle and link with nothing; with
fewer than five words the whole sequence is the one shingle. A null id never names a
component; it is null only where no linked document has an id. Rows that share an id are
compared as documents of their own; each gets a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm import rolling
from busgrid.llm.common import (
    lean,
    packed,
    shuffle_partitions,
    slabs,
    table,
    text_bytes,
    unpacked,
    written,
)
from busgrid.llm.components import components
from busgrid.llm.packing import (
    BLOCK_BYTES,
    EXCHANGE,
    block_name,
    by_block,
    by_range,
    exchange_row,
    from_planes,
    pack_sorted,
    planes,
    ranges,
    read_text_row,
    text_rows,
    unpack_sorted,
    with_answers,
)

SHINGLE, THRESHOLD = 5, 75
GROUP, HUB, SKIP_BLOCK = 256, 32, 64
BITS, KEY_BITS = 52, 40
U = np.uint64


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Distinct shingle hashes of all texts, sorted within each text, and their offsets."""
    found, sizes = [np.zeros(0, U)], []
    for _, _, some, at in slabs(data, offsets):
        for a in range(0, len(at) - 1, 4000):  # numbers of texts have 12 bits
            edge = at[a : a + 4001]
            part, rows = some[edge[0] : edge[-1]], len(edge) - 1
            starts, ends, first = rolling.words(part, edge - edge[0])
            hashes = rolling.piece_hashes(part, starts, ends, rolling.LOWER)
            n_words = np.diff(first)
            owner = np.repeat(np.arange(rows), n_words)
            grams = rolling.windows(hashes, SHINGLE)
            whole = owner[: len(grams)] == owner[SHINGLE - 1 :] if len(grams) else owner[:0]
            keys, of = [grams[whole]], [owner[: len(grams)][whole]]
            for n in range(1, SHINGLE):
                short = np.flatnonzero(n_words == n)
                if len(short):
                    keys.append(rolling.mix(rolling.windows(hashes, n)[first[short]] + U(n)))
                    of.append(short)
            key, owner = np.concatenate(keys), np.concatenate(of).astype(U)
            key = np.unique((owner << U(BITS)) | (key >> U(64 - BITS)))
            sizes.append(np.bincount((key >> U(BITS)).astype(np.int64), minlength=rows))
            found.append(key & U((1 << BITS) - 1))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return np.concatenate(found), np.append(0, np.cumsum(sizes))


def _classes(tokens: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A number for each set, the same for equal sets."""
    sums = np.append(U(0), np.cumsum(rolling.mix(tokens + U(1))))
    more = np.append(U(0), np.cumsum(rolling.mix(tokens ^ U(0xA5A5A5A5A5A5A5A5))))
    first, last = edges[:-1], edges[1:]
    size = (last - first).astype(U)
    name = rolling.mix(sums[last] - sums[first]) ^ rolling.mix((more[last] - more[first]) * U(3))
    return rolling.mix(name + size).view(np.int64)


@lean


def _sets(batches):
    """doc_id, number of shingles, class and the hash of the text of each document."""
    for batch in batches:
        for first, last, data, offsets in slabs(*text_bytes(batch.column("text"))):
            tokens, edges = _tokens(data, offsets)
            sizes = np.diff(edges)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(first, last - first),
                    "n_shingles": pa.array(sizes),
                    "class": pa.array(_classes(tokens, edges), mask=sizes == 0),
                    "text_hash": batch.column("text_hash").slice(first, last - first),
                }
            )


def _once(classes: np.ndarray) -> np.ndarray:
    """The first text of each class."""
    return np.sort(np.unique(classes, return_index=True)[1])


def _block_keys(tokens: np.ndarray, edges: np.ndarray):
    """Sorted distinct keys of a block's classes, in how many they are, and each token's."""
    keys, number, counts = np.unique(
        tokens >> U(BITS - KEY_BITS), return_inverse=True, return_counts=True
    )
    return keys, counts, number


def _of_rows(tokens, edges, rows):
    sizes = np.diff(edges)[rows]
    at = np.repeat(edges[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    return tokens[at], np.append(0, np.cumsum(sizes))


def _send_keys(buckets):
    @lean
    def run(batches):
        for batch in batches:
            for first, last, data, offsets in slabs(*text_bytes(batch.column("text")), BLOCK_BYTES):
                name = block_name(batch.column("doc_id").slice(first, last - first), data, offsets)
                tokens, edges = _tokens(data, offsets)
                tokens, edges = _of_rows(tokens, edges, _once(_classes(tokens, edges)))
                keys, counts, _ = _block_keys(tokens, edges)
                at = ranges(keys, KEY_BITS, buckets)
                for b in np.flatnonzero(np.diff(at)):
                    mine = slice(at[b], at[b + 1])
                    yield exchange_row(
                        0,
                        b,
                        name,
                        pack_sorted(keys[mine], KEY_BITS // 8),
                        planes(np.minimum(counts[mine], 0xFFFF), 2),
                    )

    return run


@lean


def _count_keys(batches):
    """Rows come ordered by range; answers 0 for a key seen once, else its rank of frequency."""
    current, seen = None, []

    def answers():
        if not seen:
            return
        keys = np.concatenate([k for _, k, _ in seen])
        counts = np.concatenate([c for _, _, c in seen])
        order = np.argsort(keys, kind="stable")
        edge = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        total = np.add.reduceat(counts[order], edge)
        distinct = keys[order][edge]
        for block, mine, _ in seen:
            n = total[np.searchsorted(distinct, mine)]
            rank = np.where(n == 1, 0, np.minimum(255, 1 + (8 * np.log2(n)).astype(np.int64)))
            yield exchange_row(0, current, block, planes(rank, 1))

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current:
                yield from answers()
                current, seen = row["bucket"], []
            seen.append(
                (
                    row["block"],
                    unpack_sorted(row["keys"], KEY_BITS // 8),
                    from_planes(row["parts"], 2).astype(np.int64),
                )
            )
    yield from answers()


@lean


def _survivors(batches):
    """Sets with enough shared shingles: class, size, shared tokens, first tokens and places."""
    for row, (answers,) in with_answers(batches, 1):
        data, offsets, _, _ = read_text_row(row)
        tokens, edges = _tokens(data, offsets)
        classes = _classes(tokens, edges)
        rows = _once(classes)
        tokens, edges = _of_rows(tokens, edges, rows)
        keys, _, number = _block_keys(tokens, edges)
        ranks = [from_planes(answers[b]["keys"], 1) for b in sorted(answers)]
        rank = np.concatenate([np.zeros(0, U), *ranks])
        if len(rank) != len(keys):
            raise ValueError("a block lacks answers: did the documents change their order?")
        rank = rank[number].astype(np.int64)
        shared = np.append(0, np.cumsum(rank > 0))
        sizes = np.diff(edges)
        enough = 100 * (shared[edges[1:]] - shared[edges[:-1]]) >= THRESHOLD * sizes
        for i in np.flatnonzero(enough & (sizes > 0)):
            n = int(sizes[i])
            mine, my_rank = tokens[edges[i] : edges[i + 1]], rank[edges[i] : edges[i + 1]]
            order = np.lexsort((mine, my_rank))
            alone = int((my_rank == 0).sum())
            last = n - -(-THRESHOLD * n // 100) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "class": pa.array([classes[rows[i]]]),
                    "n": pa.array([n], pa.int64()),
                    "tokens": [pack_sorted(mine[my_rank > 0], 7)],
                    "first": pa.array(
                        [mine[order[alone:last]].view(np.int64)], pa.list_(pa.int64())
                    ),
                    "alone": pa.array([alone], pa.int64()),
                }
            )


class Group:
    """Sets of one task's group, joined by inverted lists; answers derive from like sets."""

    def __init__(self, rows):
        rows = sorted({r["class"]: r for r in rows}.values(), key=lambda r: (r["n"], r["class"]))
        self.rows = rows
        self.size = np.array([r["n"] for r in rows], np.int64)
        sets = [unpack_sorted(r["tokens"], 7) for r in rows]
        every = np.concatenate(sets)
        self.names, number = np.unique(every, return_inverse=True)
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        self.sets = np.split(number, cuts)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(number, kind="stable")
        self.owner = owner[order]
        self.edge = np.searchsorted(number[order], np.arange(len(self.names) + 1))
        self._lists_of_first()

    def _lists_of_first(self):
        """Lists of first tokens by place, in blocks with the most that any set has left."""
        self.first = [
            np.searchsorted(self.names, np.array(r["first"], np.int64).view(U)) for r in self.rows
        ]
        token = np.concatenate(self.first)
        sizes = [len(f) for f in self.first]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.concatenate(
            [r["alone"] + np.arange(k) for r, k in zip(self.rows, sizes, strict=True)]
        )
        order = np.lexsort((owner, place, token))
        token, self.post_owner = token[order], owner[order]
        self.post_edge = np.searchsorted(token, np.arange(len(self.names) + 1))
        self.left = (self.size[owner] - place)[order]
        # Later blocks of a list start at later places; what is left there bounds them all.
        self.most_left = self.left.copy()
        for a, b in zip(self.post_edge[:-1], self.post_edge[1:], strict=True):
            if b - a > 1:
                self.most_left[a:b] = np.maximum.accumulate(self.left[a:b][::-1])[::-1]

    def fresh(self, x: int) -> np.ndarray:
        """Overlaps of x with the sets that its first tokens lead to; others stay 0."""
        n, row = int(self.size[x]), self.rows[x]
        need = -(-THRESHOLD * n // 100)  # of any set that links with x
        found = []
        for i, token in enumerate(self.first[x]):
            here = row["alone"] + i
            for a in range(self.post_edge[token], self.post_edge[token + 1], SKIP_BLOCK):
                # At most i earlier tokens were shared, and what both have left from here.
                if min(n - here, int(self.most_left[a])) + i < need:
                    break
                b = min(a + SKIP_BLOCK, self.post_edge[token + 1])
                found.append(self.post_owner[a:b])
        mask = np.zeros(len(self.rows), bool)
        if found:
            mask[np.concatenate(found)] = True
        return np.where(mask, self._overlaps(self.sets[x]), 0)

    def _overlaps(self, tokens: np.ndarray) -> np.ndarray:
        size = (self.edge[1:] - self.edge[:-1])[tokens]
        at = np.repeat(self.edge[tokens] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.owner[at], minlength=len(self.rows))

    def links(self):
        """Links that join sets not yet connected, as pairs of classes."""
        parent = list(range(len(self.rows)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        like: dict[int, int] = {}  # a set already answered that links with this one
        answered: dict[int, np.ndarray] = {}
        for x in range(len(self.rows)):
            y = like.get(x)
            if y is not None:
                gone = np.setdiff1d(self.sets[y], self.sets[x], assume_unique=True)
                new = np.setdiff1d(self.sets[x], self.sets[y], assume_unique=True)
                overlap = answered[y] - self._overlaps(gone) + self._overlaps(new)
            else:
                # Every overlap that can make a link is whole; the rest is never used to derive.
                overlap = self.fresh(x)
            union = self.size[x] + self.size - overlap
            linked = np.flatnonzero(100 * overlap >= THRESHOLD * union)
            linked = linked[linked != x]
            ahead = [z for z in linked.tolist() if z > x and z not in like]
            if ahead:
                if y is None:
                    overlap = self._overlaps(self.sets[x])
                answered[x] = overlap
                for z in ahead:
                    like[z] = x
            for z in linked.tolist():
                a, b = root(x), root(z)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    yield self.rows[x]["class"], self.rows[z]["class"]


@lean


def _join_groups(batches):
    """Rows come ordered by family and group."""
    current, rows = None, []
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def joined():
        if len(rows) > 1:
            pairs = np.array(list(Group(rows).links()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            key = row["family"], row["part"]
            if key != current:
                yield from joined()
                current, rows = key, []
            rows.append(row)
    yield from joined()


def _links(groups: DataFrame, partitions: int) -> DataFrame:
    dealt = groups.repartition(partitions, "family", "part")
    return dealt.sortWithinPartitions("family", "part").mapInArrow(_join_groups, "u long, v long")


def _families(survivors: DataFrame) -> DataFrame:
    """class and family of the sets that share first tokens with another one."""
    postings = survivors.select("class", F.explode("first").alias("token"))
    least = postings.groupBy("token").agg(F.min("class").alias("v"), F.max("class").alias("w"))
    edges = (
        postings.join(least.where("v <> w"), "token")
        .select(F.col("class").alias("u"), "v")
        .where("u <> v")
        .distinct()
    )
    return components(edges).select(F.col("node").alias("class"), F.col("root").alias("family"))


def links(survivors: DataFrame) -> DataFrame:
    """u, v: links that connect all linked classes."""
    partitions = shuffle_partitions(survivors.sparkSession)
    families = written(_families(survivors), "families")
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    sets = survivors.join(families, "class").join(sizes, "family")
    parts = F.ceil(F.col("size") / GROUP)
    part = F.pmod(F.xxhash64("class"), parts)
    # About HUB sets of each larger family stand in all of its groups.
    is_hub = (F.col("size") > GROUP) & (
        F.pmod(F.xxhash64(F.lit("hub"), "class"), F.greatest(F.col("size"), F.lit(1))) < HUB
    )
    everywhere = F.sequence(F.lit(0).cast("long"), parts - 1)
    sets = written(
        sets.withColumn("home", part).withColumn("hub", is_hub).withColumn("parts", parts), "sets"
    )
    grouped = sets.withColumn(
        "part", F.explode(F.when(F.col("hub"), everywhere).otherwise(F.array("home")))
    )
    columns = ["family", "part", "class", "n", "tokens", "first", "alone"]
    near = written(_links(grouped.select(*columns), partitions), "near-links")

    large = sets.where(F.col("size") > GROUP)
    if large.isEmpty():
        return near
    roots = components(near).withColumnRenamed("node", "class")
    placed = large.join(roots, "class", "left").withColumn(
        "root", F.coalesce("root", F.col("class"))
    )
    main = placed.groupBy("family", "root").agg(F.count("*").alias("in_root"))
    main = main.groupBy("family").agg(F.max_by("root", F.struct("in_root", "root")).alias("main"))
    apart = written(
        placed.join(main, "family").where(F.col("root") != F.col("main")).select(
            "family", "class", "n", "tokens", "first", "alone", "parts"
        ),
        "apart",
    )
    if apart.isEmpty():
        return near
    # Sets outside the largest component, in blocks, meet every group of their family.
    blocks = apart.groupBy("family").agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    apart = apart.join(blocks, "family").withColumn(
        "block", F.pmod(F.xxhash64(F.lit("apart"), "class"), F.col("blocks"))
    )
    asked = apart.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = large.join(blocks, "family").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    ).withColumn("other", F.col("home"))
    name = (F.col("other") * F.col("blocks") + F.col("block")).alias("part")
    pairs = asked.select("family", name, *columns[2:]).unionByName(
        met.select("family", name, *columns[2:])
    )
    return near.unionByName(written(_links(pairs, partitions), "far-links"))


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, text_hash, root and component_id of each document.

    ``root`` names the component among classes; it is null without shingles.
    """
    partitions = shuffle_partitions(documents.sparkSession)
    buckets = 2 * partitions
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, class long, text_hash long"
    sets = written(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sets, schema), "classes")
    keys = by_range(texts.mapInArrow(_send_keys(buckets), EXCHANGE), partitions)
    counted = keys.mapInArrow(_count_keys, EXCHANGE)
    blocks = by_block(counted.unionByName(texts.mapInArrow(text_rows(1), EXCHANGE)), partitions)
    schema = "class long, n long, tokens binary, first array<long>, alone long"
    # Copies of a class come from several blocks.
    survivors = written(
        blocks.mapInArrow(_survivors, schema).dropDuplicates(["class"]), "survivors"
    )
    roots = components(links(survivors))
    least = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("doc"))
    named = written(
        least.join(roots, least["class"] == roots["node"], "left").select(
            "class", "doc", F.coalesce("root", F.col("class")).alias("root")
        ),
        "roots",
    )
    ids = named.groupBy("root").agg(F.min("doc").alias("component"))
    of_class = named.join(ids, "root").select("class", "component", "root")
    return sets.join(of_class, "class", "left").select(
        "doc_id",
        "n_shingles",
        "text_hash",
        "root",
        F.when(F.col("n_shingles") == 0, F.col("doc_id"))
        .otherwise(F.col("component"))
        .alias("component_id"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each component: the one with the least id, then the least text hash.

    A document without shingles is apart from all others and stays. Rows with the same id
    and text are one document.
    """
    rows = written(join(documents), "components")
    # Ids before null.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(order).alias("one"))
    kept = best.select("one.doc_id", "one.text_hash").unionByName(
        rows.where(F.col("root").isNull()).select("doc_id", "text_hash")
    )
    times = rows.groupBy("doc_id", "text_hash").agg((F.count("*") > 1).alias("again"))
    same = kept["doc_id"].eqNullSafe(times["doc_id"]) & (kept["text_hash"] == times["text_hash"])
    kept = written(
        kept.distinct().join(times, same).select(
            kept["doc_id"].alias("kept_id"), kept["text_hash"].alias("kept_hash"), "again"
        ),
        "kept",
    )
    every = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        packed(documents).alias("row"),
    )

    def those(again):
        some = kept.where(F.col("again") == again)
        match = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (
            F.col("text_hash") == F.col("kept_hash")
        )
        return every.join(some, match, "left_semi")

    # A text goes along once, in its row.
    several = those(True).withColumn("text", F.col("row.text"))
    one = those(False).unionByName(several.dropDuplicates(["doc_id", "text"]).drop("text"))
    return one.select(*unpacked(documents, "row"))


def op9_jaccard(spark, sf_dir):
    return join(table(spark, sf_dir, "documents")).drop("text_hash", "root")


OP9_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select doc_id, unnest(case
    when len(ws) >= 5 then list_distinct(list_transform(range(1, len(ws) - 3),
      lambda i: array_to_string(ws[i:i + 4], ' ')))
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as c
  from s x join s y on x.shingle = y.shingle and x.doc_id < y.doc_id group by all),
l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r(doc_id, root) as (
  select doc_id, doc_id from documents
  union select e.b, r.root from r join e on r.doc_id = e.a)
select doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(root) as component_id
from r left join n using (doc_id) group by doc_id
"""
