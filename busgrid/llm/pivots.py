"""Exact top-k by inner product with a pivot table.

Distances of every vector to many pivots are precomputed and written with it. For a query q
and a vector x the largest |d(q, p) - d(x, p)| over pivots p bounds their distance from below
and so the inner product (|q|² + |x|² - d²) / 2 from above. Vectors are evaluated in the order
of their bounds until the bound falls below the k-th best score; ties count, so results are
exact.

One job searches, whatever the number of queries: queries are written in blocks of about
``QUERIES``, with scores to beat from a sample of vectors. A task holds at most about ``VECTORS``
vectors and takes the blocks one after the other from the shared folder; of each query it
sends at most k rows, and few if others are better.

Vectors that are null or hold null or non-finite components, ids that are null, and
vectors of another length than the most frequent one (the shorter, if equal) take no part.
Rows that share an id are rows of their own, as candidates and as queries: a query's own row
alone is left out, and each query row has ranks of its own. Ties go to the smaller id. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busgrid.llm.common import hash_sample, shuffle_partitions, table, written
from busgrid.sources.archives import opened

PIVOTS, QUERIES, SAMPLE, VECTORS = 32, 2048, 2000, 1 << 16
TABLE = "row long, vec_id long, v array<double>, to_pivots array<double>"


def grid(vectors: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * vectors.astype(np.float64))


def usable(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, v: the sound vectors, with a number for each row, written once."""
    sound = embeddings.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall(
            "embedding",
            lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
        )
    ).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").alias("v"),
    )
    rows = written(sound, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else -1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each is the one farthest from those before it."""
    chosen = [0]
    far = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_rows(queries, query_rows, query_pivots, to_beat, x, to_pivots, ids, rows, k):
    """The k best of the vectors x for each query: places in x and scores.

    Fewer come where the sample has better ones.
    """
    squares = (x**2).sum(1)
    for i, q in enumerate(queries):
        scores, found, beat = np.zeros(0), np.zeros(0, np.int64), to_beat[i]
        gap = np.abs(to_pivots - query_pivots[i]).max(1)
        whole = q @ q + squares
        bound = (whole - gap**2) / 2 + 1e-9 * whole + 1e-6  # above the rounding of roots
        open_ = np.flatnonzero((bound >= beat) & (rows != query_rows[i]))
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        at, step = 0, 64
        while at < len(open_) and bound[open_[at]] >= beat:
            part = open_[at : at + step]
            value = x[part] @ q
            keep = value >= beat
            scores, found = np.append(scores, value[keep]), np.append(found, part[keep])
            top = _best(scores, ids[found], k)
            scores, found = scores[top], found[top]
            if len(scores) == k:
                beat = max(beat, scores[-1])
            at, step = at + step, min(step * 2, 4096)
        yield found, scores


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """row, vec_id, v on the grid and its distances to all pivots, written once."""
    dim = pivots.shape[1]

    def measure(batches):
        for batch in batches:
            x = grid(_matrix(batch.column("v"), dim))
            far = distances(x, pivots)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel())
                )
                for m in (x, far)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), *lists],
                ["row", "vec_id", "v", "to_pivots"],
            )

    return written(vectors.select("row", "vec_id", "v").mapInArrow(measure, TABLE), "pivot-table")


def _query_blocks(queries: DataFrame, seen: np.ndarray, seen_rows: np.ndarray, k: int, blocks: int):
    """Queries with the score of the k-th best of the sample, a file for each block."""
    dim = seen.shape[1]

    def to_beat(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            own = batch.column("row").to_numpy()[:, None] == seen_rows
            known = np.where(own, -np.inf, x @ seen.T)
            best = np.sort(known, 1)[:, -k] if known.shape[1] > k else np.full(len(x), -np.inf)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best)], [*batch.schema.names, "to_beat"]
            )

    rows = queries.repartition(blocks, "row").mapInArrow(to_beat, f"{TABLE}, to_beat double")
    return written(rows, "query-blocks").inputFiles()


def top_k(
    vectors: DataFrame, is_query: Column, k: int, block: int = QUERIES, held: int = VECTORS
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row of ``is_query``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    sample = hash_sample(vectors, "row", SAMPLE).select("row", "v").toPandas()
    if not len(sample):
        sample = vectors.limit(SAMPLE).select("row", "v").toPandas()
    asked = vectors.where(is_query).count()
    if not asked or not len(sample):
        return spark.createDataFrame([], schema)
    sample = sample.sort_values("row")
    seen, seen_rows = grid(np.stack(sample["v"].to_numpy())), sample["row"].to_numpy()
    dim, pivots = seen.shape[1], choose_pivots(seen)
    every = pivot_table(vectors, pivots)
    files = _query_blocks(every.where(is_query), seen, seen_rows, k, math.ceil(asked / block))

    def search(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        mine = pa.Table.from_batches(parts)
        x, far = _matrix(mine["v"], dim), _matrix(mine["to_pivots"], len(pivots))
        ids, rows = mine["vec_id"].to_numpy(), mine["row"].to_numpy()
        for file in files:
            with opened(file) as stream:
                asking = pq.read_table(stream)
            if not asking.num_rows:
                continue
            queries = _matrix(asking["v"], dim)
            asking_rows, asking_ids = asking["row"].to_numpy(), asking["vec_id"].to_numpy()
            beat = asking["to_beat"].to_numpy()
            to_pivots = _matrix(asking["to_pivots"], len(pivots))
            best = list(
                search_rows(queries, asking_rows, to_pivots, beat, x, far, ids, rows, k)
            )
            sizes = [len(f) for f, _ in best]
            at = np.concatenate([f for f, _ in best])
            yield pa.RecordBatch.from_pydict(
                {
                    "query_row": pa.array(np.repeat(asking_rows, sizes)),
                    "query_id": pa.array(np.repeat(asking_ids, sizes)),
                    "row": pa.array(rows[at]),
                    "vec_id": pa.array(ids[at]),
                    "score": pa.array(np.concatenate([s for _, s in best]).astype(np.int64)),
                }
            )

    tasks = max(math.ceil(every.count() / held), shuffle_partitions(spark))
    found = every.repartition(tasks, "row").mapInArrow(
        search, "query_row long, query_id long, row long, vec_id long, score long"
    )
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_top_k(spark, sf_dir):
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


OP4_SQL = """
with e as (
  select row_number() over () as row, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.row as query_row, q.vec_id as query_id, c.vec_id,
    list_inner_product(q.v, c.v)::bigint as score
  from e q join e c on q.vec_id % 50 = 0 and q.row <> c.row),
r as (
  select *, row_number() over (partition by query_row order by score desc, vec_id)::int as rank
  from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
