"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions.

Sizes are words. A source's target is its weight's share of all words, at most REPEATS
times its own. A document is taken ``floor(target / source size)`` times; which documents
are taken once more is settled by a 48-bit hash of their id: words are summed by source
and hash bucket, the bucket in which the budget ends is found, and only that bucket is
counted again in finer buckets, four times 12 bits. The last threshold then is a plain
filter; nothing is sorted. Growing budgets give nested mixes, since thresholds only rise.

Null text has size 0; a null source is a source of its own, the last one; documents with
the same id share their fate; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busgrid.llm.common import packed, table, unpacked, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
LEVELS, BITS = 4, 12
SALTS = 64


def hash48(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, LEVELS * BITS // 4), 16, 10).cast("long")


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, key, size and hash of each document, written once.

    ``key`` is the source as text that is never null.
    """
    source = F.col("source").cast("string")
    return written(
        documents.select(
            "doc_id",
            source.alias("source"),
            F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            hash48(F.col("doc_id")).alias("h"),
        ),
        "mix-sizes",
    )


def targets(sized: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: its size and target, whole copies and the budget left after them.

    Sharing the excess again and again ends at one level L: every target is the smaller
    of L * weight and repeats * size. With sources ordered by repeats * size / weight the
    stopped ones come first, so L follows from running sums over sources.
    """
    by_source = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    # Windows over one row per source, not over documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    cap = (F.col("source_size") * repeats).cast("double")
    weighed = by_source.withColumn("weight", choice).withColumn("cap", cap)
    everything = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0.0)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero)
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero))
    # The level of the first source, in this order, that stays below its cap holds; levels
    # worked out further on are lower.
    open_level = F.max(
        F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    ).over(everything)
    target = F.least(F.col("cap"), F.coalesce(open_level * F.col("weight"), F.col("cap")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        weighed.withColumn("level", level)
        .withColumn("target", target)
        .withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long"))
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("key", "source_size", "target", "whole", "budget")
    )


def _with_sources(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """Adds the columns of a row per source to its documents; a hot source goes to many tasks."""
    salt = F.col("h").bitwiseAND(F.lit(SALTS - 1)).cast("int")
    copies = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return sized.withColumn("salt", salt).join(copies, ["key", "salt"]).drop("salt")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each key the hash ``below`` which documents are within ``budget`` words.

    ``budgets`` has key, budget. Each level reads the documents of one bucket of each
    source: the one in which the budget ends.
    """
    state = budgets.select(
        "key", "budget", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("base")
    )
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * BITS
        bucket = F.shiftright("h", shift)
        inside = (
            _with_sources(sized, state.select("key", "low"))
            .where(F.shiftright("h", shift + BITS) == F.shiftright("low", shift + BITS))
            .groupBy("key", bucket.alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        running = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))
        counted = inside.withColumn("running", running).join(state, "key")
        fits = F.col("base") + F.col("running") <= F.col("budget")
        found = counted.groupBy("key").agg(
            F.min(F.when(~fits, F.col("bucket"))).alias("open"),
            F.max("bucket").alias("last"),
            F.max(F.when(fits, F.col("running"))).alias("inside"),
        )
        low = F.coalesce("open", F.col("last") + 1) * F.lit(1 << shift)
        state = written(
            state.join(found, "key", "left").select(
                "key",
                "budget",
                F.coalesce(low, F.col("low")).alias("low"),
                (F.col("base") + F.coalesce("inside", F.lit(0))).alias("base"),
            ),
            "mix-level",
        )
    # What is left at ``low`` shares one hash: taken if that comes nearer to the budget.
    ties = (
        _with_sources(sized, state.select("key", "low"))
        .where(F.col("h") == F.col("low"))
        .groupBy("key")
        .agg(F.sum("size").alias("tie"))
    )
    nearer = 2 * F.col("base") + F.col("tie") <= 2 * F.col("budget")
    return state.join(ties, "key", "left").select(
        "key", F.when(nearer, F.col("low") + 1).otherwise(F.col("low")).alias("below")
    )


def plan(sized: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """How each source is taken: ``whole`` times all, once more below a hash."""
    wanted = written(targets(sized, weights, repeats), "mix-targets")
    return wanted.join(thresholds(sized, wanted), "key").withColumn("repeats", F.lit(repeats))


def _copies() -> Column:
    once_more = (F.col("whole") < F.col("repeats")) & (F.col("h") < F.col("below"))
    return F.col("whole") + F.when(once_more, 1).otherwise(0)


def mix(documents: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of each document."""
    sized = sizes(documents)
    return _with_sources(sized, plan(sized, weights, repeats)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        _copies().alias("copies"),
        (_copies() * F.col("size")).alias("taken"),
    )


def mixed(documents: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The documents as often as the mix takes them."""
    chosen = written(plan(sizes(documents), weights, repeats), "mix-plan")
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    keyed = documents.select(packed(documents).alias("row"), source.alias("key"), hash48(F.col("doc_id")).alias("h"))
    taken = _with_sources(keyed, chosen).where(_copies() > 0)
    each = F.explode(F.sequence(F.lit(1).cast("long"), _copies()))
    copies = taken.select("row", each.alias("_n"))
    return copies.select(*unpacked(documents, "row"))


def op7_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("copies")


OP7_SQL = r"""
with d as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 12))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size, 3.0::double * sum(size) as cap,
    [5.0::double, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from d group by source),
v as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over w, 0))::double
      / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
  from s window w as (order by cap / weight, coalesce('=' || source, '')
                      rows between unbounded preceding and 1 preceding)),
t as (
  select source, source_size, least(cap, weight * (
      select max(level) from v where level * weight <= cap)) as target
  from v),
b as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole
  from t),
g as (
  select source, h, sum(size)::bigint as tie,
    sum(sum(size)) over (partition by source order by h)::bigint as upto
  from d group by source, h),
k as (
  select g.source, h, b.whole < 3 and (upto <= target - whole * source_size
      or (lag(upto, 1, 0) over (partition by g.source order by h) <= target - whole * source_size
          and 2 * (upto - tie) + tie <= 2 * (target - whole * source_size))) as more
  from g join b on g.source is not distinct from b.source)
select doc_id, size::bigint as size, source_size, target,
  ((whole + more::int) * size)::bigint as taken
from d join b on d.source is not distinct from b.source
join k on d.source is not distinct from k.source and d.h = k.h
"""
