"""Connected components of links between numbers, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busgrid.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the neighbours of each node to its least one.

    A large step looks at all neighbours and hangs the larger ones, a small step looks at
    the smaller ones and hangs them and the node itself.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u").where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m"))
    out = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node that has a link; the root is the least node reachable.

    The steps shrink every component to a star; each round is written to the shared folder.
    """
    edges = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "links")
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = tuple(edges.agg(F.count("*"), checksum).first())
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = now
