"""Connected components of a links table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.scale import stable, stored


def components(links: DataFrame) -> DataFrame:
    """``node, component``: every node of ``links (a, b)`` with the smallest node it reaches.

    Alternating star contraction: each round links every node's larger
    neighbours to the smallest one, then every node and its smaller neighbours to
    the smallest one. Rounds grow with the logarithm of the longest path. Each
    round's links are a written table, so the planner knows their size anew and
    does not multiply estimates from round to round; the driver sees a count and
    a sum per round.
    A hub's links are two columns of longs and aggregate before the shuffle; the
    joins are plain shuffles, which Spark splits where a hub is hot. Self-links
    and repeated links do no harm; null ends are left out.
    """
    edges = stored(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stable(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))  # few smaller neighbours are left to any node
        pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(pair("u", "m"), pair("v", "m"))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
