"""Connected components of a frame of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """``node`` and ``root`` (the least node that it can reach) of every node in the links (a, b).

    Large star: each node hands its larger neighbours to its least neighbour. Small star: each node hands its smaller
    neighbours to the least of them. Rounds are written out, so a lost executor repeats one round at most; the number of
    rounds grows with the logarithm of the longest chain. A node's neighbours are never gathered: the least neighbour is an
    aggregate, and rejoining it is an equi-join whose hot keys Spark splits.
    """
    pairs = work.store(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    path = work.last
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        rejoined = large.join(small_least, "u")
        small = (
            rejoined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_least.select("u", F.col("m").alias("v"))).distinct()
        )
        after = work.store(small)
        new = work.last
        # done once every node has one root and no root has a root of its own
        many = after.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
        chained = 0 if many else after.join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        work.drop(path)
        pairs, path = after, new
        if not many and not chained:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
