"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source; targets share ``epochs`` (150%) of all words by weight, where none exceeds ``most`` (2) times its
source's words and what is above is shared out anew among the others. A source's repetition rate is its target over its words;
each document is taken floor(rate) times, and once more if a draw from [0, 1), a hash of its doc_id and the seed, is below the
fraction. Reruns draw alike.

The targets need no loop: with sources in order of cap over weight, those that stop at their cap come first, and each other
gets (total - capped before) * weight / (weights not capped). All sums are whole numbers, so the result is exact.

The per-source table has one row per source. It is counted before use: up to ``FEW_SOURCES`` it is broadcast, so documents
are not shuffled whatever the skew; beyond that Spark joins by source, and splits a hot source.

Edge cases. A null text has no words. Null is a source of its own, the last in order. A source without words has target 0, and
its documents are taken 0 times. Repeated doc_ids draw alike; null doc_ids draw as one id. An empty table gives an empty
result. Other columns pass through; where the input has columns with the names added here, those are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import WORD, Work, pick, uniform

WEIGHTS = (3, 1, 2)
EPOCHS = (3, 2)
MOST = 2
SEED = "mix"
#: Sources up to which their table (some 60 bytes a source) is broadcast.
FEW_SOURCES = 10_000

ADDED = ("size", "source_size", "target", "copies", "taken")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, epochs=EPOCHS, most: int = MOST) -> DataFrame:
    """source, source_size, target of every source of ``sizes`` (source, source_size).

    ``weights`` repeat over the sources in code-point order, null last; ``epochs`` is a fraction (numerator, denominator).
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.alias("w")).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (
        ranked.withColumn("before", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weights", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(everything))
    )
    # the share of this source if all before it, and none from it on, stop at their caps: share / (den * weights)
    num, den = epochs
    share = F.col("w") * (F.lit(num) * F.col("all") - F.lit(den) * F.col("before"))
    level = left.withColumn("share", share).withColumn("open", F.col("share") <= F.lit(den) * F.col("weights") * F.col("cap"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "source", "before", "weights"))).over(everything)
    at = level.withColumn("at", first)
    capped = ~F.col("open") | F.col("at").isNull()
    value = F.col("w") * (F.lit(num) * F.col("all") - F.lit(den) * F.col("at.before")) / (F.lit(den) * F.col("at.weights"))
    return at.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(value).alias("target"))


def plan(docs: DataFrame, weights=WEIGHTS, epochs=EPOCHS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (words) of each row."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    sized = docs.withColumn("size", words(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = Work(docs.sparkSession, "mix").store(targets(sizes, weights, epochs, most))
    side = table.select(F.col("source").alias("__source"), "source_size", "target")
    if table.count() <= FEW_SOURCES:
        side = F.broadcast(side)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + (uniform(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    joined = sized.join(side, sized.source.eqNullSafe(side["__source"])).drop("__source")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` as the mix holds them: each row as many times as it is taken, with the columns of ``docs``."""
    chosen = plan(docs, **parameters).filter("copies > 0")
    # expansion stays in the task that read the row; the copies of a row are few (at most ``most``)
    return chosen.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*pick(chosen, *docs.columns))
