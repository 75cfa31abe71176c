"""Checks whose results are kept per key slice, so that a load re-checks only the slices it wrote."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.sliced_table import SlicedTable

Failing = Callable[[set[int] | None], DataFrame]


@dataclass(frozen=True)
class SliceCheck:
    """``failing`` returns the failing rows of some slices (all for None), with the slice of each as ``of_slice``.

    It must judge a slice by the rows of that slice: rules on single rows,
    keys that decide the slice, or a second table in slices of the same key.
    """

    name: str
    failing: Failing


def on_slices(table: SlicedTable, check: Callable[[DataFrame], DataFrame]) -> Failing:
    """A check of single rows or of the key: its failing rows keep the key, which tells their slice."""
    return lambda only: check(table.read(only)).withColumn("of_slice", table.slice_of())


def aligned(child: SlicedTable, parent: SlicedTable, check: Callable[[DataFrame, DataFrame], DataFrame]) -> Failing:
    """A check of one table against another whose rows with the same key are in the same slice."""
    if (child.slices, child.buckets is None) != (parent.slices, parent.buckets is None):
        raise ValueError(f"{child.name} and {parent.name} are not in the same slices")
    return lambda only: check(child.read(only), parent.read(only)).withColumn("of_slice", child.slice_of())


class CheckState:
    """Failing rows per check and slice, in a small table beside the one checked."""

    SCHEMA = "check_name string, of_slice int, failures bigint"

    def __init__(self, spark: SparkSession, name: str, checks: Iterable[SliceCheck]):
        self.checks = list(checks)
        self.table = SlicedTable(spark, name, ["check_name"], 1)
        self.spark = spark

    def run(self, touched: set[int] | None = None) -> DataFrame:
        """Check the slices touched since the last run (all on the first, or for None) and return the verdicts of the whole table."""
        held = self.table.read()
        only = None if held is None else touched
        if only is None or only:
            # at most one row per check and slice
            parts = [c.failing(only).groupBy(F.col("of_slice").cast("int").alias("of_slice")).count().select(F.lit(c.name).alias("check_name"), "of_slice", F.col("count").alias("failures"))
                     for c in self.checks]
            fresh = parts[0]
            for p in parts[1:]:
                fresh = fresh.unionByName(p)
            kept = None if only is None else held.filter(~F.col("of_slice").isin(sorted(only)))
            fresh = fresh if kept is None else fresh.unionByName(kept)
            self.table.overwrite(self.spark.createDataFrame(fresh.collect(), self.SCHEMA))
        return verdicts(self.table.read(), [c.name for c in self.checks])


def verdicts(state: DataFrame, names: list[str]) -> DataFrame:
    """check_name, failures and passed of every check, those without failures included."""
    every = state.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("check_name"), F.lit(0).cast("bigint").alias("failures"))
    total = every.unionByName(state.select("check_name", "failures")).groupBy("check_name").agg(F.sum("failures").alias("failures"))
    return total.withColumn("passed", F.col("failures") == 0)
