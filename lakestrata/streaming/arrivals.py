"""Landing and history for files that keep arriving.

Each call takes what is new since the last one and stops (``availableNow``),
so a scheduler can run it like any batch step; which files are done is kept
in the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.audit import SOURCE_SYSTEM, with_audit
from lakestrata.settings import RunContext
from lakestrata.sources.files import csv_options, text_schema
from lakestrata.sources.history_table import HistoryTable


def arriving_csv(spark: SparkSession, folder: str, columns: list[str], config: dict) -> DataFrame:
    reader = spark.readStream.schema(text_schema(columns)).options(**csv_options(config))
    return reader.option("enforceSchema", False).csv(folder)


def arriving_parquet(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(folder)


def land_arrivals(stream: DataFrame, path: str, checkpoint: str, ctx: RunContext, source_system: str) -> None:
    """Append new rows with audit columns; the file sink commits each batch exactly once."""
    rows = with_audit(stream.select(F.lit(source_system).alias(SOURCE_SYSTEM), *stream.columns), ctx)
    run = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start(path).awaitTermination()


def history_of_arrivals(stream: DataFrame, table: HistoryTable, check_cols: list[str], checkpoint: str, ctx: RunContext,
                        prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """Load each batch into a history table.

    A batch replayed after a failure holds the same rows, so the check
    strategy finds nothing to change the second time.  One batch must not
    hold a key twice; ``prepare`` is the place to settle that
    (``operators.guards.latest_per_key``).  A batch is a part of the source,
    so keys that it lacks are not deleted: tables that close or mark absent
    keys are refused.  Batches of one run have times a microsecond apart.
    """
    if table.hard_deletes != "ignore":
        raise ValueError(f"arrivals are partial deliveries; hard_deletes={table.hard_deletes!r} would delete what they lack")

    def load(batch: DataFrame, number: int) -> None:
        at = None if ctx.ts is None else ctx.ts + timedelta(microseconds=number)
        table.load_by_check(prepare(batch), check_cols, replace(ctx, ts=at))

    run = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start().awaitTermination()
