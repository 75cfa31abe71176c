"""Where queries and their SQL twins are kept."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import RunContext, configure
from lakestrata.settings import scratch_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a ``(tables) -> DataFrame`` function under its name, with its SQL."""

    def wrap(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap


class Tables:
    """The driver tables of one scale as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def work_database(self) -> str:
        """Catalog database for written tables, in the cluster's shared folder."""
        run = self.spark.sparkContext.applicationId.replace("-", "_").lower()
        db = f"lakestrata_work_{run}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_root(self.spark)}/{db}'")
        return db

    def work_path(self, name: str) -> str:
        return f"{scratch_root(self.spark)}/lakestrata_files_{self.spark.sparkContext.applicationId}/{name}"


def run_at(month: int, run: str = "run") -> RunContext:
    return RunContext(datetime(2025, month, 10, 8, 0), f"{run}-{month}", "spark", "workload")


#: The audit columns in a query's result, and in its SQL.
AUDITED = ("SYSRUNID", "SYSPROCESSINGTOOL", "SYSDATAPROCESSORNAME")


def audited_sql(month: int, run: str = "run") -> str:
    return f"'2025-{month:02d}-10 08:00:00' AS SYSLOADDATE, '{run}-{month}' AS SYSRUNID, 'spark' AS SYSPROCESSINGTOOL, 'workload' AS SYSDATAPROCESSORNAME"


def stamp(col: str):
    """Timestamp as text, the same in both engines."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def day(col: str):
    return F.date_format(col, "yyyy-MM-dd").alias(col)
