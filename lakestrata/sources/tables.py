"""Named tables whose content can be replaced while it is being read.

Spark refuses to overwrite a Parquet table that the same plan reads, and a
drop-and-rename leaves a moment without a table.  So every load writes a
fresh table ``<name>__v<n>`` and then repoints the view ``<name>`` at it: one
catalog operation decides, a failed load leaves the old content in place, and
the version before stays readable for queries already running.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.settings import Layers

_VERSION, COPIES = "lakestrata.version", "lakestrata.copies"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def version(spark: SparkSession, name: str) -> int:
    """Published version, 0 where nothing has been published."""
    return int(properties(spark, name).get(_VERSION, 0)) if exists(spark, name) else 0


def physical(spark: SparkSession, name: str) -> str:
    v = version(spark, name)
    if v == 0:
        raise ValueError(f"{name} has not been published")
    return f"{name}__v{v}"


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Full names of the stored versions, oldest first."""
    *db, short = name.split(".")
    if db and not spark.catalog.databaseExists(db[0]):
        return []
    where = f" IN {db[0]}" if db else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{short.lower()}__v*'").collect()
    numbers = sorted(int(r["tableName"][len(short) + 3 :]) for r in found if r["tableName"][len(short) + 3 :].isdigit())
    return [f"{name}__v{n}" for n in numbers]


def _publish(spark: SparkSession, name: str, v: int, keep: int, columns: list[str] | None = None, copies: dict[str, str] | None = None) -> None:
    """Point the view at version ``v``; with ``copies``, it names again what the version holds once."""
    listed = ", ".join(f"`{copies[c]}` AS `{c}`" if c in copies else f"`{c}`" for c in columns) if copies else "*"
    held = f", '{COPIES}' = '{','.join(copies)}'" if copies else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_VERSION}' = '{v}'{held}) AS SELECT {listed} FROM {name}__v{v}")
    for old in _versions(spark, name):
        if int(old.rpartition("__v")[2]) < v - keep:
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def partition_columns(spark: SparkSession, name: str) -> tuple[str, ...]:
    """Columns the published version is partitioned by."""
    if version(spark, name) == 0:
        return ()
    return tuple(c.name for c in spark.catalog.listColumns(physical(spark, name)) if c.isPartition)


def overwrite(df: DataFrame, name: str, partition_by: tuple[str, ...] | None = None, keep: int = 1,
              buckets: tuple[int, str] | None = None, copies: dict[str, str] | None = None) -> None:
    """Replace the whole content; ``df`` may read ``name`` itself.  One writer at a time.

    ``buckets`` (their number, the column) stores rows hashed and sorted for
    joins on that column.  ``copies`` names columns of ``df`` that repeat
    another one in every row: that one alone is stored, and the view shows it
    under all its names.

    Partitioning carries over from the version before unless stated.  Rows of
    a partitioned table are rebalanced on its partition columns first: small
    partitions come out as few files, and AQE splits a partition that holds a
    large share of the rows over several tasks.
    """
    spark = df.sparkSession
    v = version(spark, name) + 1
    if partition_by is None:
        have = {c.lower() for c in df.columns}
        partition_by = tuple(c for c in partition_columns(spark, name) if c.lower() in have)
    spark.sql(f"DROP TABLE IF EXISTS {name}__v{v}")  # left by a load that failed
    columns, df = df.columns, df.drop(*copies or ())
    if partition_by:
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by)
    else:
        writer = df.write
    if buckets:
        n, column = buckets
        dealt = df.repartition(n, column)  # nothing to do where the rows come from such buckets
        writer = (dealt.write.partitionBy(*partition_by) if partition_by else dealt.write).bucketBy(n, column).sortBy(column)
    writer.format("parquet").option("compression", "zstd").saveAsTable(f"{name}__v{v}")
    _publish(spark, name, v, keep, columns, copies)


materialize_table = overwrite


def stage(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate result under ``<name>__staged`` and read it back.

    What follows starts from files: it is computed once, survives the loss of
    executors, and has a size that join planning can use.
    """
    overwrite(df, name + "__staged")
    return df.sparkSession.table(name + "__staged")


def ctas(df: DataFrame, name: str) -> None:
    """Create (or replace) a table from a query."""
    overwrite(df, name)


def append(df: DataFrame, name: str) -> None:
    """Add rows, matched to the table by column name; the table is created when absent.

    Other columns than the table's are an error, not dropped or made up.
    Columns that were stored once get their own place first: new rows may
    differ in them.
    """
    spark = df.sparkSession
    if version(spark, name) == 0:
        overwrite(df, name)
        return
    if COPIES in properties(spark, name):
        overwrite(spark.table(name), name)
    target = physical(spark, name)
    columns = spark.table(target).columns
    odd = {c.lower() for c in columns} ^ {c.lower() for c in df.columns}
    if odd or len(df.columns) != len(columns):
        raise ValueError(f"{name} has columns {columns}, the rows have {df.columns}; they differ in {sorted(odd)}")
    df.select(*columns).write.insertInto(target)


def replace_rows(df: DataFrame, name: str) -> None:
    """Empty the table and load ``df``: same columns, new rows."""
    spark = df.sparkSession
    wanted = spark.table(name).schema
    if {c.lower() for c in df.columns} != {f.name.lower() for f in wanted}:
        raise ValueError(f"{name} keeps its columns {wanted.fieldNames()}; got {df.columns}")
    overwrite(df.select(*[F.col(f.name).cast(f.dataType) for f in wanted]), name)


def truncate(spark: SparkSession, name: str) -> None:
    overwrite(spark.table(name).filter(F.lit(False)), name)


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where ``condition`` holds; NULL conditions leave a row alone, types stay."""
    by_name = {c.lower(): v for c, v in changes.items()}
    unknown = set(by_name) - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(*[
        F.when(condition, by_name[f.name.lower()]).otherwise(F.col(f.name)).cast(f.dataType)
        .alias(f.name, metadata=f.metadata) if f.name.lower() in by_name else F.col(f.name)
        for f in df.schema
    ])


def update_table(spark: SparkSession, name: str, condition: Column, changes: dict[str, Column]) -> None:
    overwrite(update_where(spark.table(name), condition, changes), name)


def create_like(spark: SparkSession, src: str, name: str) -> None:
    """Empty table of the same shape."""
    if COPIES in properties(spark, src):
        create_table(spark, name, spark.table(src).schema)
        return
    v = version(spark, name) + 1
    spark.sql(f"DROP TABLE IF EXISTS {name}__v{v}")
    spark.sql(f"CREATE TABLE {name}__v{v} LIKE {physical(spark, src)}")
    _publish(spark, name, v, 1)


def clone(spark: SparkSession, src: str, name: str) -> None:
    """Independent full copy; Parquet tables share no files between names."""
    overwrite(spark.table(src), name, partition_columns(spark, src))


def create_view(spark: SparkSession, query: DataFrame | str, name: str) -> None:
    """Persistent view from SQL text, session view from a DataFrame."""
    if isinstance(query, str):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    else:
        query.createOrReplaceTempView(name)


materialize_view = create_view


def values(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Inline rows with a stated schema."""
    return spark.createDataFrame(rows, schema)


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Empty table with the given columns, replacing what was there."""
    overwrite(spark.createDataFrame([], schema), name)


def drop(spark: SparkSession, *names: str) -> None:
    """Drop published tables or plain views; absent names are no error."""
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        for old in _versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def create_layers(spark: SparkSession, layers: Layers, schemas: list[str], location: str | None = None) -> list[str]:
    """One database per layer and source schema of an environment."""
    made = []
    for layer in ("LANDING", "BRONZE", "SILVER", "GOLD", "PLATINUM"):
        for schema in schemas:
            db = layers.schema(layer, schema)
            at = f" LOCATION '{location}/{db}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{at}")
            made.append(db)
    return made


def drop_layers(spark: SparkSession, layers: Layers, schemas: list[str], which: list[str]) -> None:
    for layer in which:
        for schema in schemas:
            spark.sql(f"DROP DATABASE IF EXISTS {layers.schema(layer, schema)} CASCADE")
