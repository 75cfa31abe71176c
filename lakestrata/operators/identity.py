"""Running identity numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.settings import work_folder

# monotonically_increasing_id() puts the partition above bit 33 and the row position below it
_POSITION_BITS = 33


def assign_identity(df: DataFrame, order: list[str], name: str = "id", start: int = 1,
                    partitions: int | None = None) -> DataFrame:
    """Gapless ``start, start+1, ...`` in the given order, without a single-task sort.

    One range shuffle orders the rows across partitions.  Each row's partition
    and position are then fixed in a written table in the shared folder: range
    bounds come from a sample, so they must not be computed twice.  Only one
    row count per partition reaches the driver.  The input position breaks
    ties, so a value shared by very many rows still spreads over partitions.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie, slot = "__tie", "__slot"
    where = work_folder(spark, "identity")
    (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(n, *order, tie)
        .sortWithinPartitions(*order, tie)
        .withColumn(slot, F.monotonically_increasing_id())
        .drop(tie)
        .write.parquet(where)
    )
    placed = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(slot, T.LongType())])).parquet(where)
    part = F.shiftright(F.col(slot), _POSITION_BITS)
    position = F.col(slot).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = placed.groupBy(part.alias("p")).count().orderBy("p").collect()
    offsets, seen = [], start
    for row in counts:
        offsets.append((row["p"], seen))
        seen += row["count"]
    # one row per partition of the shuffle above, so its size has a bound and it may be broadcast
    bases = F.broadcast(spark.createDataFrame(offsets, "__p bigint, __base bigint"))
    numbered = placed.withColumn("__p", part).join(bases, "__p")
    return numbered.select((F.col("__base") + position).alias(name), *df.columns)
