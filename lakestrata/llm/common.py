"""What the operators of this subpackage share: written intermediate tables, hash draws, span digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.settings import remove_folder, work_folder

#: Words of every contract: runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch; texts may be long, so batches stay small.
BATCH_ROWS = 256


class Work:
    """A folder of written tables in the cluster's shared folder: lineage is cut there, and any executor can read it again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.dir, self.n = spark, work_folder(spark, name), 0

    def store(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back; the path is in ``last``."""
        self.n += 1
        self.last = f"{self.dir}/{self.n}"
        df.write.option("compression", "zstd").parquet(self.last)
        return self.spark.read.schema(df.schema).parquet(self.last)

    def drop(self, path: str) -> None:
        """Remove a table that no frame in use reads any more."""
        remove_folder(self.spark, path)


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch of texts holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def uniform(key: Column, seed: str) -> Column:
    """A draw from [0, 1) that depends on ``key`` and ``seed`` alone: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def pick(df: DataFrame, *names: str) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [df[f"`{n.replace('`', '``')}`"] for n in names]
