"""Identity numbers that keys keep from load to load.

A lookup table holds each key's number, partitioned by load; a view shows the
loads that are complete and carries the highest number given.  A delivery looks
its keys up; only keys never seen are numbered, on from the highest.  A load
that died half-way is dropped by the next.  One load at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.identity import assign_identity
from lakestrata.sources.tables import exists, properties

_LOAD, _HIGH = "lakestrata.load", "lakestrata.high"
_SEQ = "load_seq"


class IdentityTable:
    """Numbers from ``start`` without gaps; ``buckets`` stores the lookup hashed by key, so that it is not shuffled for a delivery."""

    def __init__(self, spark: SparkSession, name: str, key: list[str], column: str = "id", start: int = 1, buckets: int | None = None):
        self.spark, self.name, self.key, self.column, self.start, self.buckets = spark, name, key, column, start, buckets
        self.parts = name + "__parts"

    def _state(self) -> tuple[int, int]:
        """Load number and highest number given."""
        p = properties(self.spark, self.name) if exists(self.spark, self.name) else {}
        return int(p.get(_LOAD, 0)), int(p.get(_HIGH, self.start - 1))

    def lookup(self) -> DataFrame | None:
        """Key and number of every key seen."""
        n, _ = self._state()
        return self.spark.table(self.parts).filter(F.col(_SEQ) <= n).drop(_SEQ) if n else None

    def take(self, delivery: DataFrame, order: list[str] | None = None) -> int:
        """Number the keys of a delivery that are new, in the order of ``order`` (the key unless named); returns how many there were.

        A key with several rows is placed by its least; keys with a NULL part get no number.
        """
        n, high = self._state()
        order = order or self.key
        least = [F.min(c).alias(f"__o{i}") for i, c in enumerate(order)]
        keys = delivery.dropna(subset=self.key).groupBy(*self.key).agg(*least)
        if n:
            keys = keys.join(self.lookup().select(*self.key), self.key, "left_anti")
        numbered = assign_identity(keys, [*[f"__o{i}" for i in range(len(order))], *self.key], self.column, high + 1)
        rows = numbered.select(*self.key, self.column, F.lit(n + 1).alias(_SEQ))
        if not exists(self.spark, self.parts):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            listed = ", ".join(f"`{k}`" for k in self.key)
            hashed = f" CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {self.buckets} BUCKETS" if self.buckets else ""
            self.spark.sql(f"CREATE TABLE {self.parts} ({cols}) USING parquet PARTITIONED BY ({_SEQ}){hashed}")
        self.spark.sql(f"ALTER TABLE {self.parts} DROP IF EXISTS PARTITION ({_SEQ}={n + 1})")
        (rows.repartition(self.buckets, *self.key) if self.buckets else rows).write.insertInto(self.parts)
        new = self.spark.table(self.parts).filter(F.col(_SEQ) == n + 1).count()
        if new or not n:
            shown = ", ".join(f"`{c}`" for c in [*self.key, self.column])
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_LOAD}' = '{n + 1}', '{_HIGH}' = '{high + new}') "
                           f"AS SELECT {shown} FROM {self.parts} WHERE {_SEQ} <= {n + 1}")
        return new

    def numbered(self, delivery: DataFrame) -> DataFrame:
        """The delivery's rows with their keys' numbers."""
        return delivery.join(self.lookup(), self.key, "left").select(self.column, *delivery.columns)

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.parts}")
