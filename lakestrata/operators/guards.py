"""Key guards: fail the running job instead of multiplying or losing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__rn"


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Fail on a repeated key, in the same pass.

    For a side that is hashed on ``keys`` anyway: ``row_number`` partitioned by the key streams through its group, so one
    key with very many rows costs no memory; it asks for the same hash
    distribution and sort order as a sort-merge join on ``keys``, so the join
    adds neither a shuffle nor a sort.
    """
    w = Window.partitionBy(*keys).orderBy(*keys)
    message = F.concat(F.lit(f"{what}: repeated key "), F.to_json(F.struct(*keys)))
    return (
        df.withColumn(_RN, F.row_number().over(w))
        .filter(F.assert_true(F.col(_RN) == 1, message).isNull())
        .drop(_RN)
    )


def require_unique_side(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Fail on a repeated key without putting anything between ``df`` and a join.

    The count of repeated keys is a scalar subquery over the key columns
    alone, aggregated map-side.  The join input stays a plain scan, so Spark
    can still broadcast it, read its buckets, or (AQE) split the other side's
    hot keys - which it only does for a join directly over two shuffles.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("n"))
    return df.filter(F.assert_true(repeated.scalar() == 0, F.lit(f"{what}: repeated key in {', '.join(keys)}")).isNull())


def require_not_null(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    for k in keys:
        df = df.filter(F.assert_true(F.col(k).isNotNull(), F.lit(f"{what}: NULL key {k}")).isNull())
    return df


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row's values; whether each is NULL is part of it, since a hash passes over NULLs."""
    parts = []
    for f in df.schema:
        plain = F.col(f"`{f.name}`")
        parts += [F.to_json(F.struct(plain)) if opaque(f.dataType) else plain, plain.isNull()]
    return F.xxhash64(*parts)


def opaque(kind: T.DataType) -> bool:
    """Whether a type has no hash of its own."""
    if isinstance(kind, T.StructType):
        return any(opaque(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return opaque(kind.elementType)
    return isinstance(kind, (T.VariantType, T.MapType))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``; ties go by the row's hash, so every attempt keeps the same row.

    The ``<= 1`` filter lets Spark cut each key to one row before the
    shuffle, so a key holding a large share of the rows does not pile up.
    """
    w = Window.partitionBy(*keys).orderBy(*order, row_hash(df))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= 1).drop(_RN)
