"""Data checks.  Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS: dict[str, tuple[type, ...]] = {
    "number": (T.NumericType,),
    "string": (T.StringType, T.VarcharType, T.CharType),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
    "variant": (T.VariantType,),
}


# --- column and key checks ---------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def of_type(df: DataFrame, col: str, kind: str) -> DataFrame:
    """One row naming the real type and the rows concerned where ``col`` is not of ``kind``.

    A fitting column is settled by the schema: Catalyst folds the filter and reads nothing.
    """
    actual = df.schema[col].dataType
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.lit(not isinstance(actual, KINDS[kind]))).select(
        F.lit(col).alias("column_name"), F.lit(kind).alias("expected"), F.lit(actual.simpleString()).alias("actual"), "row_count"
    )


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list, with how many rows hold each (NULL is not judged)."""
    bad = df.filter(~F.col(col).isin(values))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys and their row counts; counted map-side, so a hot key shuffles as one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def relationships(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """Foreign keys without a parent, with how many child rows carry each.

    Both sides are reduced to one row per key and task before they meet, so a
    key that fills a third of either table costs nothing extra.
    """
    present = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), fk, child)
    held = present.groupBy(*fk).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(pk)]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__pk{i}") for i, f in enumerate(fk)])
    return held.join(known, on, "left_anti")


def rule(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that break a business rule; a rule that cannot be decided (NULL) counts as broken."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


# --- comparisons -------------------------------------------------------------


def row_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both counts and their distance as one row: one pass over both, no column read, no cross join."""
    marks = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).union(b.select(F.lit(0), F.lit(1)))
    one = marks.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("a", "source_count"), ("b", "target_count"))])
    return one.withColumn("difference", F.abs(F.col("source_count") - F.col("target_count")))


def compare_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """The two counts, only where they differ."""
    return row_counts(a, b).filter(F.col("source_count") != F.col("target_count"))


class CheckFailed(AssertionError):
    """A check found rows; the message holds its name and the first of them."""


def require(name: str, failures: DataFrame, shown: int = 5) -> None:
    """Raise if a check's frame of failures has rows."""
    found = failures.limit(shown).collect()
    if found:
        raise CheckFailed(f"{name}: " + "; ".join(str(r.asDict()) for r in found))


def _fingerprint(cols: list[str]) -> list[Column]:
    """128 bits over all columns: two hashes with different starts and column orders.

    NULL flags are hashed too, since a NULL itself leaves the hash as it is.
    """

    def one(start, names):
        return F.xxhash64(F.lit(start), *[x for c in names for x in (F.col(c), F.col(c).isNull())])

    return [one("forward", cols).alias("__h1"), one("backward", cols[::-1]).alias("__h2")]


def _as_comparable(df: DataFrame) -> DataFrame:
    documents = {f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.VariantType)}
    return df.withColumns(documents) if documents else df


#: Bytes up to which a text is as good as its digest.
_SHORT = 32


def _short_texts(df: DataFrame) -> list[Column]:
    """All columns, long texts as their SHA-256; the first byte tells a digest from a short text."""

    def short(c: str) -> Column:
        plain = F.col(f"`{c}`").cast("binary")
        digest = F.concat(F.lit(b"\1"), F.unhex(F.sha2(plain, 256)))
        return F.when(F.octet_length(plain) > _SHORT, digest).otherwise(F.concat(F.lit(b"\0"), plain)).alias(c)

    return [short(f.name) if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in df.schema]


def _unequal_by_digest(a: DataFrame, b: DataFrame, mode: str, leaves: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose leaf, a share of the rows by hash of their columns with short texts, holds a difference."""
    # both sides in their common types, as they are compared
    both = a.withColumn("__a", F.lit(True)).unionByName(b.withColumn("__a", F.lit(False)))
    cols = a.columns
    slim = both.select(*_short_texts(both.select(*cols)), "__a")
    leaf = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(leaves)).alias("__leaf")
    off = reconcile(*(slim.filter(F.col("__a") == side).select(*cols) for side in (True, False)), mode=mode).select(leaf).distinct()
    # at most ``leaves`` numbers
    left = both.withColumn("__leaf", F.pmod(F.xxhash64(*_short_texts(both.select(*cols))), F.lit(leaves))).join(F.broadcast(off), "__leaf", "left_semi")
    return left.filter("__a").select(*cols), left.filter(~F.col("__a")).select(*cols)


def reconcile(a: DataFrame, b: DataFrame, mode: str = "multiset", fingerprint: bool = False, texts: str = "whole") -> DataFrame:
    """Rows on which two tables differ, with the side and number of surplus copies.

    Both sides are tagged and grouped by all columns: each is read once, one
    shuffle, and copies collapse map-side however often a row repeats.  NULLs
    compare equal and row order does not matter.  ``set`` ignores how often a
    row occurs; ``multiset`` counts.  VARIANT columns are compared, and come
    back, as JSON text, in which object keys are always sorted.

    ``fingerprint`` suits wide rows that mostly agree: only a 128-bit hash per
    row is shuffled at first, and the full rows of the fingerprints that do not
    balance are fetched and compared exactly.  It reads both sides twice, and a
    difference could hide only behind two unequal rows with equal fingerprints.

    ``texts="digest"`` suits long texts: all other columns are shuffled as they
    are, and texts above 32 bytes as their SHA-256.  Rows near a difference
    are read again and compared whole.
    """
    a, b = _as_comparable(a), _as_comparable(b)
    if texts == "digest":
        a, b = _unequal_by_digest(a, b, mode)
    elif texts != "whole":
        raise ValueError(f"texts must be 'whole' or 'digest', not {texts!r}")
    if fingerprint:
        marks = [a.select(*_fingerprint(a.columns)), b.select(*_fingerprint(a.columns))]
        off = reconcile(*marks, mode=mode).select("__h1", "__h2").distinct()
        a, b = (
            d.select("*", *_fingerprint(a.columns)).join(off, ["__h1", "__h2"], "left_semi").select(*a.columns)
            for d in (a, b)
        )
    if mode not in ("multiset", "set"):
        raise ValueError(f"mode must be 'multiset' or 'set', not {mode!r}")
    cols = a.columns
    if {c.lower() for c in cols} != {c.lower() for c in b.columns}:
        raise ValueError("both sides must have the same columns")
    tagged = a.withColumns({"__a": F.lit(1), "__b": F.lit(0)}).unionByName(
        b.withColumns({"__a": F.lit(0), "__b": F.lit(1)})
    )
    agg = F.max if mode == "set" else F.sum
    sides = tagged.groupBy(*cols).agg(
        agg("__a").cast("bigint").alias("__a"), agg("__b").cast("bigint").alias("__b")
    )
    return sides.filter(F.col("__a") != F.col("__b")).select(
        *cols,
        F.when(F.col("__a") > F.col("__b"), "source").otherwise("target").alias("only_in"),
        F.abs(F.col("__a") - F.col("__b")).alias("copies"),
    )


def _leaf(cols: list[str], leaves: int, key: list[str] | None) -> Column:
    by = [x for c in key or cols for x in (F.col(c), F.col(c).isNull())]
    return F.pmod(F.xxhash64(*by), F.lit(leaves)).cast("int").alias("leaf")


def leaf_sums(df: DataFrame, cols: list[str] | None = None, leaves: int = 1 << 16, key: list[str] | None = None) -> DataFrame:
    """Number of rows and added-up row hashes of each leaf, one of ``leaves`` shares of the rows by hash of the key (or the row).

    Sums do not depend on order and add up: those of two parts of a table
    are the sums of the whole, and a node above some leaves has the sum of
    theirs.  So they can be kept beside a table and compared without it.
    """
    df = _as_comparable(df)
    cols = cols or df.columns
    parts = []
    for h in ("__h1", "__h2"):  # halves, so that no sum overflows
        parts += [F.sum(F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{h}_low"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"{h}_high")]
    return df.select(_leaf(cols, leaves, key), *_fingerprint(cols)).groupBy("leaf").agg(F.count(F.lit(1)).alias("row_count"), *parts)


def unequal_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaves whose sums differ, of two results of ``leaf_sums`` with equal parameters."""
    sums = [c for c in a.columns if c != "leaf"]
    both = a.select("leaf", *sums).union(b.select("leaf", *[(-F.col(c)).alias(c) for c in sums]))
    off = reduce(lambda x, y: x | y, [F.col(c) != 0 for c in sums])
    return both.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in sums]).filter(off).select("leaf")


def reconcile_by_checksums(a: DataFrame, b: DataFrame, mode: str = "multiset", leaves: int = 1 << 16, key: list[str] | None = None,
                           kept: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``reconcile``, of the rows in unequal leaves alone.

    For large tables that mostly agree: the first pass shuffles one row per
    leaf and task, and only rows of leaves whose sums differ are read again,
    shuffled and compared exactly.  Equal tables cost the first pass, or
    nothing but the sums where both sides' are ``kept``.  A difference could
    hide only behind rows whose 128-bit hashes add up to equal sums.
    """
    a, b = _as_comparable(a), _as_comparable(b)
    cols = a.columns
    if {c.lower() for c in cols} != {c.lower() for c in b.columns}:
        raise ValueError("both sides must have the same columns")
    sums = kept or (leaf_sums(a, cols, leaves, key), leaf_sums(b, cols, leaves, key))
    # at most ``leaves`` numbers
    off = F.broadcast(unequal_leaves(*sums))
    left, right = (d.select(*cols, _leaf(cols, leaves, key)).join(off, "leaf", "left_semi").select(*cols) for d in (a, b))
    return reconcile(left, right, mode)


def assert_same_rows(a: DataFrame, b: DataFrame, mode: str = "multiset", sample: int = 5) -> None:
    """Raise with a bounded sample where the two tables differ; no table is collected."""
    rows = reconcile(a, b, mode).limit(sample).collect()
    if rows:
        raise AssertionError("rows differ, for example: " + "; ".join(str(r.asDict()) for r in rows))


def count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per table, empty ones included.

    Rows are reduced to their label and counted together, so any number of
    tables costs one shuffle of a few labels per task.
    """
    spark = next(iter(tables.values())).sparkSession
    labels = F.explode(F.array(*[F.lit(n) for n in tables])).alias("table_name")
    none = spark.range(1).select(labels, F.lit(0).cast("bigint").alias("n"))
    parts = [df.select(F.lit(name), F.lit(1).cast("bigint")) for name, df in tables.items()]
    return reduce(DataFrame.union, parts, none).groupBy("table_name").agg(F.sum("n").alias("row_count"))


def scan(spark, name: str) -> DataFrame:
    """Table by a name bound as a parameter, never spliced into SQL text."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})


# --- suites ------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    name: str
    failing: Callable[[], DataFrame]
    tags: frozenset[str] = field(default_factory=frozenset)


def select_checks(checks: list[Check], tags: set[str] | None) -> list[Check]:
    if tags is None:
        return checks
    wanted = {t.lower() for t in tags}
    return [c for c in checks if wanted & {t.lower() for t in c.tags}]


def run_checks(checks: list[Check], tags: set[str] | None = None) -> DataFrame:
    """Name, failing-row count and verdict of the selected checks, as one job."""
    chosen = select_checks(checks, tags)
    if not chosen:
        raise ValueError(f"no check carries any of the tags {sorted(tags or [])}")
    return count_report({c.name: c.failing() for c in chosen}).select(
        F.col("table_name").alias("check_name"),
        F.col("row_count").alias("failures"),
        (F.col("row_count") == 0).alias("passed"),
    )
