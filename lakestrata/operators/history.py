"""Row history (slowly changing dimension, type 2).

One full outer join between the incoming rows and the open versions decides
every row's fate; the closed versions only pass through and are never
shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.keys import version_id
from lakestrata.operators.audit import AUDIT_COLUMNS
from lakestrata.operators.guards import opaque, require_not_null, require_unique
from lakestrata.settings import RunContext


@dataclass(frozen=True)
class HistoryColumns:
    """Names of the bookkeeping columns."""

    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    updated_at: str = "updated_at"
    version_id: str = "scd_id"
    is_deleted: str = "is_deleted"

    def names(self, deletes: str = "ignore") -> list[str]:
        base = [self.valid_from, self.valid_to, self.updated_at, self.version_id]
        return base + ([self.is_deleted] if deletes == "new_record" else [])


DEFAULT = HistoryColumns()
HARD_DELETES = ("ignore", "invalidate", "new_record")
AUDIT = {c.lower() for c in AUDIT_COLUMNS}


def current_rows(df: DataFrame, names: HistoryColumns = DEFAULT) -> DataFrame:
    return df.filter(F.col(names.valid_to).isNull())


def history(df: DataFrame, key: Column, *order: Column, names: HistoryColumns = DEFAULT) -> DataFrame:
    """All versions of the rows matching ``key``, the open one last."""
    by = order or (F.col(names.valid_from).asc(), F.col(names.valid_to).asc_nulls_last())
    return df.filter(key).orderBy(*by)


def _first_versions(source: DataFrame, key: list[str], at: Column, deletes: str, n: HistoryColumns) -> DataFrame:
    """Every incoming row as an open version."""
    cols = [*source.columns, *_bookkeeping(at, [F.col(k) for k in key], deletes, n)]
    return source.select(*cols)


def _bookkeeping(at: Column, keys: list[Column], deletes: str, n: HistoryColumns) -> list[Column]:
    cols = [
        at.alias(n.valid_from),
        F.lit(None).cast("timestamp").alias(n.valid_to),
        at.alias(n.updated_at),
        version_id(keys, at).alias(n.version_id),
    ]
    return cols + ([F.lit(False).alias(n.is_deleted)] if deletes == "new_record" else [])


def _transition(source: DataFrame, open_rows: DataFrame, key: list[str], changed: Column, new_at: Column,
                gone_at: Column, deletes: str, n: HistoryColumns) -> DataFrame:
    """Next state of the open versions: kept, newly closed and newly opened rows.

    A joined row yields one or two output rows, so they are emitted as an
    array and unpacked: the join runs once, whatever the mix of outcomes.
    """
    if deletes not in HARD_DELETES:
        raise ValueError(f"hard_deletes must be one of {HARD_DELETES}")
    marks = deletes == "new_record"
    # columns that the source no longer has keep their values in the versions that hold them; new versions have NULL there
    known = {c.lower() for c in [*source.columns, *n.names("new_record")]}
    vanished = [f for f in open_rows.schema if f.name.lower() not in known]
    # a cast to this type names the fields of every emitted row
    row_type = T.StructType([
        *[T.StructField(f.name, f.dataType, metadata=f.metadata) for f in [*source.schema, *vanished]],
        T.StructField(n.valid_from, T.TimestampType()),
        T.StructField(n.valid_to, T.TimestampType()),
        T.StructField(n.updated_at, T.TimestampType()),
        T.StructField(n.version_id, T.StringType()),
        *([T.StructField(n.is_deleted, T.BooleanType())] if marks else []),
    ])
    s = source.toDF(*["s_" + c for c in source.columns]).withColumn("__in_s", F.lit(True))
    t = open_rows.toDF(*["t_" + c for c in open_rows.columns]).withColumn("__in_t", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col("s_" + k) == F.col("t_" + k) for k in key])
    joined = s.join(t, on, "full_outer")

    held = {c.lower(): c for c in open_rows.columns}
    stored = ["t_" + held[c.lower()] if c.lower() in held else F.lit(None) for c in source.columns] + ["t_" + f.name for f in vanished]
    was_deleted = F.coalesce(F.col("t_" + n.is_deleted), F.lit(False)) if marks and n.is_deleted in open_rows.columns else F.lit(False)
    none = F.lit(None)

    def row(*fields, deleted: Column) -> Column:
        return F.struct(*fields, *([deleted] if marks else [])).cast(row_type)

    def old(valid_to: Column | str) -> Column:
        return row(*stored, "t_" + n.valid_from, valid_to, "t_" + n.updated_at, "t_" + n.version_id, deleted=was_deleted)

    def closed(at: Column) -> Column:
        begun = F.col("t_" + n.valid_from)
        late = F.raise_error(F.concat(F.lit("history: a version would end at "), at.cast("string"), F.lit(", not past its start, for key "), F.to_json(F.struct(*["t_" + k for k in key]))))
        return old(F.when(F.coalesce(at <= begun, F.lit(False)), late.cast("timestamp")).otherwise(at))

    new_id = version_id(["s_" + k for k in key], new_at)
    fresh = row(*["s_" + c for c in source.columns], *[none for _ in vanished], new_at, none, new_at, new_id, deleted=F.lit(False))
    kept = F.array(old("t_" + n.valid_to))

    if deletes == "ignore":
        gone = kept
    elif deletes == "invalidate":
        gone = F.array(closed(gone_at))
    else:
        mark_id = version_id(["t_" + k for k in key], gone_at)
        marker = row(*stored, gone_at, none, gone_at, mark_id, deleted=F.lit(True))
        gone = F.when(was_deleted, kept).otherwise(F.array(closed(gone_at), marker))

    outcome = (
        F.when(F.col("__in_t").isNull(), F.array(fresh))
        .when(F.col("__in_s").isNull(), gone)
        .when(changed | was_deleted, F.array(closed(new_at), fresh))
        .otherwise(kept)
    )
    return joined.select(F.inline(outcome))


def _incoming(source: DataFrame, key: list[str], unique: str) -> DataFrame:
    source = require_not_null(source, key, "snapshot source")
    return require_unique(source, key, "snapshot source") if unique == "raise" else source


def check_changes(source: DataFrame, open_rows: DataFrame, key: list[str], check_cols: list[str], ctx: RunContext,
                  hard_deletes: str = "ignore", names: HistoryColumns = DEFAULT,
                  source_unique: str = "raise") -> DataFrame:
    """Check-strategy transition of the *open* versions only (closed ones stay where they are)."""
    at = ctx.timestamp().cast("timestamp")
    held = {c.lower() for c in open_rows.columns}
    # a column the target has never held counts as NULL there
    tests = [f"NOT (`s_{c}` <=> `t_{c}`)" if c.lower() in held else f"`s_{c}` IS NOT NULL" for c in check_cols]
    changed = F.expr(" OR ".join(tests) or "false")
    src = _incoming(source, key, source_unique)
    return _transition(src, open_rows, key, changed, at, at, hard_deletes, names)


def timestamp_changes(source: DataFrame, open_rows: DataFrame, key: list[str], updated_at: str, ctx: RunContext,
                      hard_deletes: str = "ignore", names: HistoryColumns = DEFAULT,
                      source_unique: str = "raise") -> DataFrame:
    """Timestamp-strategy transition of the open versions: newer source time wins.

    A stored version without a time is older than any time.  A row without a
    time for a stored key leaves the version as it is if their values agree,
    and fails the load if they differ: which of them is newer can't be told.
    """
    new_at, old_at = F.col("s_" + updated_at).cast("timestamp"), F.col("t_" + names.updated_at).cast("timestamp")
    held = {c.lower() for c in open_rows.columns}
    same = reduce(lambda a, b: a & b, [F.col(f"`s_{c}`").eqNullSafe(F.col(f"`t_{c}`")) for c in source.columns if c.lower() in held and c.lower() not in {*AUDIT, updated_at.lower()} and not opaque(source.schema[c].dataType)], F.lit(True))
    told = F.assert_true(same, F.concat(F.lit(f"history: {updated_at} is NULL in a row with other values than the stored one, for key "), F.to_json(F.struct(*["s_" + k for k in key]))))
    changed = F.when(F.col("__in_t") & new_at.isNull(), told.isNotNull()).otherwise(F.coalesce(new_at > old_at, old_at.isNull()))
    src = _incoming(source, key, source_unique)
    return _transition(src, open_rows, key, changed, new_at, ctx.timestamp().cast("timestamp"), hard_deletes, names)


def _with_closed(target: DataFrame, moved: DataFrame, names: HistoryColumns) -> DataFrame:
    closed = target.filter(F.col(names.valid_to).isNotNull())
    return closed.unionByName(moved, allowMissingColumns=True).select(*moved.columns)


def snapshot_check(source: DataFrame, target: DataFrame | None, key: list[str], check_cols: list[str],
                   ctx: RunContext, hard_deletes: str = "ignore", names: HistoryColumns = DEFAULT,
                   source_unique: str = "raise") -> DataFrame:
    """All versions after this run; a version closes when any checked column differs.

    ``source_unique="trusted"`` skips the repeated-key guard for sources that
    another check has already cleared.
    """
    if target is None:
        src = _incoming(source, key, source_unique)
        return _first_versions(src, key, ctx.timestamp().cast("timestamp"), hard_deletes, names)
    moved = check_changes(source, current_rows(target, names), key, check_cols, ctx, hard_deletes, names, source_unique)
    return _with_closed(target, moved, names)


def snapshot_timestamp(source: DataFrame, target: DataFrame | None, key: list[str], updated_at: str,
                       ctx: RunContext, hard_deletes: str = "ignore", names: HistoryColumns = DEFAULT,
                       source_unique: str = "raise") -> DataFrame:
    """All versions after this run; a version closes when the source row is newer."""
    if target is None:
        src = _incoming(source, key, source_unique)
        return _first_versions(src, key, F.col(updated_at).cast("timestamp"), hard_deletes, names)
    moved = timestamp_changes(source, current_rows(target, names), key, updated_at, ctx, hard_deletes, names,
                              source_unique)
    return _with_closed(target, moved, names)
