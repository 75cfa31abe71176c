"""High-water-mark loads and keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.guards import latest_per_key, require_unique
from lakestrata.operators.shaping import sync_columns

# Below every real load time; a first run applies no filter at all.
FLOOR = "1970-01-01 00:00:00"


def high_water_mark(target: DataFrame, col: str, floor: str = FLOOR) -> DataFrame:
    """One row, one column: the newest value loaded so far."""
    kind = target.schema[col].dataType
    return target.agg(F.coalesce(F.max(col), F.lit(floor).cast(kind)).alias(col))


NULL_TIMES = ("keep", "drop", "fail")


def newer_than(source: DataFrame, ts_col: str, target: DataFrame | None, target_col: str,
               floor: str = FLOOR, null_times: str = "keep") -> DataFrame:
    """Source rows past the target's high-water mark.

    The mark is a scalar subquery: it stays inside the plan, runs once, and
    Spark hands its value to the Parquet reader, so row groups that hold only
    old rows are skipped.  Rows that arrive late with an older time stay out.
    A row without a time can't be told old from new: it comes with every load
    (a merge by key takes it twice without harm), unless ``null_times`` drops
    such rows or fails on them.
    """
    if null_times not in NULL_TIMES:
        raise ValueError(f"null_times must be one of {NULL_TIMES}, not {null_times!r}")
    if null_times == "fail":
        source = source.filter(F.assert_true(F.col(ts_col).isNotNull(), F.lit(f"NULL time in {ts_col}")).isNull())
    if target is None:
        return source
    newer = F.col(ts_col) > high_water_mark(target, target_col, floor).scalar()
    return source.filter(newer | F.col(ts_col).isNull() if null_times == "keep" else newer)


def merge_upsert(source: DataFrame, target: DataFrame | None, key: list[str], schema_mode: str = "fail",
                 duplicates: str = "raise", latest_by: str | None = None) -> DataFrame:
    """Target with the source's keys replaced or added.

    Source and target have the same columns unless ``schema_mode`` says what
    becomes of the others (``sync_columns``); ``sync_all_columns`` erases a
    column that the source no longer has from the whole target.  A repeated
    key fails, or its latest row wins (ties by row hash), or is ``trusted``
    not to occur, as where another load has checked the keys.
    Only the source's key columns meet the target: where the increment is
    small enough for Spark's own size check that side is broadcast and the
    target is not shuffled; otherwise both sides hash on ``key``.  The source
    is read twice (its keys, its rows), so pass a stored increment
    (``sources.tables.stage``) when it is costly to compute.
    """
    keys = source.select(*key)
    if duplicates == "raise":
        source = require_unique(source, key, "merge source")
    elif duplicates == "latest":
        source = latest_per_key(source, key, [F.col(latest_by).desc_nulls_last()])
        keys = keys.distinct()  # a hot key meets the target once
    elif duplicates != "trusted":
        raise ValueError(f"duplicates must be 'raise', 'latest' or 'trusted', not {duplicates!r}")
    if target is None:
        return source
    kept = target.join(keys, key, "left_anti").select(*target.columns)
    if schema_mode == "ignore":
        return kept.unionByName(source.select(*target.columns))
    kept = sync_columns(kept, source.schema, schema_mode)
    return kept.unionByName(source, allowMissingColumns=True)


def incremental(build, source: DataFrame, target: DataFrame | None, key: list[str], ts_col: str, target_col: str,
                full_refresh: bool = False, reprocess: DataFrame | None = None, stage=lambda df: df) -> DataFrame:
    """Full build on the first run or on request, else build the new rows and merge them.

    ``build`` turns source rows into target rows.  ``reprocess`` names source
    rows to rebuild although they are not new, for changes that came in
    through a reference table and so left no trace in ``ts_col``.  ``stage``
    stores the built increment and reads it back, so that the merge does not
    build it twice and knows its size.
    """
    if target is None or full_refresh:
        return build(source)
    return merge_upsert(stage(build(fresh_rows(source, target, ts_col, target_col, reprocess))), target, key)


def fresh_rows(source: DataFrame, target: DataFrame, ts_col: str, target_col: str, reprocess: DataFrame | None = None) -> DataFrame:
    """Source rows past the target's high-water mark, and those named in ``reprocess``."""
    fresh = newer_than(source, ts_col, target, target_col)
    if reprocess is None:
        return fresh
    again = source.join(reprocess.distinct(), reprocess.columns, "left_semi")
    # a row that is both new and named must not appear twice
    return fresh.unionByName(again.filter(F.col(ts_col) <= high_water_mark(target, target_col).scalar()))
