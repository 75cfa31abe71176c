"""Projections: typed columns, copies, renames, flattening, schema alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.casting import is_bad, typed
from lakestrata.functions.variant import field


def _tagged(df: DataFrame, name: str, value: Column) -> Column:
    # a cast drops column metadata; tags live there, so put it back
    return value.alias(name, metadata=df.schema[name].metadata)


def cast_columns(df: DataFrame, spec: dict[str, str], on_error: str = "fail") -> DataFrame:
    """Cast the columns named in ``spec``; all others pass through in place."""
    return df.select(*[_tagged(df, c, typed(c, spec[c], on_error)) if c in spec else F.col(c) for c in df.columns])


def split_bad_rows(df: DataFrame, spec: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``spec``, already cast; rows that do not, as landed)."""
    bad = reduce(lambda a, b: a | b, [is_bad(c, t) for c, t in spec.items()], F.lit(False))
    return cast_columns(df.filter(~bad), spec), df.filter(bad)


def as_text(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All-text form of a table, the shape in which flat files land."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def alias_copies(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    return df.select("*", *[F.col(col).alias(n) for n in names])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Subset and rename: only the mapped columns remain, in mapping order."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def flatten_variant(df: DataFrame, spec: dict[str, tuple[str, str]], payload: str = "payload",
                    on_error: str = "fail") -> DataFrame:
    """One typed column per ``{name: (path, type)}``, next to the other columns of ``df``."""
    rest = [c for c in df.columns if c.lower() != payload.lower()]
    return df.select(*rest, *[field(payload, p, t, on_error).alias(n) for n, (p, t) in spec.items()])


def sync_columns(df: DataFrame, wanted: T.StructType, mode: str = "sync_all_columns") -> DataFrame:
    """Fit ``df`` (an existing target) to the ``wanted`` (incoming) columns.

    ``sync_all_columns`` adds new columns as NULL and drops vanished ones;
    ``append_new_columns`` keeps vanished ones; ``fail`` raises on any change;
    ``ignore`` leaves ``df`` as it is.
    """
    have = {c.lower(): c for c in df.columns}
    want = {f.name.lower(): f for f in wanted}
    if mode == "ignore":
        return df
    if mode == "fail":
        if set(have) != set(want):
            raise ValueError(f"schema changed: {sorted(set(have) ^ set(want))}")
        return df.select(*[F.col(have[n]).alias(f.name) for n, f in want.items()])
    if mode not in ("sync_all_columns", "append_new_columns"):
        raise ValueError(f"unknown schema mode {mode!r}")
    cols = [
        (F.col(have[n]).cast(f.dataType) if n in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for n, f in want.items()
    ]
    if mode == "append_new_columns":
        cols += [F.col(c) for n, c in have.items() if n not in want]
    return df.select(*cols)
