"""Reading and setting fields of a VARIANT column, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(payload: Column | str, path: str, kind: str = "string", on_error: str = "fail") -> Column:
    """Value at a dotted ``path`` cast to ``kind``; an absent path is NULL.

    Whole numbers are read as decimals first so that 12.7 rounds to 13, the
    same rule ``functions.casting.typed`` applies to landed text.
    """
    get = F.try_variant_get if on_error == "null" else F.variant_get
    p = _col(payload)
    if kind.lower() in ("bigint", "long"):
        wide = get(p, "$." + path, "decimal(38,0)")
        return wide.try_cast("bigint") if on_error == "null" else wide.cast("bigint")
    return get(p, "$." + path, kind)


def subtree(payload: Column | str, path: str) -> Column:
    """The part of the document below ``path``, still a VARIANT."""
    return F.variant_get(_col(payload), "$." + path, "variant")


def set_field(payload: Column | str, path: list[str], value: Column) -> Column:
    """Copy of the document with ``path`` set to ``value`` (added or replaced).

    A parent that is absent or is not an object leaves the document unchanged.
    """
    p = _col(payload)
    fields = F.try_variant_get(p, "$", "map<string,variant>")
    return F.when(fields.isNull(), p).otherwise(_set(fields, path, value))


def _set(fields: Column, path: list[str], value: Column) -> Column:
    key, *below = path
    others = F.map_filter(fields, lambda k, _: k != F.lit(key))
    if not below:
        new = F.map_concat(others, F.create_map(F.lit(key), as_variant(value)))
        return F.to_variant_object(new)
    inner = F.try_variant_get(F.element_at(fields, key), "$", "map<string,variant>")
    new = F.map_concat(others, F.create_map(F.lit(key), _set(inner, below, value)))
    # without the parent there is nothing to set the field on
    return F.when(inner.isNull(), F.to_variant_object(fields)).otherwise(F.to_variant_object(new))


def as_variant(value: Column) -> Column:
    """Scalar column as a VARIANT value."""
    return F.variant_get(F.to_variant_object(F.struct(value.alias("v"))), "$.v", "variant")
