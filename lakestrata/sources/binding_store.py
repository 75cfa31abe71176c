"""Masks, row policies and tags as rows of a table, so that every session reads the same ones.

What a mask or policy does is code; the table holds its name, and whoever
loads the bindings gives the masks and policies that those names stand for.  A name that
is not given is an error: data must not show because a rule is unknown.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from lakestrata.operators.governance import Bindings, Mask, RowPolicy
from lakestrata.sources import tables

SCHEMA = "kind string, table_name string, column_name string, name string, value string, position int, uses array<string>"


def save_bindings(spark: SparkSession, bindings: Bindings, name: str) -> None:
    """Replace the stored bindings."""
    rows = [("propagating", None, None, tag, None, 0, []) for tag in sorted(bindings.propagating)]
    rows += [("tag_mask", None, None, tag, mask.name, 0, []) for tag, mask in bindings.tag_masks.items()]
    for table, b in bindings.tables.items():
        rows += [("mask", table, column, mask.name, None, 0, list(uses)) for column, (mask, uses) in b.masks.items()]
        rows += [("policy", table, None, policy.name, None, i, list(on)) for i, (policy, on) in enumerate(b.policies)]
        rows += [("tag", table, column, tag, value, 0, []) for (column, tag), value in b.tags.items()]
    tables.overwrite(spark.createDataFrame(rows, SCHEMA), name)


def load_bindings(spark: SparkSession, name: str, masks: Iterable[Mask] = (), policies: Iterable[RowPolicy] = ()) -> Bindings:
    """The stored bindings, with the given masks and policies for their names; one row per binding reaches the driver."""
    by_mask, by_policy = {m.name: m for m in masks}, {p.name: p for p in policies}
    out = Bindings()
    for r in sorted(spark.table(name).collect(), key=lambda r: r["position"]):
        known, wanted = (by_policy, r["name"]) if r["kind"] == "policy" else (by_mask, r["name"] if r["kind"] == "mask" else r["value"])
        if r["kind"] in ("policy", "mask", "tag_mask") and wanted not in known:
            raise ValueError(f"{name} binds the {r['kind']} {wanted!r}, which was not given")
        if r["kind"] == "propagating":
            out.create_tag(r["name"], propagate=True)
        elif r["kind"] == "tag_mask":
            out.tag_mask(r["name"], known[wanted])
        elif r["kind"] == "mask":
            out.set_mask(r["table_name"], r["column_name"], known[wanted], tuple(r["uses"]))
        elif r["kind"] == "policy":
            out.add_row_policy(r["table_name"], known[wanted], tuple(r["uses"]))
        else:
            out.tag(r["table_name"], r["column_name"], r["name"], r["value"])
    return out
