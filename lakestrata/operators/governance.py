"""Role-dependent views of a table: column masks, row policies and tags.

The role is an argument, since open-source Spark has no role of its own.
``governed`` puts the row policies below the masks, so policies see clear
values and every later operator sees masked ones.  Masks are native
expressions; a Python function may stand in for one where a rule cannot be
written natively (``python_mask`` / ``python_policy``), at Arrow-batch cost.

This shapes data; it is not a sandbox.  Spark may run a caller's own UDF
before a row filter, and the raw table stays readable to whoever can read it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import equals_ignoring_case, in_ignoring_case, star_after_each
from lakestrata.functions.variant import as_variant, field as variant_field, set_field

# Role names of the access matrix.
ADMIN = ("ACCOUNTADMIN",)
FULL_ACCESS = ("ACCOUNTADMIN", "SYSADMIN")
ANALYST = ("BI_READONLY",)

# Replacement texts.
COLUMN_MASK = "*** COLUMN MASK ***"
TABLE_MASK = "*** TABLE MASK ***"
FIELD_MASK = "*** FIELD MASK ***"
PAYLOAD_MASK = "*** PAYLOAD MASK ***"
MASKED = "*** MASKED ***"
FORENAME_MASK = "*** FORENAME-MASKED ***"
SURNAME_MASK = "*** SURNAME-MASKED ***"
SHORT_MASK = "** MASKED **"

MaskRule = Callable[..., Column]


@dataclass(frozen=True)
class Mask:
    """What each role sees in a column.

    Roles in ``allow`` see the value; roles in ``partial`` see that rule's
    result; all others see ``otherwise``.  Role names must match exactly.
    Rules receive the masked column first and the ``using`` columns after it.
    ``kind`` limits which column type a *tag* may put this mask on.
    """

    name: str
    allow: tuple[str, ...]
    otherwise: MaskRule
    partial: tuple[tuple[tuple[str, ...], MaskRule], ...] = ()
    kind: str = "string"

    def apply(self, role: str, value: Column, *using: Column) -> Column:
        if role in self.allow:
            return value
        for roles, rule in self.partial:
            if role in roles:
                return rule(value, *using)
        return self.otherwise(value, *using)


@dataclass(frozen=True)
class RowPolicy:
    """Which rows each role sees; a rule that yields NULL hides the row."""

    name: str
    allow: tuple[str, ...]
    partial: tuple[tuple[tuple[str, ...], Callable[..., Column]], ...] = ()

    def visible(self, role: str, *cols: Column) -> Column | None:
        """Predicate for ``role``; None where there is nothing to filter."""
        if role in self.allow:
            return None
        for roles, rule in self.partial:
            if role in roles:
                return rule(*cols)
        return F.lit(False)


# --- masks -------------------------------------------------------------------


def constant_mask(name: str, text: str, allow: tuple[str, ...] = ADMIN) -> Mask:
    return Mask(name, allow, lambda value, *_: F.lit(text))


def partial_name_mask(category: str = "private room") -> Mask:
    """Analysts see every second character of names in ``category``, four of five elsewhere."""

    def rule(value: Column, kind: Column) -> Column:
        return F.when(equals_ignoring_case(kind, category), star_after_each(value, 1)).otherwise(
            star_after_each(value, 4)
        )

    return Mask("partial_name", FULL_ACCESS, lambda value, *_: F.lit(MASKED), ((ANALYST, rule),))


def field_mask(path: tuple[str, ...] = ("name", "forename"), text: str = FIELD_MASK) -> Mask:
    return Mask("field", ADMIN, lambda p, *_: set_field(p, list(path), F.lit(text)), kind="variant")


def payload_mask(text: str = PAYLOAD_MASK) -> Mask:
    return Mask("payload", ADMIN, lambda p, *_: as_variant(F.lit(text)), kind="variant")


def _by_nationality(forename: str, surname: str) -> MaskRule:
    def rule(p: Column, *_: Column) -> Column:
        british = equals_ignoring_case(variant_field(p, "nationality"), "british")
        # an absent nationality counts as "not British"
        return F.when(british, set_field(p, ["name", "forename"], F.lit(forename))).otherwise(
            set_field(p, ["name", "surname"], F.lit(surname))
        )

    return rule


def person_mask() -> Mask:
    """Analysts lose one half of the name by nationality; others lose the whole name object."""
    return Mask(
        "person",
        FULL_ACCESS,
        lambda p, *_: set_field(p, ["name"], F.lit(MASKED)),
        ((ANALYST, _by_nationality(FORENAME_MASK, SURNAME_MASK)),),
        kind="variant",
    )


def person_mask_both_names() -> Mask:
    """As ``person_mask``, but other roles keep the object with both halves masked."""

    def both(p: Column, *_: Column) -> Column:
        half = set_field(p, ["name", "forename"], F.lit(SHORT_MASK))
        return set_field(half, ["name", "surname"], F.lit(SHORT_MASK))

    return Mask(
        "person_both_names", FULL_ACCESS, both, ((ANALYST, _by_nationality(SHORT_MASK, SHORT_MASK)),), kind="variant"
    )


def python_mask(name: str, fn: Callable[[str, object], object], sets: tuple[str, ...], allow: tuple[str, ...] = ()) -> Mask:
    """Mask computed by ``fn(role, document) -> document`` in Python, a batch of documents a call.

    Only the paths in ``sets`` are taken from the result; every other field
    never leaves the JVM, so its type and all its digits stay.
    """

    class _ByRole(Mask):
        def apply(self, role: str, value: Column, *using: Column) -> Column:
            if role in self.allow:
                return value
            new, out = _changes_udf(fn, role, sets)(F.to_json(value)), value
            for i, path in enumerate(sets):
                out = F.when(new[i].isNotNull(), set_field(out, path.split("."), F.parse_json(new[i]))).otherwise(out)
            return out

    return _ByRole(name, allow, lambda p, *_: p, kind="variant")


def _changes_udf(fn, role: str, sets: tuple[str, ...]):
    """JSON of the value at each path, null where ``fn`` left it as it was."""

    def run(documents: pd.Series) -> pd.Series:
        import json

        def at(document, path: str):
            for key in path.split("."):
                if not isinstance(document, dict) or key not in document:
                    return None, False
                document = document[key]
            return json.dumps(document), True

        out = []
        for text in documents:
            if text is None:
                out.append(None)
                continue
            after = fn(role, json.loads(text))
            before = json.loads(text)  # ``fn`` may change what it was given
            pairs = [(at(before, p), at(after, p)) for p in sets]
            out.append([new[0] if new[1] and new != old else None for old, new in pairs])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, T.ArrayType(T.StringType()))


# --- row policies ------------------------------------------------------------


def category_policy(visible: tuple[str, ...] = ("hotel room", "shared room")) -> RowPolicy:
    return RowPolicy("category", FULL_ACCESS, ((ANALYST, lambda c: in_ignoring_case(c, list(visible))),))


def payload_policy(path: str = "nationality", value: str = "british") -> RowPolicy:
    return RowPolicy(
        "payload", FULL_ACCESS, ((ANALYST, lambda p: equals_ignoring_case(variant_field(p, path), value)),)
    )


def python_policy(name: str, fn: Callable[[str, object], bool], allow: tuple[str, ...] = ()) -> RowPolicy:
    """Row policy computed by ``fn(role, document) -> bool`` in Python, over Arrow batches."""

    class _ByRole(RowPolicy):
        def visible(self, role: str, *cols: Column) -> Column | None:
            if role in self.allow:
                return None
            return _predicate_udf(fn, role)(*[F.to_json(c) for c in cols])

    return _ByRole(name, allow)


def _predicate_udf(fn, role: str):
    def run(documents: pd.Series) -> pd.Series:
        import json

        return pd.Series([None if text is None else bool(fn(role, json.loads(text))) for text in documents], dtype=object)

    return F.pandas_udf(run, T.BooleanType())


# --- bindings ----------------------------------------------------------------


@dataclass(frozen=True)
class Binding:
    """Everything attached to one table.  Column names compare without case."""

    masks: dict[str, tuple[Mask, tuple[str, ...]]] = field(default_factory=dict)
    policies: tuple[tuple[RowPolicy, tuple[str, ...]], ...] = ()
    # None as a column means the whole table
    tags: dict[tuple[str | None, str], str] = field(default_factory=dict)


@dataclass
class Bindings:
    """Policies and tags by table name, as a catalog would hold them.

    Names compare without case; ``keyed_by`` makes them compare as a catalog
    resolves them, so that every spelling of a table has the same bindings.
    """

    tables: dict[str, Binding] = field(default_factory=dict)
    tag_masks: dict[str, Mask] = field(default_factory=dict)
    propagating: set[str] = field(default_factory=set)
    resolve: Callable[[str], str] = field(default=str.lower, compare=False, repr=False)

    def keyed_by(self, resolve: Callable[[str], str]) -> "Bindings":
        """Compare names by what ``resolve`` makes of them, from now on and for what is already bound."""
        held, self.tables, self.resolve = self.tables, {}, resolve
        for name, b in held.items():
            known = self.of(name)
            policies = tuple(dict.fromkeys((*known.policies, *b.policies)))
            self._put(name, masks={**known.masks, **b.masks}, policies=policies, tags={**known.tags, **b.tags})
        return self

    def of(self, table: str) -> Binding:
        return self.tables.get(self.resolve(table), Binding())

    def _put(self, table: str, **changes) -> "Bindings":
        self.tables[self.resolve(table)] = replace(self.of(table), **changes)
        return self

    def set_mask(self, table: str, column: str, mask: Mask, using: tuple[str, ...] = ()) -> "Bindings":
        return self._put(table, masks={**self.of(table).masks, column.lower(): (mask, using)})

    def unset_mask(self, table: str, column: str) -> "Bindings":
        """Remove a column's mask; no error where there is none."""
        return self._put(table, masks={c: m for c, m in self.of(table).masks.items() if c != column.lower()})

    def add_row_policy(self, table: str, policy: RowPolicy, on: tuple[str, ...]) -> "Bindings":
        return self._put(table, policies=(*self.of(table).policies, (policy, on)))

    def drop_all_row_policies(self, table: str) -> "Bindings":
        return self._put(table, policies=())

    def tag(self, table: str, column: str | None, tag: str, value: str) -> "Bindings":
        key = (column.lower() if column else None, tag)
        return self._put(table, tags={**self.of(table).tags, key: value})

    def untag(self, table: str, column: str | None, tag: str) -> "Bindings":
        key = (column.lower() if column else None, tag)
        return self._put(table, tags={k: v for k, v in self.of(table).tags.items() if k != key})

    def create_tag(self, tag: str, propagate: bool = False) -> "Bindings":
        (self.propagating.add if propagate else self.propagating.discard)(tag)
        return self

    def drop_tag(self, tag: str) -> "Bindings":
        self.propagating.discard(tag)
        self.tag_masks.pop(tag, None)
        for t in list(self.tables):
            self._put(t, tags={k: v for k, v in self.of(t).tags.items() if k[1] != tag})
        return self

    def tag_mask(self, tag: str, mask: Mask) -> "Bindings":
        self.tag_masks[tag] = mask
        return self

    def untag_mask(self, tag: str) -> "Bindings":
        self.tag_masks.pop(tag, None)
        return self

    def copy_all(self, src: str, dst: str) -> "Bindings":
        """Masks, row policies and tags alike: what LIKE and CLONE carry over."""
        b = self.of(src)
        return self._put(dst, masks=dict(b.masks), policies=b.policies, tags=dict(b.tags))

    def effective_masks(self, table: str, schema: T.StructType) -> dict[str, tuple[Mask, tuple[str, ...]]]:
        """Direct masks first, then column tags, then table tags on columns of a fitting type."""
        b = self.of(table)
        out = {}
        for f in schema:
            c = f.name.lower()
            if c in b.masks:
                out[f.name] = b.masks[c]
                continue
            for level in (c, None):
                hit = [
                    self.tag_masks[t]
                    for (col, t) in b.tags
                    if col == level and t in self.tag_masks and self.tag_masks[t].kind == f.dataType.typeName()
                ]
                if hit:
                    out[f.name] = (hit[0], ())
                    break
        return out

    def is_protected(self, table: str, schema: T.StructType) -> bool:
        return bool(self.effective_masks(table, schema)) or bool(self.of(table).policies)


def propagate_tags(bindings: Bindings, src: str, dst: str, lineage: dict[str, str], all_tags: bool = False) -> Bindings:
    """Copy tags along ``{dst column: src column}``.

    Only tags created as propagating move, unless ``all_tags`` is set; a tag
    on the whole source table moves to the whole destination table.
    """
    for (col, tag), value in bindings.of(src).tags.items():
        if not all_tags and tag not in bindings.propagating:
            continue
        if col is None:
            bindings.tag(dst, None, tag, value)
        for out, origin in lineage.items():
            if origin.lower() == col:
                bindings.tag(dst, out, tag, value)
    return bindings


def propagate_by_lineage(bindings: Bindings, dst: str, lineage: dict[str, set[tuple[str, str]]], all_tags: bool = False) -> Bindings:
    """Copy tags along ``{dst column: {(source table, source column)}}``, as the analysed plan tells (``operators.lineage``)."""
    for table in sorted({t for found in lineage.values() for t, _ in found}):
        for out, found in lineage.items():
            for source, column in sorted(found):
                if source == table:
                    propagate_tags(bindings, table, dst, {out: column}, all_tags)
    return bindings


def tags_in_schema(df: DataFrame, bindings: Bindings, table: str) -> DataFrame:
    """Write the table's column tags into column metadata, where Spark carries them along."""
    by_col: dict[str, dict[str, str]] = {}
    for (col, tag), value in bindings.of(table).tags.items():
        if col is not None:
            by_col.setdefault(col, {})[tag] = value
    for c in df.columns:
        if c.lower() in by_col:
            df = df.withMetadata(c, {**df.schema[c].metadata, "tags": by_col[c.lower()]})
    return df


def tags_from_schema(df: DataFrame, bindings: Bindings, table: str) -> Bindings:
    """Read column tags back from metadata that came through views, joins and files."""
    for f in df.schema:
        for tag, value in f.metadata.get("tags", {}).items():
            bindings.tag(table, f.name, tag, value)
    return bindings


def governed(df: DataFrame, table: str, bindings: Bindings, role: str) -> DataFrame:
    """``df`` as ``role`` may see it: row policies on clear values, then masks in one projection."""
    for policy, on in bindings.of(table).policies:
        predicate = policy.visible(role, *[F.col(c) for c in on])
        if predicate is not None:
            df = df.filter(predicate)
    masks = bindings.effective_masks(table, df.schema)
    if not masks:
        return df
    cols = []
    for c in df.columns:
        if c in masks:
            mask, using = masks[c]
            value = mask.apply(role, F.col(c), *[F.col(u) for u in using])
            cols.append(value.alias(c, metadata=df.schema[c].metadata))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def by_role(df: DataFrame, table: str, bindings: Bindings, roles: list[str]) -> DataFrame:
    """The same rows as each role sees them, with the role beside each.

    Native rules are told apart by role in one projection, so the table is
    scanned once.  A Python function would run for every role's rows there;
    with one of those, each role is a scan of its own.
    """
    masks, policies = bindings.effective_masks(table, df.schema), bindings.of(table).policies
    if any(type(m) is not Mask for m, _ in masks.values()) or any(type(p) is not RowPolicy for p, _ in policies):
        views = [governed(df, table, bindings, r).withColumn("role", F.lit(r)) for r in roles]
        return reduce(lambda x, y: x.unionByName(y), views)

    def per_role(of: Callable[[str], Column]) -> Column:
        return reduce(lambda out, r: out.when(F.col("__role") == r, of(r)), roles, F)

    wide = df.withColumn("__role", F.explode(F.array(*[F.lit(r) for r in roles])))
    for policy, on in policies:
        def seen(r: str, policy=policy, on=on) -> Column:
            predicate = policy.visible(r, *[F.col(c) for c in on])
            return F.lit(True) if predicate is None else predicate

        wide = wide.filter(per_role(seen))
    cols = []
    for c in df.columns:
        if c == "role":
            continue
        if c not in masks:
            cols.append(F.col(c))
            continue
        mask, using = masks[c]
        value = per_role(lambda r, c=c, mask=mask, using=using: mask.apply(r, F.col(c), *[F.col(u) for u in using]))
        cols.append(value.alias(c, metadata=df.schema[c].metadata))
    return wide.select(*cols, F.col("__role").alias("role"))


def distinct_visible(df: DataFrame, *cols: Column | str) -> DataFrame:
    """Distinct visible values; take VARIANT columns apart into typed ones first."""
    return df.select(*cols).distinct()
