"""Tables, views and copies that keep their policies."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.governance import Binding, Bindings, governed, propagate_by_lineage, propagate_tags
from lakestrata.operators.lineage import lineage, names_in_text, relations
from lakestrata.sources import tables


def _parts(seq) -> list[str]:
    return [seq.apply(i) for i in range(seq.size())]


class RestrictedError(ValueError):
    """A stored result would outlive the policy that guards its source."""


#: What this library stores beside a published name: versions, parts, slices, views of the open rows.
_STORAGE = re.compile(r"(.+?)__(?:v\d+|parts\d*|slices\d*|state|current|staged(?:__v\d+)?)")


@dataclass
class GovernedCatalog:
    """Reads by role, and what each way of deriving a table does to its policies.

    Names are compared as the session's catalog resolves them, whatever their
    spelling; what a published table is stored in counts as that table.

    - view, secure view: policies of the source are applied at every read;
    - LIKE, CLONE: the copy gets the source's masks, row policies and tags;
    - CTAS: only tags that propagate follow the data;
    - materialised view over a protected table: refused;
    - any other view, of the catalog or the session, over a protected table: refused.
    """

    spark: SparkSession
    bindings: Bindings = field(default_factory=Bindings)
    views: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)

    def __post_init__(self):
        self.bindings.keyed_by(self.resolved)
        self.views = {self.resolved(n): v for n, v in self.views.items()}

    def resolved(self, name: str) -> str:
        """Full name in lower case: catalog, database, table; session views keep their one part."""
        state = self.spark._jsparkSession.sessionState()
        try:
            parts = [p.lower() for p in _parts(state.sqlParser().parseMultipartIdentifier(name))]
        except Exception:  # noqa: BLE001  no name that a catalog could hold
            return name.lower()
        return self._full(tuple(parts))

    def _full(self, parts: tuple[str, ...]) -> str:
        parts = tuple(p.lower() for p in parts)
        if len(parts) == 1:
            if self.spark._jsparkSession.sessionState().catalog().getTempView(parts[0]).isDefined():
                return parts[0]
            parts = (self.spark.catalog.currentDatabase().lower(), *parts)
        if len(parts) == 2:
            parts = (self.spark.catalog.currentCatalog().lower(), *parts)
        stored = _STORAGE.fullmatch(parts[-1])
        if stored:
            base = ".".join((*(f"`{p}`" for p in parts[:-1]), f"`{stored[1]}`"))
            if tables.exists(self.spark, base) and any(k.startswith("lakestrata.") for k in tables.properties(self.spark, base)):
                parts = (*parts[:-1], stored[1])
        return ".".join(parts)

    def read(self, name: str, role: str) -> DataFrame:
        key = self.resolved(name)
        if key in self.views:
            source, query = self.views[key]
            df = query(self.read(source, role))
        else:
            df = self.spark.table(name)
            self._refuse_open_view(name, key, df)
        return governed(df, key, self.bindings, role)

    def _refuse_open_view(self, name: str, key: str, df: DataFrame) -> None:
        """A plain view over a protected table would show it clear; views made here apply its policies."""
        for source in sorted({self._full(r) for r in relations(df)} - {key}):
            if self.bindings.of(source) != Binding() and self.bindings.is_protected(source, self.spark.table(source).schema):
                raise RestrictedError(f"{name} is a view over {source}, which carries policies; make it with create_view of this catalog")

    def query(self, role: str, sql: str, **names: str) -> DataFrame:
        """SQL text as ``role``: ``query("BI", "SELECT * FROM {t} LIMIT 5", t="db.table")``.

        Tables come in as parameters alone; text that names one itself, makes
        up a name, or is more than a query is refused, since it would go
        round the policies.
        """
        shown = re.sub(r"\{(\w+)\}", lambda m: f"__parameter_{m[1]}" if m[1] in names else m[0], sql)
        found, odd = names_in_text(self.spark, shown)
        raw = sorted({".".join(n) for n in found} - {f"__parameter_{n}" for n in names})
        if raw:
            raise RestrictedError(f"pass tables as parameters; the text reads {', '.join(raw)} itself")
        if odd:
            raise RestrictedError(f"only queries over parameters are read by role; the text holds {odd}")
        return self.spark.sql(sql, **{k: self.read(n, role) for k, n in names.items()})

    def create_view(self, name: str, source: str, query: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
        self.views[self.resolved(name)] = (source, query)

    # every view here hides its definition's base rows behind read(), so secure is the only kind
    create_secure_view = create_view

    def _raw(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def ctas(self, name: str, source: str, columns: dict[str, str] | None = None) -> None:
        """Copy ``{new: old}`` columns (all by default) as stored; propagating tags follow."""
        df = self._raw(source)
        lineage = columns or {c: c for c in df.columns}
        tables.ctas(df.select(*[df[old].alias(new) for new, old in lineage.items()]), name)
        propagate_tags(self.bindings, source, name, lineage)

    def lineage(self, df: DataFrame) -> dict[str, set[tuple[str, str]]]:
        """Source columns (full table name, column) of every column of a query over stored tables."""
        return lineage(df, self._full)

    def ctas_query(self, name: str, df: DataFrame) -> None:
        """Store any query over stored tables; propagating tags follow its columns, as the analysed plan tells."""
        found = self.lineage(df)
        tables.ctas(df, name)
        propagate_by_lineage(self.bindings, name, found)

    def create_like(self, name: str, source: str) -> None:
        tables.create_like(self.spark, source, name)
        self.bindings.copy_all(source, name)

    def clone(self, name: str, source: str) -> None:
        tables.clone(self.spark, source, name)
        self.bindings.copy_all(source, name)

    def create_materialized_view(self, name: str, source: str, role: str | None = None) -> None:
        """Stored result; over a protected source only as one stated role may see it."""
        df = self._raw(source)
        if role is None and self.bindings.is_protected(source, df.schema):
            raise RestrictedError(f"{source} carries policies; name the role whose view is to be stored")
        tables.overwrite(df if role is None else self.read(source, role), name)
