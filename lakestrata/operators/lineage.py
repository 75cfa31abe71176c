"""What a query reads, and which source columns each of its columns comes from, as Spark's analyser sees it.

Nothing is run: the analysed plan knows every relation under views, common table expressions and subqueries, and every
attribute has an expression id by which its values can be followed from the result to the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from lakestrata.sources.tables import COPIES

Name = tuple[str, ...]


def _each(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _nodes(plan) -> Iterator:
    """A plan's nodes, those of subqueries in its expressions included; children before parents."""
    for child in _each(plan.children()):
        yield from _nodes(child)
    for sub in _each(plan.subqueries()):
        yield from _nodes(sub)
    yield plan


def _identifier(table) -> Name:
    parts = [table.catalog(), table.database()]
    return (*[p.get() for p in parts if p.isDefined()], table.table())


def _stored(node) -> Name | None:
    """The catalog table that a leaf reads, if it reads one."""
    if _kind(node) == "LogicalRelation" and node.catalogTable().isDefined():
        return _identifier(node.catalogTable().get().identifier())
    if _kind(node) == "HiveTableRelation":
        return _identifier(node.tableMeta().identifier())
    return None


def relations(df: DataFrame) -> set[Name]:
    """Every catalog table and view that ``df`` reads, at any depth."""
    out = set()
    for node in _nodes(df._jdf.queryExecution().analyzed()):
        if _kind(node) == "View":
            out.add(_identifier(node.desc().identifier()))
        elif (name := _stored(node)) is not None:
            out.add(name)
    return out


def names_in_text(spark: SparkSession, sql: str) -> tuple[set[Name], str | None]:
    """Relations that a query's text names itself, and why it can't be told which (None if it can).

    A common table expression hides a table's name only where it is in
    scope: not in its own definition, nor in those before it.
    """
    found: set[Name] = set()
    odd: list[str] = []

    def walk(plan, hidden: frozenset[str]) -> None:
        kind = _kind(plan)
        if kind == "UnresolvedRelation":
            name = tuple(_each(plan.multipartIdentifier()))
            if len(name) > 1 or name[0].lower() not in hidden:
                found.add(name)
        elif "UnresolvedIdentifier" in kind:
            odd.append("IDENTIFIER")
        elif kind == "UnresolvedWith":
            for cte in _each(plan.cteRelations()):
                name = cte._1().lower()
                walk(cte._2(), hidden | {name} if plan.allowRecursion() else hidden)
                hidden = hidden | {name}
        elif plan.getClass().getName().endswith("Command") or "Statement" in kind or kind.startswith(("Insert", "Create", "Drop", "Alter", "Delete", "Update", "Merge", "Replace")):
            odd.append(kind)
        for child in _each(plan.children()):
            walk(child, hidden)
        for sub in _each(plan.subqueries()):
            walk(sub, hidden)

    walk(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset())
    return found, odd[0] if odd else None


def lineage(df: DataFrame, name_of: Callable[[Name], str] = ".".join) -> dict[str, set[tuple[str, str]]]:
    """Source columns (table, column) of every column of ``df``.

    Followed are values, not the conditions that let rows through. What an
    operator makes without naming its inputs (a Python function over whole
    rows, an unpacked document) comes from all columns it is given.
    """
    comes_from: dict[str, set[str]] = {}
    origin: dict[str, set[tuple[str, str]]] = {}
    own: set[str] = set()  # columns of a published table that its storage holds under another name

    def expressions(e) -> Iterator:
        yield e
        for child in _each(e.children()):
            yield from expressions(child)

    def read_by(e) -> set[str]:
        """Ids of the attributes whose values an expression reads."""
        ids = {a.exprId().toString() for a in _each(e.references().toSeq())}
        for x in expressions(e):
            if _kind(x) in ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
                ids |= {a.exprId().toString() for a in _each(x.plan().output())}
        return ids

    for node in _nodes(df._jdf.queryExecution().analyzed()):
        output = list(_each(node.output()))
        ids = [a.exprId().toString() for a in output]
        if (name := _stored(node)) is not None:
            for a, i in zip(output, ids):
                origin.setdefault(i, set()).add((name_of(name), a.name()))
            continue
        if _kind(node) == "View" and node.desc().properties().contains(COPIES):
            again = node.desc().properties().apply(COPIES).split(",")
            for a, i in zip(output, ids):
                if a.name() in again:
                    own.add(i)
                    origin.setdefault(i, set()).add((name_of(_identifier(node.desc().identifier())), a.name()))
        children = list(_each(node.children()))
        given = [[a.exprId().toString() for a in _each(c.output())] for c in children]
        if _kind(node) in ("Union", "Intersect", "Except"):
            for place, i in enumerate(ids):
                for g in given:
                    if g[place] != i:
                        comes_from.setdefault(i, set()).add(g[place])
            continue
        if _kind(node) == "CTERelationRef":
            continue
        made: set[str] = set()
        reads: set[str] = set()
        for e in _each(node.expressions()):
            reads |= read_by(e)
            for x in expressions(e):
                if _kind(x) == "Alias":
                    made.add(i := x.exprId().toString())
                    comes_from.setdefault(i, set()).update(read_by(x.child()))
        passed = {i for g in given for i in g}
        for i in ids:
            if i not in passed and i not in made:
                comes_from.setdefault(i, set()).update((reads & passed) or passed)
    _join_ctes(df, comes_from)

    def sources(i: str, seen: set[str]) -> set[tuple[str, str]]:
        out = set(origin.get(i, ()))
        for j in () if i in own else comes_from.get(i, ()):
            if j not in seen:
                seen.add(j)
                out |= sources(j, seen)
        return out

    result = _each(df._jdf.queryExecution().analyzed().output())
    return {name: sources(a.exprId().toString(), set()) for name, a in zip(df.columns, result)}


def _join_ctes(df: DataFrame, comes_from: dict[str, set[str]]) -> None:
    """References to a common table expression take their values from its definition, column by column."""
    nodes = list(_nodes(df._jdf.queryExecution().analyzed()))
    defined = {n.id(): [a.exprId().toString() for a in _each(n.output())] for n in nodes if _kind(n) == "CTERelationDef"}
    for n in nodes:
        if _kind(n) == "CTERelationRef" and n.cteId() in defined:
            for a, i in zip(_each(n.output()), defined[n.cteId()]):
                if a.exprId().toString() != i:
                    comes_from.setdefault(a.exprId().toString(), set()).add(i)
