"""A stored row history that rewrites only what a delivery changes.

One Parquet table holds everything, partitioned by load number, state and key
slice.  A delivery is summed up per slice first (a checksum over keys and
compared columns that does not depend on row order); slices whose checksum is
that of the last delivery they took hold nothing new and are neither joined nor
written, so an unchanged delivery writes nothing at all.  For every other slice
load ``n`` writes its open rows and the versions it closed.

A small state table says, per slice and load, which load holds the open rows and
where the closed ones begin.  Two views are built from it, so a load becomes
visible when the views move on, and a load that died half-way is dropped by the
next.  What a load replaced stays for one more load, for queries already
running.  Many small closed parts of a slice are merged when it is written
anyway.  One load at a time may write a history.

A delivery with a wider type (int to bigint, more decimal digits) starts a
further Parquet table of that type.  Its load writes all open rows there; closed
versions stay where they are, and the view casts them.  A narrower type is cast
to the stored one, and types without a common one are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.widening import common_type, same
from lakestrata.operators.guards import opaque
from lakestrata.operators.history import (
    DEFAULT,
    HistoryColumns,
    check_changes,
    snapshot_check,
    snapshot_timestamp,
    timestamp_changes,
)
from lakestrata.settings import RunContext
from lakestrata.sources.tables import exists, properties

_LOAD, _SLICES, _TABLES, _BUCKETS = "lakestrata.load", "lakestrata.slices", "lakestrata.tables", "lakestrata.buckets"
_SEQ, _STATE, _SLICE = "load_seq", "row_state", "key_slice"
# the load that opened a version, and the one that closed it
_OPENED, _CLOSED = "opened_seq", "closed_seq"
_OWN = (_OPENED, _CLOSED, _SEQ, _STATE, _SLICE)
_OWN_TYPES = {c: T.IntegerType() for c in _OWN} | {_STATE: T.StringType()}

#: Closed parts of a slice that are left side by side.
CLOSED_PARTS = 8
#: Bytes of rows in memory that a bucket holds at most when a history is first written: a task sorts whole buckets.
BUCKET_BYTES = 128 << 20


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: a word a column, and what has no fixed length."""
    size = F.lit(8 * (len(df.columns) + 1)).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            plain = F.col(f"`{f.name}`")
            value = plain if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(plain))
            size += F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            size += 16
    return size


@dataclass(frozen=True)
class _Slice:
    opened: int  # load that wrote the open rows
    closed_from: int  # load of the first closed part that counts
    digest: str  # of the last delivery taken


def checksum(df: DataFrame, columns: list[str]) -> Column:
    """Aggregate: number of rows and two 64-bit row hashes, added up; equal multisets of rows have equal checksums."""
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    parts = []
    for c in columns:  # whether it is NULL beside each value, since a hash passes over NULLs
        parts += [F.to_json(F.struct(c)) if opaque(kinds[c.lower()]) else F.col(c), F.col(c).isNull()]
    sums = [F.count(F.lit(1))]
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *parts)
        sums += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))]
    return F.concat_ws(":", *sums)


class HistoryTable:
    """``buckets`` stores rows hashed and sorted by key, so that a later load
    joins against the open set without shuffling it again.  The first load
    doubles their number until a bucket holds ``BUCKET_BYTES`` at most.
    ``slices`` is fixed when the table is first written (and made to divide
    ``buckets``); a slice should hold some hundred MB at most."""

    def __init__(self, spark: SparkSession, name: str, key: list[str], names: HistoryColumns = DEFAULT,
                 hard_deletes: str = "ignore", buckets: int | None = None, slices: int = 16):
        self.spark, self.name, self.key, self.names = spark, name, key, names
        self.hard_deletes, self.buckets = hard_deletes, buckets
        self.states = name + "__state"
        self.current_name = name + "__current"
        self._known: tuple[int, dict[int, _Slice]] = (0, {})
        held = properties(spark, name) if exists(spark, name) else {}
        self.slices = int(held[_SLICES]) if _SLICES in held else gcd(slices, buckets) if buckets else slices
        if _BUCKETS in held:
            self.buckets = int(held[_BUCKETS]) or None

    def load_number(self) -> int:
        return int(properties(self.spark, self.name).get(_LOAD, 0)) if exists(self.spark, self.name) else 0

    def tables(self) -> list[str]:
        """Parquet tables that hold the rows, oldest first: one per set of types.  Open rows are all in the last one."""
        held = properties(self.spark, self.name).get(_TABLES, "1") if exists(self.spark, self.name) else "1"
        return [self._table(int(g)) for g in held.split(",")]

    def _table(self, generation: int) -> str:
        return f"{self.name}__parts" + (str(generation) if generation > 1 else "")

    def _generation(self, table: str) -> int:
        return int(table.removeprefix(self.name + "__parts") or 1)

    def slice_of(self) -> Column:
        """Spark puts a key into bucket ``pmod(hash(key), buckets)``, so a bucket lies in one slice."""
        return F.pmod(F.hash(*self.key), F.lit(self.slices))

    def _state(self, n: int) -> dict[int, _Slice]:
        """Slices as of load ``n``; at most as many rows as there are slices.  What a published load left never changes."""
        if not n:
            return {}
        if self._known[0] != n:
            rows = self.spark.table(self.states).filter(F.col(_SEQ) == n).collect()
            self._known = (n, {r[_SLICE]: _Slice(r["opened"], r["closed_from"], r["digest"]) for r in rows})
        return self._known[1]

    # reading ---------------------------------------------------------------------------------------------------------

    def read(self) -> DataFrame | None:
        """What the history view shows, read from the partitioned tables themselves."""
        n = self.load_number()
        return self._rows(self.tables(), _where_all(n, self._state(n)), _where_closed(n, self._state(n))).drop(*_OWN) if n else None

    def current(self) -> DataFrame | None:
        """Open versions only: partition pruning leaves the history unread."""
        n = self.load_number()
        return self._rows(self.tables()[-1:], _where_open(self._state(n))).drop(*_OWN) if n else None

    def _sql(self, tables: list[str], where: str, where_older: str, own: bool = False) -> str:
        """Rows of the last table, and of older ones in its columns and types."""
        wanted = [f for f in self.spark.table(tables[-1]).schema if own or f.name not in _OWN]
        found = []
        for table in tables:
            have = {f.name.lower(): f.dataType for f in self.spark.table(table).schema}
            columns = []
            for f in wanted:
                kind = have.get(f.name.lower())
                value = f"`{f.name}`" if kind else "NULL"
                columns.append(value if kind and same(kind, f.dataType) else f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
            found.append(f"SELECT {', '.join(columns)} FROM {table} WHERE {where if table == tables[-1] else where_older}")
        return " UNION ALL ".join(found)

    def _rows(self, tables: list[str], where: str, where_older: str = "false") -> DataFrame:
        return self.spark.sql(self._sql(tables, where, where_older, own=True))

    def changes_since(self, load: int) -> tuple[DataFrame, DataFrame]:
        """What loads after ``load`` did: the open versions that they opened, and the keys that they left without one.

        Slices that these loads did not write are not read.
        """
        n = self.load_number()
        state = {s: x for s, x in self._state(n).items() if x.opened > load}
        tables = self.tables()
        opened = self._rows(tables[-1:], _where_open(state))
        where = _where_closed(n, state)
        closed = self._rows(tables, where, where).filter((F.col(_SEQ) > load) & (F.col(_CLOSED) > load))
        gone = closed.select(*self.key).distinct().join(opened.select(*self.key), self.key, "left_anti")
        return opened.filter(F.col(_OPENED) > load).drop(*_OWN), gone

    def opened_since(self, load: int) -> DataFrame:
        return self.changes_since(load)[0]

    def gone_since(self, load: int) -> DataFrame:
        return self.changes_since(load)[1]

    # loading ---------------------------------------------------------------------------------------------------------

    def _dealt(self, source: DataFrame) -> DataFrame:
        """Rows hashed as the table's buckets are: key guard, join and write all use this one shuffle, and a task writes one bucket."""
        return source.repartition(self.buckets, *self.key) if self.buckets else source

    def load_by_check(self, source: DataFrame, check_cols: list[str], ctx: RunContext) -> set[int]:
        """Take a delivery; returns the slices written.  ``source`` is read twice, so pass a stored one."""
        ctx = ctx.pinned()
        return self._load(
            source, check_cols,
            lambda s: snapshot_check(s, None, self.key, check_cols, ctx, self.hard_deletes, self.names),
            lambda s, held: check_changes(s, held, self.key, check_cols, ctx, self.hard_deletes, self.names))

    def load_by_timestamp(self, source: DataFrame, updated_at: str, ctx: RunContext) -> set[int]:
        """Take a delivery; returns the slices written.  ``source`` is read twice, so pass a stored one."""
        ctx = ctx.pinned()
        return self._load(
            source, [updated_at],
            lambda s: snapshot_timestamp(s, None, self.key, updated_at, ctx, self.hard_deletes, self.names),
            lambda s, held: timestamp_changes(s, held, self.key, updated_at, ctx, self.hard_deletes, self.names))

    def _load(self, source: DataFrame, compared: list[str], first: Callable[[DataFrame], DataFrame],
              later: Callable[[DataFrame, DataFrame], DataFrame]) -> set[int]:
        n = self.load_number()
        before = self._state(n)
        source, wider = self._fitted(source) if n else (source, {})
        digests, size = self._digests(source, compared)
        while not n and self.buckets and size > self.buckets * BUCKET_BYTES:
            self.buckets *= 2
        touched = {s for s, d in digests.items() if s not in before or before[s].digest != d}
        if self.hard_deletes != "ignore":
            touched |= {s for s, x in before.items() if s not in digests and x.digest}
        if wider:  # all open rows move
            touched = {*before, *digests}
        if not n:
            moved = first(self._dealt(source))
        elif not touched:
            return set()
        else:
            if len(touched) < self.slices and not wider:
                source = source.filter(self.slice_of().isin(sorted(touched)))
            # the vanished-column rule of the transition carries the opening load along
            held = self._rows(self.tables()[-1:], _where_open({s: before[s] for s in touched if s in before})).drop(_CLOSED, _SEQ, _STATE, _SLICE)
            moved = later(self._dealt(source), held)
        self._commit(n + 1, moved, before, {s: digests.get(s, "") for s in touched}, wider)
        return touched

    def _fitted(self, source: DataFrame) -> tuple[DataFrame, dict[str, T.DataType]]:
        """``source`` in types that hold the stored values too (equal keys of other types have other hashes), and those that are wider than the stored ones."""
        held = {f.name.lower(): f.dataType for f in self.spark.table(self.tables()[-1]).schema if f.name not in _OWN}
        wider = {}
        for f in source.schema:
            stored = held.get(f.name.lower(), f.dataType)
            both = common_type(f.dataType, stored)
            if both is None:
                raise ValueError(f"{f.name} is {f.dataType.simpleString()}, but {self.name} holds {stored.simpleString()}")
            if not same(both, stored):
                wider[f.name.lower()] = both
            if not same(both, f.dataType):
                source = source.withColumn(f.name, F.col(f.name).cast(both).alias(f.name, metadata=f.metadata))
        return source, wider

    def _digests(self, source: DataFrame, compared: list[str]) -> tuple[dict[int, str], int]:
        """Checksum of each slice of a delivery; other columns, or other types of them, make another one.  And the bytes of all."""
        kinds = {f.name.lower(): f.dataType.simpleString() for f in source.schema}
        own = {c.lower() for c in compared}
        columns = [*self.key, *sorted(compared)]
        shape = ",".join(f"{c} {k if c in own else ''}" for c, k in sorted(kinds.items()))
        found = source.groupBy(self.slice_of().alias(_SLICE)).agg(checksum(source, columns).alias("digest"), F.sum(row_bytes(source)).alias("size"))
        found = found.collect()  # one row per slice
        return {r[_SLICE]: f"{r['digest']} {shape}" for r in found}, sum(r["size"] for r in found)

    def _commit(self, n: int, moved: DataFrame, before: dict[int, _Slice], digests: dict[int, str], wider: dict[str, T.DataType]) -> None:
        closed = F.col(self.names.valid_to).isNotNull()
        opened = F.coalesce(_OPENED, F.lit(n)) if _OPENED in moved.columns else F.lit(n)
        rows = moved.withColumns({
            _OPENED: opened, _CLOSED: F.when(closed, F.lit(n)), _SEQ: F.lit(n), _STATE: F.when(closed, "closed").otherwise("open"), _SLICE: self.slice_of()})
        tables = self._fit_tables(n, rows, wider)
        stored = {t: self._stored(t) for t in tables}
        for t in tables:
            self._drop(t, stored[t], lambda seq, state, s: seq >= n)  # left by a load that failed before its views moved
        parts: dict[int, int] = {}
        for seq, state, s in (p for t in tables for p in stored[t]):
            if state == "closed" and s in digests and s in before and before[s].closed_from <= seq < n:
                parts[s] = parts.get(s, 0) + 1
        merged = {s for s, loads in parts.items() if loads >= CLOSED_PARTS}
        table = self.spark.table(tables[-1])
        if merged:
            where = _where_closed(n - 1, {s: before[s] for s in merged})
            rows = rows.unionByName(self._rows(tables, where, where).withColumn(_SEQ, F.lit(n)), allowMissingColumns=True)
        have = {c.lower() for c in rows.columns}
        rows = rows.select(*[F.col(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])
        # buckets are dealt already; otherwise a slice is written by few tasks, and a large one by several
        (rows if self.buckets and not merged else rows.hint("rebalance", F.col(_SLICE))).write.insertInto(tables[-1])
        state = {**before, **{s: _Slice(n, n if s in merged or s not in before else before[s].closed_from, d) for s, d in digests.items()}}
        self._keep_state(n, state)

        def replaced(seq: int, kind: str, s: int) -> bool:
            """Whether the published load no longer reads a part; what this one replaces stays for queries already running."""
            return seq < n and s in before and seq < (before[s].opened if kind == "open" else before[s].closed_from)

        kept = [t for t in tables if t == tables[-1] or any(p[0] < n and not replaced(*p) for p in stored[t])]
        self._publish(n, state, kept)
        self._known = (n, state)
        for t in tables:
            if t in kept:
                self._drop(t, stored[t], replaced)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def _keep_state(self, n: int, state: dict[int, _Slice]) -> None:
        if not exists(self.spark, self.states):
            self.spark.sql(f"CREATE TABLE {self.states} ({_SLICE} int, opened int, closed_from int, digest string, {_SEQ} int) USING parquet PARTITIONED BY ({_SEQ})")
        # left by a load that failed, and no longer read by any query
        self.spark.sql(f"ALTER TABLE {self.states} DROP IF EXISTS PARTITION ({_SEQ}={n}), PARTITION ({_SEQ}={n - 2})")
        rows = [(s, x.opened, x.closed_from, x.digest, n) for s, x in sorted(state.items())]
        kinds = f"{_SLICE} int, opened int, closed_from int, digest string, {_SEQ} int"
        self.spark.createDataFrame(rows, kinds).coalesce(1).write.insertInto(self.states)

    def _fit_tables(self, n: int, rows: DataFrame, wider: dict[str, T.DataType]) -> list[str]:
        """The tables, the last of which can hold ``rows``."""
        listed = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        tables = self.tables()
        held = [] if n == 1 else [f for f in self.spark.table(tables[-1]).schema if f.name not in _OWN]
        have = {f.name.lower() for f in held}
        new = [f for f in rows.schema if f.name not in _OWN and f.name.lower() not in have]
        if n > 1 and not wider:
            if new:
                self.spark.sql(f"ALTER TABLE {tables[-1]} ADD COLUMNS ({listed(new)})")
            return tables
        if n > 1:
            tables.append(self._table(self._generation(tables[-1]) + 1))
        columns = [T.StructField(f.name, wider.get(f.name.lower(), f.dataType)) for f in held] + new + [T.StructField(c, _OWN_TYPES[c]) for c in _OWN]
        keys = ", ".join(f"`{k}`" for k in self.key)
        hashed = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS" if self.buckets else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {tables[-1]}")  # left by a load that failed
        self.spark.sql(f"CREATE TABLE {tables[-1]} ({listed(columns)}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({_SEQ}, {_STATE}, {_SLICE}){hashed}")
        return tables

    def _stored(self, table: str) -> list[tuple[int, str, int]]:
        """Partitions (load, state, slice)."""
        found = [dict(x.split("=") for x in r["partition"].split("/")) for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()]
        return [(int(p[_SEQ]), p[_STATE], int(p[_SLICE])) for p in found]

    def _drop(self, table: str, stored: list[tuple[int, str, int]], gone: Callable[[int, str, int], bool]) -> None:
        specs = [f"PARTITION ({_SEQ}={seq}, {_STATE}='{state}', {_SLICE}={s})" for seq, state, s in stored if gone(seq, state, s)]
        if specs:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")

    def _publish(self, n: int, state: dict[int, _Slice], tables: list[str]) -> None:
        numbers = ",".join(str(self._generation(t)) for t in tables)
        for name, of, where in ((self.current_name, tables[-1:], _where_open(state)), (self.name, tables, _where_all(n, state))):
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_LOAD}' = '{n}', '{_SLICES}' = '{self.slices}', '{_BUCKETS}' = '{self.buckets or 0}', '{_TABLES}' = '{numbers}') "
                f"AS {self._sql(of, where, _where_closed(n, state))}")

    def drop(self) -> None:
        """Remove the views and everything stored; absent parts are no error."""
        tables = self.tables()
        for view in (self.name, self.current_name):
            self.spark.sql(f"DROP VIEW IF EXISTS {view}")
        for table in (*tables, self._table(self._generation(tables[-1]) + 1), self.states):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._known = (0, {})


def _grouped(state: dict[int, _Slice], number: Callable[[_Slice], int], sign: str) -> str:
    """Condition on load and slice: each slice's load compares by ``sign`` with its ``number``."""
    by: dict[int, list[int]] = {}
    for s, x in sorted(state.items()):
        by.setdefault(number(x), []).append(s)
    return " OR ".join(f"({_SEQ} {sign} {k} AND {_SLICE} IN ({', '.join(map(str, slices))}))" for k, slices in sorted(by.items())) or "false"


def _where_open(state: dict[int, _Slice]) -> str:
    return f"{_STATE} = 'open' AND ({_grouped(state, lambda x: x.opened, '=')})"


def _where_closed(n: int, state: dict[int, _Slice]) -> str:
    return f"{_STATE} = 'closed' AND {_SEQ} <= {n} AND ({_grouped(state, lambda x: x.closed_from, '>=')})"


def _where_all(n: int, state: dict[int, _Slice]) -> str:
    return f"({_where_open(state)}) OR ({_where_closed(n, state)})"
