"""A keyed table kept in hash slices: a merge or update rewrites the slices it touches and no others.

One Parquet table is partitioned by slice and load number.  A view picks, for
each slice, the newest published load that wrote it, so a load becomes visible
when the view moves on, and a load that died half-way leaves nothing behind
that is seen.  What a load replaced stays until the load after it, for queries
already running.  One load at a time may write a table.

A merge with a wider type (int to bigint, more decimal digits) writes all slices
to a further Parquet table of that type; a narrower type is cast to the stored
one, and types without a common one are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakestrata.functions.widening import common_type, same
from lakestrata.operators.incremental import merge_upsert
from lakestrata.sources.tables import exists, properties, update_where

_LOAD, _BASE, _TAKEN = "lakestrata.slice_load", "lakestrata.slice_base", "lakestrata.taken"
_TABLE = "lakestrata.table"
_SLICE, _SEQ = "key_slice", "load_seq"


class SlicedTable:
    """``slices`` is fixed when the table is first written; a slice should hold some hundred MB at most.

    So is ``buckets``: rows are then stored hashed and sorted by key within
    their slice, for joins with tables in as many buckets of that key."""

    def __init__(self, spark: SparkSession, name: str, key: list[str], slices: int = 64, buckets: int | None = None):
        self.spark, self.name, self.key = spark, name, key
        self.number = 1  # of the Parquet table that the view reads, as last seen
        held = properties(spark, name) if exists(spark, name) else {}
        if "lakestrata.slices" in held:
            self.slices, self.buckets = int(held["lakestrata.slices"]), int(held.get("lakestrata.buckets", 0)) or None
        else:
            self.slices, self.buckets = gcd(slices, buckets) if buckets else slices, buckets

    @property
    def parts(self) -> str:
        return self._table(self.number)

    def _table(self, number: int) -> str:
        return f"{self.name}__slices" + (str(number) if number > 1 else "")

    def _state(self) -> tuple[int, int]:
        """Published load, and the load of the last full write; 0 where there is none."""
        p = properties(self.spark, self.name) if exists(self.spark, self.name) else {}
        self.number = int(p.get(_TABLE, 1))
        return int(p.get(_LOAD, 0)), int(p.get(_BASE, 0))

    def published(self) -> bool:
        return self._state()[0] > 0

    def taken(self) -> int | None:
        """Load of the source up to which this table has taken its changes, as named by the write that took them."""
        p = properties(self.spark, self.name) if exists(self.spark, self.name) else {}
        return int(p[_TAKEN]) if _TAKEN in p else None

    def slice_of(self) -> Column:
        """With buckets, by the hash that Spark deals keys into buckets with: a bucket then lies in one slice."""
        return F.pmod(F.hash(*self.key) if self.buckets else F.xxhash64(*self.key), F.lit(self.slices)).cast("int")

    def _fitted(self, source: DataFrame) -> tuple[DataFrame, dict[str, DataType]]:
        """``source`` in types that hold the stored values too (equal keys of other types have other hashes), and those that are wider than the stored ones."""
        held = {f.name.lower(): f.dataType for f in self.read().schema}
        wider = {}
        for f in source.schema:
            stored = held.get(f.name.lower(), f.dataType)
            both = common_type(f.dataType, stored)
            if both is None:
                raise ValueError(f"{'key ' if f.name.lower() in {k.lower() for k in self.key} else ''}{f.name} is {f.dataType.simpleString()}, but {self.name} holds {stored.simpleString()}")
            if not same(both, stored):
                wider[f.name.lower()] = both
            if not same(both, f.dataType):
                source = source.withColumn(f.name, F.col(f.name).cast(both).alias(f.name, metadata=f.metadata))
        return source, wider

    def _slices_of(self, keys: DataFrame) -> set[int]:
        """At most one row per slice."""
        return {r["s"] for r in keys.select(self.slice_of().alias("s")).distinct().collect()}

    def _stored(self, parts: str) -> dict[int, list[int]]:
        """Loads that each slice has a partition of, ascending."""
        out: dict[int, list[int]] = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {parts}").collect():
            found = dict(x.split("=") for x in row["partition"].split("/"))
            out.setdefault(int(found[_SLICE]), []).append(int(found[_SEQ]))
        return {s: sorted(loads) for s, loads in out.items()}

    def _newest(self, load: int, base: int, stored: dict[int, list[int]] | None = None) -> dict[int, list[int]]:
        """Slices by the load that holds their rows as of ``load``."""
        out: dict[int, list[int]] = {}
        for s, loads in (self._stored(self.parts) if stored is None else stored).items():
            live = [n for n in loads if base <= n <= load]
            if live:
                out.setdefault(live[-1], []).append(s)
        return out

    def _where(self, newest: dict[int, list[int]], only: set[int] | None = None) -> str:
        terms = []
        for n, slices in sorted(newest.items()):
            wanted = [s for s in sorted(slices) if only is None or s in only]
            if wanted:
                terms.append(f"({_SEQ} = {n} AND {_SLICE} IN ({', '.join(map(str, wanted))}))")
        return " OR ".join(terms) or "false"

    def read(self, only: set[int] | None = None) -> DataFrame | None:
        """All rows, or those of some slices."""
        load, base = self._state()
        if not load:
            return None
        return self.spark.table(self.parts).filter(self._where(self._newest(load, base), only)).drop(_SLICE, _SEQ)

    def overwrite(self, df: DataFrame, taken: int | None = None) -> None:
        """Replace all rows; columns may change."""
        load, _ = self._state()
        if load and [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in self.read().schema]:
            self.drop()
            load = 0
        self._write(df, load + 1, load + 1, taken=taken)

    def merge(self, source: DataFrame, duplicates: str = "raise", latest_by: str | None = None, keys: DataFrame | None = None,
              gone: DataFrame | None = None, taken: int | None = None) -> set[int]:
        """Add or replace rows by key; returns the slices rewritten.

        ``source`` is read more than once, so pass a stored one, or name in
        ``keys`` (cheap to read, other keys than the source's have no row
        after the merge) what it replaces: then it is computed once.  Keys in
        ``gone`` leave the table.
        """
        load, base = self._state()
        if not load:
            raise ValueError(f"{self.name} has not been written")
        in_place = False
        source, wider = self._fitted(source)

        def stored(touched: set[int]) -> DataFrame:
            rows = self.read(None if wider else touched)
            return rows.select(*[F.col(f.name).cast(wider[f.name.lower()]).alias(f.name) if f.name.lower() in wider else F.col(f.name) for f in rows.schema])

        if keys is None and gone is None:
            touched = self._slices_of(source)
            merged = merge_upsert(source, stored(touched), self.key, duplicates=duplicates, latest_by=latest_by)
        else:
            kinds = {f.name.lower(): f.dataType for f in source.schema}
            left = source if keys is None else keys
            left = [df.select(*[F.col(k).cast(kinds[k.lower()]).alias(k) for k in self.key]) for df in (left, gone) if df is not None]
            left = left[0] if gone is None else left[0].unionByName(left[1])
            touched = self._slices_of(left)
            fresh = merge_upsert(source, None, self.key, duplicates=duplicates, latest_by=latest_by)
            in_place = bool(self.buckets) and not wider
            if in_place:  # stored rows stay in their buckets' tasks, and only keys and new rows are shuffled
                left, fresh = left.hint("merge"), fresh.repartition(self.buckets, *self.key)
            merged = stored(touched).join(left, self.key, "left_anti").unionByName(fresh)
        if wider:
            return self._write(merged, load + 1, load + 1, taken=taken, number=self.number + 1)
        if touched:
            self._write(merged, load + 1, base, touched, taken, in_place=in_place)
        elif taken is not None and taken != self.taken():
            self.spark.sql(f"ALTER VIEW {self.name} SET TBLPROPERTIES ('{_TAKEN}' = '{taken}')")
        return touched

    def update(self, condition: Column, changes: dict[str, Column]) -> set[int]:
        """Set columns where ``condition`` holds; returns the slices rewritten."""
        if {c.lower() for c in changes} & {k.lower() for k in self.key}:
            raise ValueError("a key can't be set: its row would belong to another slice")
        load, base = self._state()
        touched = self._slices_of(self.read().filter(condition))
        if touched:
            self._write(update_where(self.read(touched), condition, changes), load + 1, base, touched)
        return touched

    def _write(self, df: DataFrame, load: int, base: int, within: set[int] | None = None, taken: int | None = None, number: int | None = None,
               in_place: bool = False) -> set[int]:
        """Store a load, in a new table of that ``number`` if one is given, and move the view on; returns the slices that hold rows of it.

        Rows ``in_place`` are dealt by bucket already.
        """
        parts, older = (self.parts if number is None else self._table(number)), self.number - 1
        if number is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {parts}")  # left by a load that failed
        rows = df.withColumn(_SLICE, self.slice_of()).withColumn(_SEQ, F.lit(load))
        if not exists(self.spark, parts):
            cols, keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), ", ".join(f"`{k}`" for k in self.key)
            hashed = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS" if self.buckets else ""
            self.spark.sql(f"CREATE TABLE {parts} ({cols}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({_SLICE}, {_SEQ}){hashed}")
        self._drop(parts, self._stored(parts), lambda n, _: n >= load)  # left by a load that failed
        table = self.spark.table(parts)
        # a task per bucket, or few tasks per slice and several for a large one
        dealt = rows if in_place else rows.repartition(self.buckets, *self.key) if self.buckets else rows.hint("rebalance", F.col(_SLICE))
        dealt.select(*table.columns).write.insertInto(parts)
        stored = self._stored(parts)
        wrote = {s for s, loads in stored.items() if load in loads}
        if within is not None and wrote - within:
            raise RuntimeError(f"load {load} of {self.name} wrote slices {sorted(wrote - within)}, which it had not read")
        emptied = sorted((within or set()) - wrote)
        if emptied:  # a partition without rows hides the older one
            self.spark.sql(f"ALTER TABLE {parts} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({_SLICE}={s}, {_SEQ}={load})" for s in emptied))
            stored |= {s: [*stored.get(s, []), load] for s in emptied}
        listed = ", ".join(f"`{c}`" for c in table.columns if c not in (_SLICE, _SEQ))
        taken = self.taken() if taken is None else taken
        up_to = "" if taken is None else f", '{_TAKEN}' = '{taken}'"
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_LOAD}' = '{load}', '{_BASE}' = '{base}', 'lakestrata.slices' = '{self.slices}', 'lakestrata.buckets' = '{self.buckets or 0}', '{_TABLE}' = '{number or self.number}'{up_to}) "
            f"AS SELECT {listed} FROM {parts} WHERE {self._where(self._newest(load, base, stored))}")
        self._drop(parts, stored, lambda n, loads: any(n < m < load for m in loads))
        self.number = self.number if number is None else number
        if older:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(older)}")
        return wrote

    def _drop(self, parts: str, stored: dict[int, list[int]], gone: Callable[[int, list[int]], bool]) -> None:
        """Drop partitions by their load and the loads of their slice."""
        specs = [f"PARTITION ({_SLICE}={s}, {_SEQ}={n})" for s, loads in stored.items() for n in loads if gone(n, loads)]
        if specs:
            self.spark.sql(f"ALTER TABLE {parts} DROP IF EXISTS {', '.join(specs)}")

    def drop(self) -> None:
        self._state()
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for number in range(max(1, self.number - 1), self.number + 2):  # what the last load replaced, and what a failed one left
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(number)}")
        self.number = 1
