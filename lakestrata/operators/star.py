"""Dimensions, facts and their summaries."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.keys import surrogate_key
from lakestrata.operators.audit import with_audit
from lakestrata.operators.guards import latest_per_key, require_unique_side
from lakestrata.operators.history import DEFAULT, HistoryColumns, current_rows
from lakestrata.settings import RunContext


@dataclass(frozen=True)
class Dim:
    """One arm of a star: which dimension, on which keys, and what it adds.

    ``on`` maps fact columns to dimension columns, ``columns`` maps dimension
    columns to output names.  ``duplicates`` says what a repeated dimension
    key means: ``raise`` (default), ``latest`` (keep one, by ``latest_by``)
    or ``trusted`` (known unique, no guard).  ``salt`` above 1 splits each
    join key over that many tasks, for a large dimension and a fact with hot
    keys on a cluster where AQE's skew handling is off.
    """

    df: DataFrame
    on: dict[str, str]
    columns: dict[str, str] = field(default_factory=dict)
    duplicates: str = "raise"
    latest_by: str | None = None
    salt: int = 1
    also: dict[str, str] = field(default_factory=dict)
    spread_nulls: bool = False


#: Shares that rows without a key are dealt into.
NULL_SHARES = 1024


def _prepare(dim: Dim, i: int) -> DataFrame:
    keys = list(dict.fromkeys(dim.on.values()))
    # rows with a NULL key can match nothing, and they may repeat freely
    d = reduce(lambda x, k: x.filter(F.col(k).isNotNull()), keys, dim.df)
    needed = list(dict.fromkeys([*keys, *dim.also.values(), *dim.columns, *([dim.latest_by] if dim.latest_by else [])]))
    d = d.select(*needed)
    if dim.duplicates == "raise":
        d = require_unique_side(d, keys, "dimension")
    elif dim.duplicates == "latest":
        d = latest_per_key(d, keys, [F.col(dim.latest_by).desc_nulls_last()])
    elif dim.duplicates != "trusted":
        raise ValueError(f"unknown duplicates rule {dim.duplicates!r}")
    return d.select(
        *[F.col(k).alias(f"__k{i}_{j}") for j, k in enumerate([*dim.on.values(), *dim.also.values()])],
        # always 0, in a form that stays a column to hash by
        *([F.pmod(F.xxhash64(*keys), F.lit(1)).alias(f"__z{i}")] if dim.spread_nulls else []),
        *[F.col(c).alias(f"__d{i}_{out}") for c, out in dim.columns.items()],
    )


def star_join(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """Left-join every dimension; each fact row comes out exactly once.

    No broadcast hint is given: Spark broadcasts a dimension whose measured
    size passes ``spark.sql.autoBroadcastJoinThreshold`` and otherwise hashes
    both sides, splitting oversized partitions under AQE.
    """
    out = fact
    # a fact row's share depends on the row alone, so a retried task repeats it; arms on the same columns share it, and so the shuffle
    of_row = F.xxhash64(*[F.col(c) for c in fact.columns if _hashable(fact, c)])
    shares = {}
    for dim in dims:
        if dim.spread_nulls and tuple(dim.on) not in shares:
            keyless = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in dim.on])
            shares[tuple(dim.on)] = name = f"__n{len(shares)}"
            out = out.withColumn(name, F.when(keyless, F.pmod(of_row, F.lit(NULL_SHARES))).otherwise(F.lit(0)))
    for i, dim in enumerate(dims):
        d = _prepare(dim, i)
        on = [F.col(f) == F.col(f"__k{i}_{j}") for j, f in enumerate(dim.on)]
        # not an equality to the planner, which would hash by it
        on += [F.coalesce(F.col(f) == F.col(f"__k{i}_{j}"), F.lit(False)) for j, f in enumerate(dim.also, len(dim.on))]
        helper = []
        if dim.spread_nulls:
            on.append(F.col(shares[tuple(dim.on)]) == F.col(f"__z{i}"))
            helper.append(f"__z{i}")
        if dim.salt > 1:
            out = out.withColumn(f"__s{i}", F.pmod(of_row, F.lit(dim.salt).cast("bigint")))
            salts = F.sequence(F.lit(0).cast("bigint"), F.lit(dim.salt - 1).cast("bigint"))
            d = d.withColumn(f"__ds{i}", F.explode(salts))
            on.append(F.col(f"__s{i}") == F.col(f"__ds{i}"))
            helper += [f"__s{i}", f"__ds{i}"]
        out = out.join(d, reduce(lambda a, b: a & b, on), "left")
        out = out.drop(*helper, *[f"__k{i}_{j}" for j in range(len(dim.on) + len(dim.also))])
    names = {f"__d{i}_{o}": o for i, dim in enumerate(dims) for o in dim.columns.values()}
    # dimension columns win over fact columns of the same name, as the caller named them last
    taken = {o.lower() for o in names.values()}
    kept = [F.col(c) for c in fact.columns if c.lower() not in taken]
    return out.select(*kept, *[F.col(c).alias(o) for c, o in names.items()])


def _hashable(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() not in ("variant", "map")


def build_dim(snapshot: DataFrame, key: list[str], columns: dict[str, str], ctx: RunContext, sk: str = "SK",
              names: HistoryColumns = DEFAULT, modified: str = "LAST_MODIFIED_AT",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """Dimension of the open versions: carried columns, hashed key, renamed columns."""
    rows = current_rows(snapshot, names).select(
        *carry,
        surrogate_key(*key).alias(sk),
        *[F.col(c).alias(o) for c, o in columns.items()],
        F.col(names.updated_at).alias(modified),
    )
    return with_audit(rows, ctx)


def build_fact(snapshot: DataFrame, dims: list[Dim], outputs: dict[str, Column], ctx: RunContext,
               names: HistoryColumns = DEFAULT) -> DataFrame:
    """Fact over the open versions; ``outputs`` are expressions over fact and dimension columns."""
    joined = star_join(current_rows(snapshot, names), dims)
    return with_audit(joined.select(*[c.alias(n) for n, c in outputs.items()]), ctx)


def summarize_by(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Count, average, lowest and highest of ``measure`` per group, in group order."""
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.avg(measure).alias(f"avg_{measure}"),
            F.min(measure).alias(f"min_{measure}"),
            F.max(measure).alias(f"max_{measure}"),
        )
        .orderBy(group)
    )


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows by a stated order: each task keeps ``n``, then one merge."""
    return df.orderBy(*order).limit(n)
