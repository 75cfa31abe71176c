"""Exact top-k search by inner product: branch and bound over a columnar layout.

Queries and candidates are dealt into blocks of bounded size, and every pair of a query block and a candidate block is one
group: a candidate is copied once per query block, not per query. Within a group candidates lie dimension by dimension. For a
query, partial sums grow by a block of dimensions at a time, in order of the query's mass; after each, the mass that remains on
both sides bounds what a candidate can still gain or lose (Cauchy-Schwarz). Candidates whose best is below the k-th best
guaranteed score are dropped, and the survivors are compacted. The last sums are the exact scores.

Copies. N candidates and Q queries are copied Q / ``QUERY_BLOCK`` and N * 8 * dims / ``BLOCK_BYTES`` times: both blocks are as large as
a task's memory allows, and what a search against all rows has to move falls with their product.

Each group hands on k rows a query at most; a window over those, by query, gives the result.

Components are whole numbers (``quantised``), so scores are exact: in float64 while all sums stay below 2^53, else in Python
integers, clipped to 64 bits.

Edge cases. Vectors that are null or hold null or non-finite components, and null ids, take no part. Vectors of another length
than the query's are not compared with it. An empty vector scores 0. Equal rows of one query are one query; rows of one id
with different vectors are queries of their own; no query meets a row of its own id. Repeated candidate rows count as rows.
Ties go to the smaller id. With fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import Work

K = 5
#: Bytes of a candidate block, and queries of a query block (16 MB of 64 dimensions).
BLOCK_BYTES = 4 << 20
QUERY_BLOCK = 1 << 15
#: Dimensions that are added up before candidates are bounded.
STEP = 8

_FOUND = "query_id long, query long, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    whole = [int(v) for v in q]
    out = [sum(a * int(b) for a, b in zip(whole, row)) for row in x]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, v)) for v in out], dtype=np.int64)


def search(q: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, mass: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best of one query among the candidates ``columns`` (dimensions x rows); ``mass`` is their squared sum per block of dimensions."""
    rows = np.flatnonzero(ids != own)
    partial, rest = np.zeros(len(rows)), mass[:, rows].sum(axis=0)
    parts = [slice(a, a + STEP) for a in range(0, len(q), STEP)]
    own_mass = np.array([q[p] @ q[p] for p in parts])
    left = own_mass.sum()
    floor = -np.inf
    for b in np.argsort(-own_mass, kind="stable"):
        block = columns[parts[b]]
        partial = partial + q[parts[b]] @ (block if len(rows) == block.shape[1] else block[:, rows])
        rest = rest - mass[b, rows]
        left -= own_mass[b]
        reach = np.sqrt(np.maximum(rest, 0) * max(left, 0))
        if len(rows) > k:
            worst = partial - reach
            floor = max(floor, np.partition(worst, len(worst) - k)[len(worst) - k])
            keep = partial + reach >= floor - 1e-6 * (1 + abs(floor))
            if keep.mean() < 0.8:
                rows, partial, rest = rows[keep], partial[keep], rest[keep]
    best = np.lexsort((ids[rows], -partial))[:k]
    return rows[best], partial[best].astype(np.int64)


def _cell(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or candidates.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "query", "vec_id", "score")})
        ids = candidates["vec_id"].to_numpy(np.int64)
        x = np.stack(candidates["vector"].to_numpy()).astype(np.float64)
        qs = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        dims = x.shape[1]
        small = dims * np.abs(x).max(initial=0) * np.abs(qs).max(initial=0) < 2.0**53 and max(np.abs(x).max(initial=0), np.abs(qs).max(initial=0)) < 2.0**26
        columns = np.ascontiguousarray(x.T)
        mass = np.array([(columns[a : a + STEP] ** 2).sum(axis=0) for a in range(0, dims, STEP)]).reshape(-1, len(ids))
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for own, number, q in zip(queries["query_id"], queries["query"], qs):
            if small:
                rows, scores = search(q, own, ids, columns, mass, k)
            else:
                rows = np.flatnonzero(ids != own)
                scores = _exact(q, x[rows])
                best = sorted(range(len(rows)), key=lambda i: (-int(scores[i]), ids[rows[i]]))[:k]
                rows, scores = rows[best], scores[best]
            out.append((own, number, ids[rows], scores))
        times = [len(x[2]) for x in out]
        return pd.DataFrame({
            "query_id": np.repeat([x[0] for x in out], times), "query": np.repeat([x[1] for x in out], times),
            "vec_id": np.concatenate([x[2] for x in out]), "score": np.concatenate([x[3] for x in out])})

    return run


def query_blocks(queries: DataFrame, across: int) -> DataFrame:
    """Queries with their block ``q``, by what they hold: behind a shuffle the order of rows may change when a task is run again."""
    return queries.withColumn("q", F.pmod("query", F.lit(across).cast("long")))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates (vec_id, vector) of each query (query_id, vector)."""
    queries = queries.select("query_id", "vector").dropna().distinct().withColumn("query", F.xxhash64("query_id", "vector")).withColumn("dims", F.size("vector"))
    # written once: rows are numbered by their place in the files, which stays
    candidates = Work(candidates.sparkSession, "topk").store(candidates.select("vec_id", "vector").dropna()).withColumn("dims", F.size("vector"))
    # one row each: how many blocks the sizes call for
    n = queries.agg(F.count("*").alias("n")).first()["n"]
    c = candidates.agg(F.count("*").alias("n"), F.max("dims").alias("dims")).first()
    across = max(1, -(-n // QUERY_BLOCK))
    down = max(1, -(-c["n"] * 8 * (c["dims"] or 1) // BLOCK_BYTES))

    def blocks(n: int) -> list[Column]:
        return [F.lit(0).cast("long"), F.lit(n - 1).cast("long")]

    # candidates are dealt in turn, so that equal ids or vectors don't meet in one block
    left = query_blocks(queries, across).withColumn("c", F.explode(F.sequence(*blocks(down))))
    right = candidates.withColumn("c", F.pmod(F.monotonically_increasing_id(), F.lit(down))).withColumn("q", F.explode(F.sequence(*blocks(across))))
    cell = ["dims", "q", "c"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_cell(k), _FOUND)
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
