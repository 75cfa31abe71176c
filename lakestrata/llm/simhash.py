"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the text's 4-word shingles. Two
fingerprints link at ``radius`` (4) or fewer differing bits; a group is a connected component of links.

Method. Two fingerprints within radius r have a midpoint within r/2 of both, so if every fingerprint emits its ball of radius
r/2, linked fingerprints share an emitted variant. A ball of radius 2 over 64 bits has 2,081 variants, some 60 GB of shuffle
for a GB of documents. So the bits are dealt into three blocks first: of four differing bits at least two fall into one block,
and the other two blocks together (42 or 43 bits) hold at most two. On each of the three pairs of blocks the ball has
radius 1: 43 or 44 variants, 131 in all. Variants are shuffled, and what collides is verified on all 64 bits.

Crowds. Pairs within a variant's holders are not listed. Every holder is compared with the least and the greatest holder, and
the components of those links are formed first. Where holders of one variant then still fall into several components, those
outside the largest are compared with all holders, if they are ``crowd`` or fewer. If they are more, the holders emit the
full ball of radius 2 over 64 bits: all holders of such a variant lie within 4 bits of each other, so each links to the least
of them. The work stays in proportion to the rows, and no connection is lost.

Edge cases. Null and blank texts have fingerprint zero and link like any other. Texts of fewer than four words have one
shingle, the whole sequence. Equal texts have equal fingerprints. Repeated doc_ids are repeated rows of one id. A null doc_id
keeps its row; it is never the least id of a group that has another, and the component_id of a group without ids is null. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lakestrata.llm.common import Work, arrow_batches, pick
from lakestrata.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Holders of a variant outside its largest component that are compared with all its holders.
CROWD = 32
_CHUNK = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """SimHash of one UTF-8 text, as a signed 64-bit integer."""
    words = (text or b"").lower().split()  # on bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - SHINGLE + 1)
    if n == 1:
        return _signed(digest(joined, SEED))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    counts = np.zeros(64, np.int64)
    for a in range(0, n, _CHUNK):
        b = min(n, a + _CHUNK)
        spans = zip(starts[a:b].tolist(), ends[a + SHINGLE - 1 : b + SHINGLE - 1].tolist())
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, b - a)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@F.pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, ``fp`` (signed) and a hash of the text of every row."""
    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", _fingerprints(F.col("text").cast("binary")).alias("fp"), F.xxhash64("text").alias("hash"))


def _blocks(n: int) -> list[int]:
    """Bit masks of ``n`` near-equal blocks of the 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _longs(values: list[int]) -> Column:
    """A literal array of 64-bit patterns."""
    return F.expr(f"array({', '.join(f'{_signed(x)}L' if x != 1 << 63 else 'bigint(-9223372036854775808)' for x in values)})")


def _ball_of_two_thirds() -> Column:
    """One struct for each pair of three blocks: the bits kept, a tag that tells the pairs apart, and what to flip (one bit or none)."""
    blocks = _blocks(3)
    masks = [(1 << 64) - 1 ^ b for b in blocks]
    return F.array(*[
        F.struct(_longs([m])[0].alias("mask"), _longs([i * 0x9E3779B97F4A7C15 & (1 << 64) - 1])[0].alias("tag"),
                 _longs([0, *(1 << j for j in range(64) if m >> j & 1)]).alias("flips"))
        for i, m in enumerate(masks)
    ])


def _full_ball() -> Column:
    """What to flip for all variants within two bits out of 64: 2,081 patterns."""
    ones = [1 << j for j in range(64)]
    return _longs([0, *ones, *(x | y for i, x in enumerate(ones) for y in ones[:i])])


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def _shared(distinct: DataFrame) -> DataFrame:
    """Emitted variants (key, fp) that more than one fingerprint holds, with the least and the greatest holder."""
    kept = distinct.select("fp", F.explode(_ball_of_two_thirds()).alias("v")).select(
        "fp", F.col("fp").bitwiseAND(F.col("v.mask")).bitwiseXOR(F.col("v.tag")).alias("part"), "v.flips")
    ball = kept.select("fp", "part", F.explode("flips").alias("flip"))
    key = F.col("part").bitwiseXOR(F.col("flip"))
    w = Window.partitionBy("key")
    held = ball.select(key.alias("key"), "fp").select("*", F.min("fp").over(w).alias("lo"), F.max("fp").over(w).alias("hi"))
    return held.filter("lo <> hi")


def _remaining(shared: DataFrame, roots: DataFrame, crowd: int) -> DataFrame:
    """Links (a, b) across the components ``roots`` (node, root) of holders of one variant."""
    w = Window.partitionBy("key")
    member = (
        shared.join(roots, shared.fp == roots.node, "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
        .select("*", F.min("root").over(w).alias("lo"), F.max("root").over(w).alias("hi")).filter("lo <> hi")
        .select("key", "fp", "root", F.count("*").over(Window.partitionBy("key", "root")).alias("n"))
        .select("*", F.max(F.struct("n", "root")).over(w)["root"].alias("main"))
        .select("*", F.sum((F.col("root") != F.col("main")).cast("long")).over(w).alias("outside"))
    )
    few = member.filter(F.col("outside") <= crowd)
    others = F.collect_list(F.when(F.col("root") != F.col("main"), F.struct("fp", "root"))).over(w)
    linked = F.filter("others", lambda x: (x["root"] != F.col("root")) & (F.bit_count(x["fp"].bitwiseXOR(F.col("fp"))) <= RADIUS))
    crossing = few.select("fp", "root", others.alias("others")).select(F.col("fp").alias("a"), F.explode(linked).alias("x"))
    full = member.filter(F.col("outside") > crowd).select("fp").distinct().select("fp", F.explode(_full_ball()).alias("flip"))
    starred = full.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "fp").select(F.col("fp").alias("b"), F.min("fp").over(w).alias("a"))
    return crossing.select("a", F.col("x.fp").alias("b")).unionByName(starred.filter("a <> b").select("a", "b"))


def linked_fingerprints(distinct: DataFrame, work: Work, crowd: int = CROWD) -> DataFrame:
    """``node`` and ``root`` of every fingerprint of the one-column frame ``fp`` that links to another."""
    shared = work.store(_shared(distinct))
    path = work.last
    stars = shared.filter(_near("fp", "lo")).select("fp", F.col("lo").alias("to")).unionByName(
        shared.filter(_near("fp", "hi")).select("fp", F.col("hi").alias("to")))
    first = components(stars.select(F.col("fp").alias("a"), F.col("to").alias("b")), work)
    more = work.store(_remaining(shared.select("key", "fp"), first, crowd))
    work.drop(path)
    ends = (
        more.join(first.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        .join(first.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    second = components(ends, work)
    moved = second.select(F.col("node").alias("root"), F.col("root").alias("last"))
    kept = first.join(moved, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return kept.unionByName(second.join(first.select("node"), "node", "left_anti").select("node", "root"))


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written rows (doc_id, fp), and per fingerprint its group: fp, root (a fingerprint) and component_id."""
    work = Work(docs.sparkSession, "simhash")
    fps = work.store(fingerprints(docs))
    heads = work.store(fps.groupBy("fp").agg(F.min("doc_id").alias("head")))
    linked = work.store(linked_fingerprints(heads.select("fp"), work))
    least = linked.join(heads, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("head").alias("least"))
    named = linked.join(least, "root").select(F.col("node").alias("fp"), "root", "least")
    ids = heads.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "head").alias("component_id"))
    return fps, ids


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed), component_id of every row of ``docs`` (doc_id, text)."""
    fps, ids = _rooted(docs)
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one document of each group left: the one with the least doc_id, nulls last.

    Where that doc_id stands on several rows, the survivor is one of those whose text belongs to the group: by the hash of the
    text, and of equal texts the least row by all its columns.
    """
    fps, ids = _rooted(docs)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash")).alias("x")
    kept = fps.join(ids.select("fp", "root"), "fp").groupBy("root").agg(least).select(F.col("x.doc_id").alias("__id"), F.col("x.hash").alias("__hash"))
    rows = docs.select(*pick(docs, *docs.columns), F.xxhash64("text").alias("__hash"))
    own = rows.join(kept, rows["doc_id"].eqNullSafe(kept["__id"]) & (rows["__hash"] == kept["__hash"]), "left_semi")
    names = [c for c in docs.columns if c != "doc_id"]
    one = own.groupBy("doc_id", "__hash").agg(F.min(F.struct(*pick(own, *names))).alias("__row"))
    flat = one.select("doc_id", "__row.*")
    return flat.select(*pick(flat, *docs.columns))
