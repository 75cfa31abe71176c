"""Ranked lexical search over frequency-ordered prefix trees of documents.

A stated set of items is put to all documents. Only terms that occur in an item matter, so a document is its restricted term
vector: the item terms in it with their counts (tf), and m, which grows with its length.

Method. Vectors are written once; they give N, L and each term's df. Terms are ordered by falling df, each task sorts its
documents by their vectors in that order, and documents with a common beginning share a path of a tree (an FP-tree; a subtree is
a run of the sorted documents, and runs of at most ``leaf`` documents are leaves). Each node holds, per term, the greatest tf
beneath it, and the least m beneath it. As an item's score rises with tf and falls with m, the score of these is a bound for the
subtree. Per item the tree is searched depth first, best bound first, and a subtree whose bound is below the score of the item's
last place so far is left. The places go on from tree to tree, so later trees of a task are cut the more.

Scale. Documents are never shuffled: a task returns at most ``top`` rows per item, and these are ranked in two rounds of
windows, the first of which splits each item's rows by task. A tree holds at most ``tree`` documents or ``tree`` * 64 vector
entries, and fewer documents where there are more terms. Items are taken in blocks of about ``BLOCK_TERMS`` different terms and at
most ``BLOCK_ITEMS`` items (one item alone may have more terms); what goes to tasks is a block's terms with df and its items, and
each block reads the documents once. Only the items pass the driver: they are the stated query set, one block at a time.

Edge cases. Null and blank texts have no terms: such documents are not counted and never found, such items find nothing. An item
is what stands under one item_id (null is an id like any other): rows of equal id and text count once, different texts together.
Equal and repeated documents are each ranked; ties are by doc_id, nulls last. Terms in every document may weigh 0. An empty
table gives an empty result. Only the ids and texts are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lakestrata.llm.common import Work, arrow_batches

TOP = 10
#: Documents of a leaf and of a tree.
LEAF = 32
TREE = 8192
#: Different terms, and items, of a block.
BLOCK_TERMS = 4096
BLOCK_ITEMS = 1024
#: Parts that an item's candidates are ranked in first.
PARTS = 64

# bytes: ASCII signs and controls become spaces, A-Z become small, digits, letters and all bytes above 127 stay
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, repeats included."""
    return (text or b"").translate(_TERMS).split()


def _vectors(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = terms(text.as_py())
                held = Counter(filter(None, map(vocabulary.get, found)))
                rows.append((len(found), list(held), list(held.values())))
            n, codes, counts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])

    return run


def _quotient(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Tree:
    """A prefix tree of sorted vectors: nodes are runs [lo, hi) of the documents ``ids``; leaves are scored exactly."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], size: int, leaf: int = LEAF):
        paths = [tuple(codes.tolist()) for codes, _ in vectors]
        order = sorted(range(len(ids)), key=paths.__getitem__)
        paths = [paths[i] for i in order]
        self.ids, m = ids[order], m[order]
        self.lengths = np.array([len(p) for p in paths], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.codes = np.concatenate([vectors[i][0] for i in order])
        tf = np.concatenate([vectors[i][1] for i in order])
        self.parts = _quotient(tf, np.repeat(m, self.lengths))
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.bounds: list[np.ndarray] = []
        self._grow(paths, m, tf, size, leaf)

    def _begin(self, row: int) -> int:
        return int(self.ends[row] - self.lengths[row])

    def _grow(self, paths: list[tuple], m: np.ndarray, tf: np.ndarray, size: int, leaf: int) -> None:
        todo = [(0, len(paths), 0, -1)]
        most: list[np.ndarray] = []
        least: list[int] = []
        while todo:
            lo, hi, depth, above = todo.pop()
            node = len(self.spans)
            self.spans.append((lo, hi))
            self.children.append([])
            most.append(np.zeros(0, np.int64))
            least.append(int(m[lo:hi].min()))
            if above >= 0:
                self.children[above].append(node)
            if hi - lo <= leaf or paths[lo] == paths[hi - 1]:
                here = np.zeros(size, np.int64)
                a, b = self._begin(lo), int(self.ends[hi - 1])
                np.maximum.at(here, self.codes[a:b], tf[a:b])
                most[node] = here
                continue
            first, last = paths[lo], paths[hi - 1]
            while depth < len(first) and first[depth] == last[depth]:
                depth += 1  # a path that all beneath share
            a = lo
            run = lo
            while a < hi:  # small neighbouring branches stand together in one leaf
                if len(paths[a]) == depth:
                    b = a + 1
                else:
                    b = _after(paths, a, hi, depth)
                if b - run > leaf:
                    if a > run:
                        todo.append((run, a, depth, node))
                    if b - a > leaf:
                        todo.append((a, b, depth, node))
                        run = b
                    else:
                        run = a
                a = b
            if run < hi:
                todo.append((run, hi, depth, node))
        for node in range(len(self.spans) - 1, -1, -1):  # children have greater numbers
            if self.children[node]:
                most[node] = np.maximum.reduce([most[c] for c in self.children[node]])
        self.bounds = np.stack([_quotient(t, np.int64(x)) for t, x in zip(most, least)]).astype(np.float64)

    def search(self, codes: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        """``best``, rising tuples (score, place key, id), merged with this tree's best of one item."""
        bound = self.bounds[:, codes] @ weights * (1 + 1e-9) + 1
        todo = [0]
        while todo:
            node = todo.pop()
            floor = best[0][0] if len(best) == top else 1
            if bound[node] < floor:
                continue
            if self.children[node]:
                todo += sorted((c for c in self.children[node] if bound[c] >= floor), key=bound.__getitem__)
                continue
            lo, hi = self.spans[node]
            a, b = self._begin(lo), int(self.ends[hi - 1])
            score = np.add.reduceat(self.parts[a:b] * dense[self.codes[a:b]], self.ends[lo:hi] - self.lengths[lo:hi] - a)
            best += [(int(score[i]), *_late(self.ids[lo + i])) for i in np.flatnonzero(score >= floor).tolist()]
            best.sort()
            del best[:-top]
        return best


def _after(paths: list[tuple], a: int, hi: int, depth: int) -> int:
    """First row behind ``a`` whose path has another term at ``depth``."""
    term, lo = paths[a][depth], a + 1
    while lo < hi:
        mid = (lo + hi) // 2
        if paths[mid][depth] == term:
            lo = mid + 1
        else:
            hi = mid
    return lo


class _Down:
    """Turns an order round."""

    __slots__ = ("x",)

    def __init__(self, x):
        self.x = x

    def __lt__(self, other):
        return other.x < self.x

    def __eq__(self, other):
        return self.x == other.x


def _late(doc_id) -> tuple:
    """Sorts ids so that the last place comes first: nulls, then greater ids."""
    return (doc_id is not None, _Down(doc_id) if doc_id is not None else 0, doc_id)


def _ranked(items: list[tuple[int, np.ndarray, np.ndarray]], rank: np.ndarray, docs: int, total: int, top: int, leaf: int, tree: int):
    """Search of one task: items (number, codes, weights); ``rank`` is each code's place by falling df."""
    size = len(rank)
    tree = max(2 * leaf, min(tree, tree * BLOCK_TERMS // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {number: [] for number, _, _ in items}

        def searched(rows: list[tuple]) -> None:
            m = np.array([25 + 75 * n * docs // total for _, n, _, _ in rows], np.int64)
            ids = np.empty(len(rows), object)
            ids[:] = [r[0] for r in rows]
            vectors = []
            for _, _, codes, tfs in rows:
                places = rank[codes]
                order = np.argsort(places)
                vectors.append((places[order], tfs[order]))
            grown = Tree(ids, m, vectors, size, leaf)
            dense = np.zeros(size, np.int64)
            for number, codes, weights in items:
                dense[rank[codes]] = weights
                best[number] = grown.search(rank[codes], weights.astype(np.float64), dense, sorted(best[number]), top)
                dense[rank[codes]] = 0

        held, entries, kind = [], 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids, n = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()
            codes, tfs = batch.column("terms"), batch.column("tfs")
            flat, counts, cuts = codes.flatten().to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False), codes.offsets.to_numpy()
            cuts = cuts - cuts[0]
            for i, doc_id in enumerate(ids):
                a, b = cuts[i], cuts[i + 1]
                held.append((doc_id, n[i], flat[a:b], counts[a:b]))
                entries += b - a
                if len(held) >= tree or entries >= 64 * tree:
                    searched(held)
                    held, entries = [], 0
        if held:
            searched(held)
        part = TaskContext.get().partitionId() % PARTS
        out = [(number, part, score, doc_id) for number, found in best.items() for score, _, _, doc_id in found]
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int64(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["number", "part", "score", "doc_id"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items (item_id, {term: occurrences}) in blocks of a bounded number of terms; the driver holds one block."""
    merged = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    block, known = [], set()
    last: list = [object()]
    held: Counter = Counter()

    def closed():
        if isinstance(last[0], tuple) and held:
            block.append((last[0][0], dict(held)))

    for row in merged.orderBy("item_id", "text").toLocalIterator():
        if last[0] != (row.item_id,):
            closed()
            if len(known) >= BLOCK_TERMS or len(block) >= BLOCK_ITEMS:
                yield block
                block, known = [], set()
            last[0], held = (row.item_id,), Counter()
        held.update(terms(row.text))
        known.update(held)
    closed()
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, leaf: int = LEAF, tree: int = TREE) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score (long): each item's best documents with a score above 0."""
    spark = docs.sparkSession
    arrow_batches(spark)
    work = Work(spark, "lexical")
    result = None
    for block in _blocks(items):
        found = _block(docs, block, items.schema["item_id"].dataType, work, top, leaf, tree)
        result = found if result is None else result.unionByName(found)
    if result is None:
        schema = StructType([StructField("item_id", items.schema["item_id"].dataType), StructField("rank", IntegerType()),
                             StructField("doc_id", docs.schema["doc_id"].dataType), StructField("score", LongType())])
        return spark.createDataFrame([], schema)
    return result


def _block(docs: DataFrame, block: list[tuple], item_kind, work: Work, top: int, leaf: int, tree: int) -> DataFrame:
    spark, id_kind = docs.sparkSession, docs.schema["doc_id"].dataType
    # codes from 1: 0 would count as not found
    vocabulary = {t: i + 1 for i, t in enumerate(sorted({t for _, held in block for t in held}))}
    schema = StructType([StructField("doc_id", id_kind), StructField("n", LongType()), StructField("terms", ArrayType(IntegerType())), StructField("tfs", ArrayType(LongType()))])
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    vectors = work.store(texts.mapInArrow(_vectors(vocabulary), schema).filter("n > 0"))
    counted = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
    df = np.zeros(len(vocabulary) + 1, np.int64)
    for r in vectors.select(F.explode("terms").alias("code")).groupBy("code").count().toLocalIterator():  # one row per term of the block
        df[r["code"]] = r["count"]
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    weight = [math.floor(1000 * math.log((2 * counted.docs + 2) / (2 * d + 1))) for d in df.tolist()]
    asked = []
    for number, (_, held) in enumerate(block):
        codes = np.array([vocabulary[t] for t in held if df[vocabulary[t]]], np.int64)
        weights = np.array([held[t] * weight[vocabulary[t]] for t in held if df[vocabulary[t]]], np.int64)
        if len(codes) and weights.any():
            asked.append((number, codes, weights))
    run = _ranked(asked, rank, counted.docs, counted.total or 1, top, leaf, tree)
    out = StructType([StructField("number", IntegerType()), StructField("part", IntegerType()), StructField("score", LongType()), StructField("doc_id", id_kind)])
    best = vectors.filter(F.size("terms") > 0).mapInArrow(run, out)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["number", "part"], ["number"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], StructType([StructField("number", IntegerType()), StructField("item_id", item_kind)]))
    return best.join(names, "number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
