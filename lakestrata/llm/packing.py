"""Best-fit packing of tokenised documents into sequences, by large-item matching.

Each document becomes its token ids and one end token. Only documents above ``capacity`` are cut, into pieces of exactly
``capacity`` with the shorter rest as the first piece. Pieces above a third of the capacity are matched greedily, largest
first, each with the largest partner that fits: at most two of them share a sequence. Smaller pieces then go, largest first,
to the tightest gap that holds them.

What fits where depends on lengths alone, and there are at most ``capacity`` different lengths. So the plan is made from the
histogram of lengths, whatever the number of documents: the driver gets one row per length, and the plan says for runs of
equal pieces (by their number among pieces of that length) which sequence and offset they take. Pieces are numbered where they
are made, per task and length, and the tasks' counts are summed up; no length, however common, is gathered in one task.

Tokenising is Python (Arrow batches), whole texts at a time: words are so many that a table of their ids, looked up per word,
costs more than encoding them. A Python worker reads the vocabulary once for all its tasks. Token ids are written once, in the
shared folder, and read from there.

Edge cases. A null or empty text is the end token alone. Equal and repeated rows are packed each for itself. Null doc_ids stay.
An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import sys
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from lakestrata.llm.common import Work, arrow_batches

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Ids in one output batch.
_BATCH_BYTES = 8 << 20

# unusual spacing
_UNSAFE = re.compile(r" (?=\s|\Z)")


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit integers.

    ``vocabulary`` is read by the tokenizers library, which encodes whatever the fast way may not: texts with unusual spacing
    and texts that hold the special token. ``ranks`` is the same vocabulary for tiktoken, which encodes all others.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import base64
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        def path(name: str) -> str:
            return name if os.path.isabs(name) else public_tokenizers.path(name)

        self._whole = Tokenizer.from_file(path(vocabulary))
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        with open(path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def __call__(self, text: str) -> bytes:
        if _UNSAFE.search(text) or any(s in text for s in self._special):
            return self._bytes(self._whole.encode(text, add_special_tokens=False).ids)
        return self._bytes(self._plain(text))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, ranks: str) -> Encoder:
    """This worker's encoder of a vocabulary."""
    if (vocabulary, ranks) not in _ENCODERS:
        _ENCODERS[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _ENCODERS[vocabulary, ranks]


def _tokenize(vocabulary: str, ranks: str, capacity: int, end: int):
    stop = int(end).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, encode = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), encoder(vocabulary, ranks)
        rows: list[tuple] = []
        held, schema = 0, None

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows))
            kinds = [schema, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "part", "number", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            schema = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py() or "") + stop
                n = len(ids) // 4
                a, b, piece = 0, n % capacity or capacity, 0
                while a < n:
                    rows.append((doc_id, piece, a, b - a, part, int(seen[b - a]), ids[4 * a : 4 * b]))
                    seen[b - a] += 1
                    a, b, piece, held = b, b + capacity, piece + 1, held + 4 * (b - a)
                if held > _BATCH_BYTES:
                    yield out()
                    rows, held = [], 0
        if rows:
            yield out()

    return run


def arrange(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Where runs of pieces go, and how many sequences there are.

    Rows (length, first number, after the last number, first sequence, offset, pieces a sequence): piece ``j`` of a run is in
    sequence first + j // pieces, at offset + (j % pieces) * length.
    """
    left = {n: c for n, c in counts.items() if c}
    bins: list[list] = []  # [gap, sequences, [(length, pieces), ...]]
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        at = bisect_left(large, capacity - n + 1) - 1  # largest partner that fits
        mate = large[at] if at >= 0 else None
        if mate is None:
            m, load = left[n], [(n, 1)]
        elif mate == n:
            m, load = (left[n] // 2, [(n, 2)]) if left[n] > 1 else (1, [(n, 1)])
            if m == 1 and left[n] == 1 and at > 0:
                mate = large[at - 1]
                load = [(n, 1), (mate, 1)]
        else:
            m, load = min(left[n], left[mate]), [(n, 1), (mate, 1)]
        bins.append([capacity - sum(a * b for a, b in load), m, load])
        for a, b in load:
            left[a] -= m * b
            if not left[a]:
                large.remove(a)
    gaps: dict[int, list[list]] = {}
    order: list[int] = []

    def put(b: list) -> None:
        if b[0] not in gaps:
            gaps[b[0]] = []
            insort(order, b[0])
        gaps[b[0]].append(b)

    for b in bins:
        put(b)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):
                put([capacity, -(-left[n] // (capacity // n)), []])
                continue
            gap = order[at]
            b = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = min(gap // n, left[n])
            m = min(b[1], left[n] // each)
            if b[1] > m:
                put([gap, b[1] - m, b[2]])
            put([gap - each * n, m, [*b[2], (n, each)]])
            left[n] -= m * each
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for gap in order:
        for _, m, load in gaps[gap]:
            offset = 0
            for n, each in load:
                rows.append((n, used[n], used[n] + m * each, sequence, offset, each))
                used[n] += m * each
                offset += n * each
            sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 6), sequence


def _place(runs: np.ndarray):
    key = runs[:, 0] << 48 | runs[:, 1]

    def run(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, j = length.to_numpy(np.int64), number.to_numpy(np.int64)
        r = runs[np.searchsorted(key, n << 48 | j, side="right") - 1]
        j = j - r[:, 1]
        return pd.DataFrame({"sequence_id": r[:, 3] + j // r[:, 5], "offset": r[:, 4] + j % r[:, 5] * n})

    return F.pandas_udf(run, StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def pack(docs: DataFrame, value: Column | None = None, capacity: int = CAPACITY, end: int = END,
         vocabulary: str = VOCABULARY, ranks: str = RANKS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    ``ids`` is binary, 4 little-endian bytes an id. ``value``, an expression over the piece's columns, replaces it: what is not
    asked for is then not shuffled.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    work = Work(spark, "pack")
    kind = docs.schema["doc_id"].dataType
    schema = StructType([StructField("doc_id", kind), StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", IntegerType()), StructField("part", IntegerType()), StructField("number", LongType()),
                         StructField("ids", BinaryType())])
    pieces = work.store(docs.select("doc_id", "text").mapInArrow(_tokenize(vocabulary, ranks, capacity, end), schema))
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = work.store(counts.select("part", "length", "n", F.coalesce(before, F.lit(0).cast("long")).alias("base")))
    # at most ``capacity`` rows
    histogram = {r.length: r.n for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = arrange(histogram, capacity)
    slim = pieces.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "part", "number",
                         (F.col("ids") if value is None else value).alias("ids"))
    numbered = slim.join(bases.select("part", F.col("length").cast("long").alias("length"), "base"), ["part", "length"])
    placed = numbered.withColumn("at", _place(runs)(F.col("length"), F.col("number") + F.col("base")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids (all pieces by offset), pieces (doc_id, piece, offset, length). At most ``capacity`` ids each."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(rows.alias("r")).select(
        "sequence_id", F.aggregate("r", F.lit(b""), lambda out, x: F.concat(out, x["ids"])).alias("ids"),
        F.transform("r", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("pieces"))
